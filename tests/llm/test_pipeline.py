"""The pipeline stage by stage on planted rows, and end to end."""

from __future__ import annotations

import random

import pytest

import corpus_pipeline as C
from spanloom.llm.common import load
from spanloom.llm.packing import Encoder
from spanloom.llm.queries import tokenizer_path

SF = "/root/testdata/sf0.001"
KEY = "spark.sql.execution.arrow.maxBytesPerBatch"


@pytest.fixture(scope="module")
def planted(spark):
    rng = random.Random(9)
    base = load(spark, SF, "documents").collect()
    word = lambda: "".join(rng.choice("bcdfglmnprst") + rng.choice("aeiou") for _ in range(rng.randrange(1, 4)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passage, copy = prose(60), prose(300).split()
    near = [*copy]
    near[150] = "changed"
    item = load(spark, SF, "benchmark").orderBy("item_id").first()["text"].replace("\n", " ")
    rows = [
        (900_001, f"{prose(80)}\n{passage}\n{prose(70)}"), (900_002, f"{prose(90)}\n{passage}\n{prose(60)}"), (900_003, "12345 !!"), (900_004, None),
        (900_005, " ".join(copy)), (900_006, " ".join(near)), (900_007, f"{prose(20)} {item} {prose(20)}"), (900_008, prose(200)),
    ]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    return spark.createDataFrame(base, docs.schema).unionByName(docs), passage, item


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_stage_names_and_columns(planted, spark):
    docs, _, _ = planted
    assert [f.__name__ for _, f in C.STAGES] == ["language", "lines", "near_duplicates", "benchmark", "packing"]
    for _, f in C.STAGES[:-1]:
        out = f(spark, docs, SF)
        assert out.columns == docs.columns


def test_stages_bound_what_workers_get_at_once(planted, spark):
    """After each stage's call, when its result is computed, a partition of large texts reaches a worker in small batches; a caller's own bound stays."""
    import pyarrow as pa

    def held(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"n": pa.array([b.nbytes], pa.int64())})

    large = spark.range(0, 4000, 1, 1).selectExpr("repeat('x', 4096 + cast(id % 2 as int)) AS text")
    largest = lambda: max(r.n for r in large.mapInArrow(held, "n bigint").collect())
    few, before = planted[0].filter("doc_id > 900004").coalesce(1), spark.conf.get(KEY, None)
    try:
        for _, f in C.STAGES:
            spark.conf.unset(KEY)
            f(spark, few, SF)
            assert largest() < 5 << 20, f.__name__
        spark.conf.set(KEY, "1m")
        C.language(spark, few, SF)
        assert largest() < 2 << 20
    finally:
        spark.conf.unset(KEY) if before is None else spark.conf.set(KEY, before)


def test_language_stage(planted, spark):
    docs, _, _ = planted
    kept = texts(C.language(spark, docs, SF))
    assert not {900_003, 900_004} & set(kept) and len(kept) >= docs.count() - 8


def test_line_stage(planted, spark):
    docs, passage, _ = planted
    kept = texts(C.lines(spark, docs, SF))
    assert passage in kept[900_001] and passage not in kept[900_002] and kept[900_008] == texts(docs)[900_008]


def test_near_stage(planted, spark):
    docs, _, _ = planted
    kept = set(texts(C.near_duplicates(spark, docs, SF)))
    assert 900_005 in kept and 900_006 not in kept and {900_001, 900_002, 900_007, 900_008} <= kept


def test_near_stage_against_jaccard(planted, spark):
    """All pairs at 0.85 or more are joined; pairs below 0.6 are not joined directly."""
    docs, _, _ = planted
    from spanloom.llm.simhash import fingerprint

    rows = [(d, t) for d, t in texts(docs).items() if t]
    sets = {d: {tuple(t.lower().split()[i : i + 5]) for i in range(max(1, len(t.split()) - 4))} for d, t in rows}
    fps = {d: fingerprint(t, C.SHINGLE, words=C.SIMHASH_WORDS).tolist() for d, t in rows}
    for i, (a, _) in enumerate(rows):
        for b, _ in rows[:i]:
            j = len(sets[a] & sets[b]) / len(sets[a] | sets[b])
            far = sum((x ^ y).bit_count() for x, y in zip(fps[a], fps[b], strict=True))
            assert not (j >= 0.9 and far > C.SIMHASH_RADIUS) and not (j < 0.5 and min(len(sets[a]), len(sets[b])) > 20 and far <= C.SIMHASH_RADIUS), (a, b, j, far)


def edited(rng, n, edits):
    """Two texts of n own words, the second with so many words replaced, and their five-word Jaccard similarity."""
    a = [f"w{rng.randrange(10**9)}" for _ in range(n)]
    b = list(a)
    for at in rng.sample(range(n), edits):
        b[at] = f"v{rng.randrange(10**9)}"
    x, y = ({tuple(t[i : i + 5]) for i in range(n - 4)} for t in (a, b))
    return " ".join(a), " ".join(b), len(x & y) / len(x | y)


def test_near_stage_decides_at_the_similarity(spark):
    """Recall and precision around 0.8: exactly the pairs at 0.8 and above lose their second text."""
    rng = random.Random(17)
    pairs = []
    while len(pairs) < 400:
        n = rng.randrange(60, 400)
        a, b, j = edited(rng, n, max(1, round(n * rng.uniform(0.015, 0.04))))
        if 0.7 <= j <= 0.9:
            pairs.append((a, b, j))
    pairs += [(t, t.rsplit(" ", 1)[0], j) for n, j in ((9, 0.8), (8, 0.75)) for t in (" ".join(f"x{rng.randrange(10**9)}" for _ in range(n)) for _ in range(100))]
    docs = spark.createDataFrame([(2 * i + k, t) for i, p in enumerate(pairs) for k, t in enumerate(p[:2])], "doc_id long, text string")
    kept = set(texts(C.near_duplicates(spark, docs, SF)))
    want = {2 * i for i in range(len(pairs))} | {2 * i + 1 for i, p in enumerate(pairs) if p[2] < 0.8}
    assert sum(p[2] >= 0.8 for p in pairs) > 150 < sum(p[2] < 0.8 for p in pairs)
    assert kept == want


def test_near_stage_counts_a_repeated_shingle_once(spark):
    """A phrase repeated in two texts doesn't make them copies, and each one's own repeated phrase doesn't hide that they are."""
    rng = random.Random(19)
    own = lambda n: " ".join(f"w{rng.randrange(10**9)}" for _ in range(n))
    phrase, common = own(8), own(200)
    rows = [(0, f"{own(150)} {' '.join([phrase] * 40)}"), (1, f"{own(150)} {' '.join([phrase] * 40)}")]
    rows += [(2 + i, f"{common} {' '.join([own(8)] * 10)}") for i in range(2)]
    kept = set(texts(C.near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string"), SF)))
    assert kept == {0, 1, 2}


def test_near_stage_tells_rows_of_one_id_apart(spark):
    """An id on two rows: only the row whose text is a copy goes, and the row that its own group keeps stays."""
    rng = random.Random(20)
    (a, b, _), (c, d, _), (e, f, _) = (edited(rng, 300, 2) for _ in range(3))
    clean = edited(rng, 300, 2)[0]
    rows = [(1, a), (5, b), (5, clean), (5, c), (9, d), (7, e), (7, f), (7, f), (None, e)]
    out = C.near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string"), SF).collect()
    kept = [(r.doc_id, r.text) for r in out]
    assert {x for x in kept if x[0] != 7} == {(1, a), (5, clean), (5, c), (None, e)} and len({t for i, t in kept if i == 7}) == 1


def test_near_stage_on_a_large_group(spark):
    """A candidate group beyond one share is compared whole: links across shares count, and texts near the group but below 0.8 stay."""
    rng = random.Random(18)
    base = [f"w{k}" for k in range(300)]
    rows = []
    for i in range(600):
        t = list(base)
        for at in rng.sample(range(300), 1 if i < 500 else 12):
            t[at] = f"v{i}.{at}"
        rows.append((i, " ".join(t)))
    kept = set(texts(C.near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string"), SF)))
    sets = [{tuple(t.split()[i : i + 5]) for i in range(296)} for _, t in rows]
    link = lambda x, y: len(x & y) >= 0.8 * len(x | y)
    label = list(range(600))
    for i in range(600):
        for j in range(i):
            if label[i] != label[j] and link(sets[i], sets[j]):
                a, b = sorted((label[i], label[j]))
                label = [a if x == b else x for x in label]
    assert kept == set(label) and len(kept) > 20


def test_benchmark_stage(planted, spark):
    docs, _, item = planted
    kept = texts(C.benchmark(spark, docs, SF))
    assert 900_007 not in kept and 900_008 in kept and not any(t and item in t.replace("\n", " ") for t in kept.values())


def test_run(spark):
    out = C.run(spark, SF).collect()
    assert out and {"doc_id", "piece", "length", "sequence_id", "offset"} <= set(out[0].asDict())
    encoder = Encoder(tokenizer_path())
    assert encoder.encode(["a"])


def test_entry_without_llm(tmp_path):
    """The library and the registry stand without the llm folders and the pipeline."""
    import shutil
    import subprocess
    import sys
    from pathlib import Path

    root = Path(__file__).resolve().parents[2]
    shutil.copytree(root / "spanloom", tmp_path / "spanloom", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    done = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; assert e.queries() and not any(k.startswith('op') for k in e.queries()) and e.oracle_sql()"], cwd=tmp_path, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr


def test_input_columns_and_odd_rows_survive(spark):
    """Columns named like what an operator adds keep their values; null, empty and repeated rows and an empty table are no error."""
    base = load(spark, SF, "documents").limit(40)
    more = "'mine' as score, 'mine' as lang_pred, 'mine' as lang_accepted, 7 as lines_removed, 'mine' as hits, 'mine' as component_id".split(", ")
    odd = spark.createDataFrame([(910_001, None, "en", "s", None), (910_002, "", "en", None, 0), (910_003, " \n ", None, "s", 3)], base.schema)
    docs = base.unionByName(odd).unionByName(base.limit(3)).selectExpr("*", *more)
    for _, stage in C.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns
        assert {(r.score, r.lang_pred, r.lang_accepted, r.lines_removed, r.hits, r.component_id) for r in out.collect()} == {("mine",) * 3 + (7,) + ("mine",) * 2}
        assert stage(spark, docs.limit(0), SF).count() == 0
