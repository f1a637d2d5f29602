"""Quality rules, centroid clustering and conversation repair against brute force, and their edge cases."""

from __future__ import annotations

import hashlib
import itertools
import math
import random
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from spanloom.llm import centroids as ce
from spanloom.llm import conversation_repair as cr
from spanloom.llm import quality_rules as qr
from spanloom.llm.common import held_out, load
from spanloom.llm.decontaminate import matches
from spanloom.llm.html_extract import extract_main_text, main_text, visible_text
from spanloom.llm.warc import build_derivatives, responses

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# ---------------------------------------------------------------- quality rules


def rule_counts(text: str | None) -> tuple:
    text = text or ""
    w = WORD.findall(text)
    windows = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    often = Counter(windows)
    hit = {i + k for i, g in enumerate(windows) if often[g] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    failed = len(w) < 10 or 100 * len(hit) > 20 * len(w)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(hit), failed


def grams(text: str | None) -> list[int]:
    c = [zlib.crc32(w.encode()) for w in WORD.findall(text or "")]
    return [x % qr.BUCKETS for x in c] + [(a * 31 + b) % qr.BUCKETS for a, b in zip(c, c[1:])]


TEXTS = [
    None, "", " \n\t ", "one", "a b c d e", "a b c d e a b c d e", "x y z w v " * 30, "same line here\nsame line here\n\nother\x0bline\fhere | # $",
    "ä ö ü ß é " * 4 + "end", "w1 w2 w3 w4 w5 w6 w7 w8 w9 w10 w11", "b b b b b b", "p q r s t u p q r s t v q r s t u", " ".join(f"n{i}" for i in range(30_000)) + " n1 n2 n3 n4 n5",
]


def test_rule_counts(spark):
    rows = spark.createDataFrame([(i, t, "x") for i, t in enumerate(TEXTS)], "doc_id long, text string, n_words string")
    model = qr.RatioModel([0] * qr.BUCKETS, 0)
    out = {r["doc_id"]: r for r in qr.apply_rules(rows, model).collect()}
    for i, t in enumerate(TEXTS):
        r = out[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == rule_counts(t), i
        assert r["text"] == t and r["kept"] == (not r["base_failed"])
    assert qr.apply_rules(rows.limit(0), model).count() == 0


def test_ratio_against_brute_force(spark, sf_dir):
    docs, labels = load(spark, sf_dir, "documents").select("doc_id", "text"), load(spark, sf_dir, "labels").filter(~held_out("doc_id"))
    model = qr.fit_ratio_model(docs, labels)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    by = {}
    for r in labels.collect():
        by.setdefault(r["doc_id"], []).append(r["quality"])
    good = [i for i, y in by.items() if set(y) == {1}]
    back = {i for i in good if zlib.crc32(str(i).encode()) // 3 % 4 == 0}
    raw, trusted = Counter(), Counter()
    for i, t in texts.items():
        raw.update(g := grams(t))
        if i in good and i not in back:
            trusted.update(g)
    n, m = sum(raw.values()) + qr.BUCKETS, sum(trusted.values()) + qr.BUCKETS
    weights = [round(math.log((trusted[b] + 1) * n / ((raw[b] + 1) * m)) * 1000) for b in range(qr.BUCKETS)]
    assert max(abs(a - b) for a, b in zip(weights, model.weights)) <= 1
    score = lambda t: math.floor(sum(model.weights[b] for b in g) / len(g)) if (g := grams(t)) else None
    assert model.least == min(s for i in back if (s := score(texts[i])) is not None)
    for r in qr.apply_rules(docs, model).collect():
        assert r["ratio"] == score(r["text"])
        assert r["kept"] == (not r["base_failed"] and (r["ratio"] or 0) >= model.least)


def test_ratio_without_trusted_documents(spark):
    docs = spark.createDataFrame([(1, "a b c d e f g h i j k"), (2, None), (None, "x")], "doc_id long, text string")
    none = spark.createDataFrame([(None, 1), (1, None)], "doc_id long, quality int")
    kept = {r["doc_id"]: r["kept"] for r in qr.apply_rules(docs, qr.fit_ratio_model(docs, none)).collect()}
    assert kept == {1: True, 2: False, None: False}
    assert qr.apply_rules(docs.limit(0), qr.fit_ratio_model(docs.limit(0), none)).collect() == []


# ---------------------------------------------------------------- centroid clustering


def lloyd(rows: list, k: int, rounds: int, size: int) -> dict:
    kept = [(i, [math.floor(64 * x) for x in v]) for i, v in rows if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v)]
    c = [v for _, v in sorted(kept, key=lambda r: (hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))[:k]]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, x)), j) for j, x in enumerate(c))
    for _ in range(rounds):
        mine = [[] for _ in c]
        for _, v in kept:
            mine[near(v)[1]].append(v)
        c = [[sum(col) // len(m) for col in zip(*m)] if m else x for m, x in zip(mine, c)]
    found = [(i, *reversed(near(v))) for i, v in kept]
    inertia = Counter()
    for _, j, d in found:
        inertia[j] += d
    sha = lambda x: hashlib.sha256(",".join(map(str, x)).encode()).hexdigest()
    return Counter((i, j, d, inertia[j], sum(inertia.values()), sha(c[j])) for i, j, d in found)


@pytest.mark.parametrize("seed", range(3))
def test_clusters_against_brute_force(spark, seed):
    rng = random.Random(seed)
    middles = [[rng.uniform(-1, 1) for _ in range(4)] for _ in range(5)]
    rows = [(i, [x + rng.gauss(0, 0.1) for x in rng.choice(middles)]) for i in range(300)]
    rows += [(1000 + i, rows[0][1]) for i in range(200)] + [(7, None), (8, [1.0] * 3), (9, [1.0, None, 0.0, 0.0]), (10, [math.nan] * 4), (11, [math.inf] * 4), (None, [0.0] * 4), (3, [0.5] * 4), (3, [0.5] * 4)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "'x' as cluster").repartition(3)
    out = ce.cluster_centroids(df, k=6, rounds=3, size=4)
    assert Counter(map(tuple, out.collect())) == lloyd(rows, 6, 3, 4)


def test_few_equal_and_no_vectors(spark):
    same = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(5)], "vec_id long, embedding array<float>")
    out = ce.cluster_centroids(same, k=3, size=2).collect()
    assert {(r["cluster"], r["distance"], r["inertia"]) for r in out} == {(0, 0, 0)} and len(out) == 5
    assert ce.cluster_centroids(same.filter("vec_id = 2"), k=3, size=2).count() == 1
    empty = ce.cluster_centroids(same.limit(0), k=3, size=2)
    assert empty.collect() == [] and empty.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    with pytest.raises(Exception, match="too large"):
        ce.cluster_centroids(spark.createDataFrame([(1, [1e30, 0.0])], "vec_id long, embedding array<double>"), size=2).collect()


def test_trees_keep_their_promises_and_prune():
    rng = np.random.default_rng(3)
    x = np.floor(64 * np.concatenate([m + rng.normal(0, 0.05, (150, 64)) for m in rng.normal(0, 0.4, (8, 64))])).astype(np.int64)
    order, nodes = ce.cover_tree(x)
    assert sorted(order) == list(range(len(x)))
    y = x[order]
    for first, end, low, high, radius in nodes:
        first, end, low, high = map(int, (first, end, low, high))
        assert np.sqrt(((y[first:end] - y[first]) ** 2).sum(axis=1)).max() <= radius + 1e-9
        if high:
            kids = nodes[low:high]
            assert kids[0][0] == first and kids[-1][1] == end and (kids[1:, 0] == kids[:-1, 1]).all()
            assert all(k[4] <= radius / ce.BASE + 1e-9 for k in kids)
            heads = y[kids[:, 0].astype(int)]
            for i, j in itertools.combinations(range(min(len(heads), 30)), 2):
                assert np.sqrt(((heads[i] - heads[j]) ** 2).sum()) > radius / ce.BASE
    c = x[rng.choice(len(x), 16, replace=False)]
    of, best, exact = ce.nearest(y, nodes, c, ce.centroid_tree(c))
    d = ((y[:, None] - c[None]) ** 2).sum(axis=2)
    assert (of == d.argmin(axis=1)).all() and (best == d.min(axis=1)).all()
    assert exact < len(x) * 16 / 2  # less than half of all pairs are compared


# ---------------------------------------------------------------- conversation repair


def cheapest(rows: list[tuple[str, str]]) -> tuple[int, str, list[str]]:
    """(cost, audit, repaired lines) by trying every edit of every row and up to two insertions in each gap."""
    seen, choices = set(), []
    for role, text in rows:
        fault = cr.fault_of(role, text, seen)
        more = 5 if fault == "truncated" else 0
        options = [("D", 2, None)]
        if fault not in ("blank", "duplicate"):
            options += [("K", more, f"{role}:{text}")] + [("R", 1 + more, f"{r}:{text}") for r in ("user", "assistant")]
        choices += [[(), *[(r,) for r in ("user", "assistant")], *itertools.product(("user", "assistant"), repeat=2)], options]
    choices.append(choices[0] if choices else [()])
    best = None
    for pick in itertools.product(*choices):
        cost, audit, out = 0, "", []
        for k, p in enumerate(pick):
            if k % 2 == 0:
                cost, audit, out = cost + 5 * len(p), audit + "I" * len(p), out + [f"{r}:" for r in p]
            else:
                cost, audit = cost + p[1], audit + p[0]
                out = out + [p[2]] if p[2] is not None else out
        if re.fullmatch("(s?(ua)+)?", "".join(x[0] for x in out)) and (best is None or (cost, audit) < best[:2]):
            best = cost, audit, out
    return best


def test_repair_against_brute_force():
    rng = random.Random(5)
    for _ in range(60):
        rows = [(rng.choice(["system", "user", "assistant", "tool", ""]), rng.choice(["A.", "b?", "cut", "", "C!"])) for _ in range(rng.randint(0, 3))]
        cost, audit, out = cheapest(rows)
        got = cr.repair([(i, *r) for i, r in enumerate(rows)])
        assert got[5:] == (cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest()), rows


ROWS = [
    (1, 0, "user", "Hi."), (1, 1, "assistant", "Yes."), (1, 1, "assistant", "Yes."), (2, None, None, None), (2, 5, "user", None), (None, 1, "user", "q?"), (None, 2, "assistant", "a."),
    (3, 0, "assistant", "no"), (4, 3, "system", "S."), (4, 9, "user", "x" * 50_000), (4, 9, "tool", "?"), *[(5, i % 40, ("user", "assistant", "system")[i % 3], f"t {i % 11}{'.!?x'[i % 4]}") for i in range(90)],
    *[(6, i, ("user", "assistant")[i % 2], "again.") for i in range(30)],
]


def expected(rows: list[tuple]) -> list[tuple]:
    convs: dict = {}
    for conv, turn, role, text in rows:
        kept = convs.setdefault(conv, [])
        f = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if f == 1 else re.sub("[.!?]", "", text) if f == 2 else text
        kept += [(turn, "user" if f == 4 else role, text)] * (0 if f == 0 else 2 if f == 3 else 1)
    return [(c, *cr.repair(sorted(r, key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2])))) for c, r in convs.items()]


@pytest.mark.parametrize("how", [{}, {"long_rows": 2, "piece": 3, "fan": 2}, {"long_rows": 40, "piece": 7, "fan": 3}])
def test_repair_on_both_paths(spark, how):
    df = spark.createDataFrame(ROWS, "conv_id long, turn long, role string, text string").selectExpr("*", "1 as cost", "2 as times").repartition(5)
    out = sorted(map(tuple, cr.repair_conversations(df, **how).collect()), key=repr)
    assert out == sorted(expected(ROWS), key=repr)
    assert cr.repair_conversations(df.limit(0), **how).collect() == []


def test_empty_hash_of_dropped_conversation(spark):
    gone = next((c, t) for c in range(50) for t in range(3) if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0)
    r = cr.repair_conversations(spark.createDataFrame([(*gone, "user", "x.")], "conv_id long, turn long, role string, text string")).first()
    assert tuple(r) == (gone[0], 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


# ---------------------------------------------------------------- deep pages, long documents


DEEP = ["<div>" * 1200 + "Text, here.", "<p>" + "<b>" * 2000 + "x", "<p>" + "<b>x, y. " * 2000, "<div>a, b. " * 5000 + "</div></span>" * 5000, "<div class='sidebar'>x, y. " * 3000, "<article><header>" * 1500 + "<h1>T</h1><p>Some text, here."]


@pytest.mark.parametrize("page", DEEP, ids=range(len(DEEP)))
def test_deep_pages_are_read(page):
    words = WORD.findall(re.sub("<[^>]*>", " ", page))
    assert WORD.findall(visible_text(page)) == words
    assert set(WORD.findall(main_text(page))) <= set(words)


def test_memory_grows_with_the_page_and_not_with_its_depth():
    def peak(page: str) -> int:
        tracemalloc.start()
        main_text(page)
        found = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return found

    assert peak("<div>a, b. " * 8000) < 6 * peak("<div>a, b. " * 2000)


def test_one_deep_page_leaves_the_others_alone(spark):
    pages = spark.createDataFrame([(1, DEEP[0]), (2, "<body><p>Good text, really.</p></body>"), (3, DEEP[3])], "page_id long, html string")
    out = {r["page_id"]: r["text"] for r in extract_main_text(pages).collect()}
    assert out[1] == "Text, here." and out[2] == "Good text, really." and len(out) == 3
    assert build_derivatives(responses(pages.withColumn("url", F.lit("http://a.example/"))).select("page_id", "record")).count() == 6


def test_long_documents_on_both_decontamination_paths(spark):
    item = " ".join(f"k{i}" for i in range(20))
    text = " ".join(f"w{i % 977}" for i in range(150_000)) + " " + item + " tail " + item
    docs = spark.createDataFrame([(1, text), (2, None), (None, item)], "doc_id long, text string")
    bench = spark.createDataFrame([(1, item), (2, "K3 k4 k5"), (3, None)], "item_id long, text string")
    a, b = (sorted(map(tuple, matches(docs, bench, **how).select("__id", "n_words", "n_hit", "hits", "items").collect()), key=repr) for how in ({}, {"max_broadcast": 0}))
    assert a == b
    assert {r[0]: r[1:3] for r in a} == {1: (150_041, 40), 2: (0, 0), None: (20, 20)}
