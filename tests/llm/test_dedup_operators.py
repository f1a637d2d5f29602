"""Packing, line dedup, SimHash, exact dedup, decontamination and WARC against brute force, with odd rows."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from spanloom.llm import decontaminate as D
from spanloom.llm import exact_dedup as E
from spanloom.llm import line_dedup as LD
from spanloom.llm import packing as P
from spanloom.llm import simhash as S
from spanloom.llm import warc as Wc
from spanloom.llm.common import load
from spanloom.llm.components import connected_components
from spanloom.llm.queries import oracle_sql, queries, tokenizer_path

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def sample(spark):
    docs = load(spark, SF, "documents")
    return docs, {r.doc_id: r.text for r in docs.collect()}


# ----------------------------------------------------------------- packing


def brute_fullest(counts, room):
    best = {0: []}
    for k, n in counts.items():
        for _ in range(n):
            for s, items in list(best.items()):
                if s + k <= room and s + k not in best:
                    best[s + k] = [*items, k]
    return max(best)


@settings(deadline=None)
@given(st.dictionaries(st.integers(1, 30), st.integers(1, 4), max_size=6), st.integers(0, 60))
def test_subset_sum_is_fullest(counts, room):
    found = P.fullest(counts, room)
    assert sum(found) == brute_fullest(counts, room) and not Counter(found) - Counter(counts)


@settings(deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 200), max_size=20))
def test_plan_places_every_piece_once(histogram):
    plan = P.plan_bins(histogram, 64)
    assert all(sum(b) <= 64 for b, _ in plan)
    placed = Counter()
    for b, times in plan:
        for k in b:
            placed[k] += times
    assert placed == Counter(histogram)
    seen = defaultdict(list)
    for k, first, last, uses, bin_, offset in P.slots_of(plan):
        for r in range(first, last):
            seen[bin_ + (r - first) // uses].append((offset + (r - first) % uses * k, k))
    for items in seen.values():
        at = 0
        for o, k in sorted(items):
            assert o == at
            at += k


def test_pieces():
    assert P.pieces_of(5, 4) == [(0, 1), (1, 4)] and P.pieces_of(8, 4) == [(0, 4), (4, 4)] and P.pieces_of(4, 4) == [(0, 4)]


@settings(deadline=None, max_examples=200)
@given(st.text(alphabet="ab é.\n\t 　'1,", max_size=40))
def test_cached_encoding_is_the_tokenizers(text):
    own, plain = test_cached_encoding_is_the_tokenizers.pair
    assert np.frombuffer(own.encode([text])[0], "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids


test_cached_encoding_is_the_tokenizers.pair = (lambda e: (e, e.tokenizer))(P.Encoder(tokenizer_path(), most=50))


@pytest.mark.parametrize("text", ["<|endoftext|>", "a <|endoftext|> b", "x<|endoftext|>y, z.", "<|endoftext", "plain words, only."])
def test_added_tokens_are_the_tokenizers(text):
    from tokenizers import Tokenizer

    want = Tokenizer.from_file(tokenizer_path()).encode(text, add_special_tokens=False).ids
    assert np.frombuffer(P.Encoder(tokenizer_path(), most=50).encode([text])[0], "<u4").tolist() == want


class Lookups(dict):
    """Counts what is asked of it."""

    asked = 0

    def get(self, *args):
        self.asked += 1
        return super().get(*args)


def test_chunks_are_looked_up_once_a_call():
    """Each distinct chunk of a call, not each place where one stands."""
    encoder = P.Encoder(tokenizer_path())
    encoder.chunks = Lookups()
    texts = ["one two, three\nfour " * 50 + "end"] * 20
    want = encoder.tokenizer.encode(texts[0], add_special_tokens=False).ids
    assert [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(texts)] == [want] * 20
    assert encoder.chunks.asked == 5  # "one", " two,", " three\nfour", " one", " end"


@settings(deadline=None, max_examples=100)
@given(st.lists(st.text(alphabet="ab éĠ中\x00.\n\t '1,", max_size=12), max_size=8), st.integers(1, 5))
def test_texts_of_a_call_are_kept_apart(texts, block):
    """Texts that are empty or start or end with a space, side by side, with ids put in place in small blocks."""
    own = test_texts_of_a_call_are_kept_apart.encoder
    with pytest.MonkeyPatch.context() as m:
        m.setattr(P, "GATHER", block)
        found = own.encode(texts)
    assert [np.frombuffer(x, "<u4").tolist() for x in found] == [own.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


test_texts_of_a_call_are_kept_apart.encoder = P.Encoder(tokenizer_path(), most=20, most_words=20)


def test_packing(spark, sample):
    docs, texts = sample
    extra = spark.createDataFrame([(-1, None), (-2, ""), (-3, "word " * 9000), (-4, "<|endoftext|>"), (-4, "<|endoftext|>")], "doc_id long, text string")
    rows = P.pack_documents(docs.select("doc_id", "text").unionByName(extra).withColumn("piece", F.lit("clash")), tokenizer_path()).collect()
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    total = 0
    for items in bins.values():
        at = 0
        for o, n in sorted(items):
            assert o == at
            at += n
        assert at <= 2048
        total += at
    assert len(bins) <= -(-total // 2048) + 1
    encoder = P.Encoder(tokenizer_path()).tokenizer
    pieces = defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
    texts = texts | {-1: "", -2: "", -3: "word " * 9000}
    for doc, text in texts.items():
        ids = np.array([*encoder.encode(text, add_special_tokens=False).ids, 0], dtype="<u4")
        own = sorted(pieces[doc], key=lambda r: r.piece)
        assert [r.piece for r in own] == list(range(len(own))) and sum(r.length for r in own) == len(ids)
        assert all(r.length == 2048 for r in own[1:])
        for r in own:
            assert zlib.crc32(ids[r.start : r.start + r.length].tobytes()) == r.ids_crc32
    assert len(pieces[-4]) == 2
    assert P.pack_documents(extra.limit(0), tokenizer_path()).count() == 0


# -------------------------------------------------------------- line dedup


def brute_lines(docs, least):
    """Every run of ``least`` words with an earlier copy is cut, but for lines inside its earliest copy."""
    seqs = [(d, t, [x for x in (t or "").split("\n") if x.strip(" \t\n\x0b\x0c\r")]) for d, t in sorted(set(docs), key=lambda r: (r[0] is not None, r[0] or 0, xxh(r[1])))]
    first, gone = {}, defaultdict(set)
    for look in (True, False):
        for at, (_, _, lines) in enumerate(seqs):
            for p in range(len(lines)):
                n = 0
                for e in range(p, len(lines)):
                    n += len(lines[e].split())
                    if n >= least:
                        key = tuple(lines[p : e + 1])
                        if look:
                            first.setdefault(key, (at, p))
                        elif first[key] != (at, p):
                            gone[at].update(x for x in range(p, e + 1) if first[key][0] != at or x >= first[key][1] + len(key))
    out = {}
    for at, (d, t, _) in enumerate(seqs):
        kept, i = [], 0
        for line in (t or "").split("\n"):
            if line.strip(" \t\n\x0b\x0c\r"):
                if i not in gone[at]:
                    kept.append(line)
                i += 1
            else:
                kept.append(line)
        out[d, t] = None if t is None else "\n".join(kept)
    return out


def xxh(t):
    return np.uint64(xxhash.xxh64_intdigest((t or "").encode(), 42)).astype(np.int64) if t is not None else 42


def test_line_dedup_on_random_runs(spark):
    rng = random.Random(3)
    lines = ["a b c", "d e", "f", "g h i j", "", "k l m"]
    docs = [(i, "\n".join(rng.choice(lines) for _ in range(rng.randrange(0, 12)))) for i in range(60)] + [(100, None), (None, "a b c\nd e\nf\ng h i j"), (101, "\n\n"), (7000, "a b c\nd e\nf"), (7000, "a b c\nd e\nf")]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("lines_removed", F.lit("clash")).withColumn("__sid", F.lit(1)).withColumn("spans", F.lit(1)).withColumn("__spans", F.lit(1))
    want = brute_lines(docs, 6)
    got = LD.dedup_lines(df, min_words=6).collect()
    assert len(got) == len(docs)
    for r in got:
        key = next(k for k in want if k[0] == r.doc_id and (want[k] == r.text))
        assert want[key] == r.text
    assert Counter((r.doc_id, r.text) for r in got) == Counter((d, want[d, t]) for d, t in docs)
    assert LD.dedup_lines(df.limit(0), min_words=6).count() == 0


def test_repeats_within_one_document(spark):
    df = spark.createDataFrame([(1, "\n".join(["x y z"] * 5))], "doc_id long, text string")
    assert LD.dedup_lines(df, min_words=6).first()["text"] == "x y z\nx y z"  # the earliest run of six words stays whole


def test_overlapping_copies_and_chains(spark):
    line = " ".join("abcdefghij" * 2)
    docs = [(1, "\n".join([line] * 6)), (2, "\n".join([line] * 3)), (3, "p q\nr s\nt u\nv w\nx y"), (4, "r s\nt u\nv w\nz"), (5, "t u\nv w\nx y\np q\nr s\nt u"), (6, "o\nab cd\nef gh\nab cd\nef gh\nab cd\nef gh")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    for least in (6, 50):
        want = brute_lines(docs, least)
        assert {r.doc_id: r.text for r in LD.dedup_lines(df, min_words=least).collect()} == {d: want[d, t] for d, t in docs}
    assert texts_of(LD.dedup_lines(df, min_words=50))[1].count("\n") == 2  # 60 words in three lines stay


def texts_of(df):
    return {r.doc_id: r.text for r in df.collect()}


# ----------------------------------------------------------------- simhash


def test_fingerprint_by_definition():
    for text in ("The Quick brown fox jumps over it", "one two", "É x\ty\nz w", ""):
        words = re.findall(r"[^\x20\x09-\x0D]+", text.translate({i: i + 32 for i in range(65, 91)}))
        sh = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
        h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
        want = sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))
        assert int(S.fingerprint(text)[0]) == want


def brute_components(fps, radius):
    label = list(range(len(fps)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if sum(int(a ^ b).bit_count() for a, b in zip(fps[i], fps[j], strict=True)) <= radius:
                a, b = root(i), root(j)
                label[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(fps))]


@pytest.mark.parametrize(("words", "radius"), [(1, 4), (4, 44)])
def test_tiles_against_all_pairs(words, radius):
    rng = np.random.default_rng(5)
    base = rng.integers(0, 1 << 63, (30, words), dtype=np.uint64)
    near = base[rng.integers(0, 30, 170)] ^ (np.uint64(1) << rng.integers(0, 64, (170, words), dtype=np.uint64))
    fps = np.unique(np.concatenate([base, near]), axis=0)
    fps = fps[np.argsort(S.counts_of(fps)[:, 0], kind="stable")]
    want = brute_components(fps.tolist(), radius)
    at = {tuple(f): i for i, f in enumerate(fps.tolist())}
    label = np.arange(len(fps))
    half = len(fps) // 2
    for a, b in ((fps, None), (fps[:half], fps[half:])):
        label = np.arange(len(fps))
        parts = [S.links_between(a, b, radius, tile=16)] if b is None else [S.links_between(x, y, radius, tile=16) for x, y in ((a, b), (a, None), (b, None))]
        for u, v in parts:
            i, j = ([at[tuple(x)] for x in w.tolist()] for w in (u, v))
            label = S.fold(label, np.array(i, dtype=int), np.array(j, dtype=int)) if len(i) else label
        groups = lambda xs: {frozenset(np.flatnonzero(np.array(xs) == k)) for k in set(xs)}
        assert groups(label.tolist()) == groups(want)


def test_simhash_components(spark, sample):
    docs, texts = sample
    odd = [(900_001, None), (900_002, ""), (None, "a b c d e"), (900_003, "a b c d e"), (900_003, "a b c d e")]
    df = docs.select("doc_id", "text").unionByName(spark.createDataFrame(odd, "doc_id long, text string")).withColumn("fingerprint", F.lit(0))
    rows = S.simhash_components(df, block=64).collect()
    assert len(rows) == len(texts) + len(odd)
    every = [*texts.items(), *odd]
    fps = [S.fingerprint(t or "").tolist() for _, t in every]
    root = brute_components(fps, 4)
    least = {}
    for (d, _), k in zip(every, root, strict=True):
        least[k] = min((x for x in (least.get(k), d) if x is not None), default=None)
    want = Counter((d, f"{fp[0]:016x}", least[k]) for (d, _), fp, k in zip(every, fps, root, strict=True))
    assert Counter((r.doc_id, r.fingerprint, r.component_id) for r in rows) == want
    assert S.simhash_components(df.limit(0)).count() == 0


def test_components_of_long_chains(spark):
    edges = [(i, i + 1) for i in range(300)] + [(1000, 1001), (1001, 1000), (5, 5)]
    rng = random.Random(1)
    names = rng.sample(range(5000), 1002)
    df = spark.createDataFrame([(names[u], names[v]) for u, v in edges], "u long, v long")
    out = {r.node: r.root for r in connected_components(df).collect()}
    assert {out[names[i]] for i in range(301)} == {min(names[:301])} and out[names[1000]] == min(names[1000:1002])
    assert connected_components(df.limit(0)).count() == 0


# ------------------------------------------------------------- exact dedup


def test_exact_report(spark, sample):
    docs, texts = sample
    odd = [(900_001, None), (900_002, ""), (900_003, "a  b\tc"), (900_004, "a b c"), (None, "a b c"), (900_005, "a b d"), (900_004, "a b c"), (900_006, "x" * 200_000), (None, "lonely")]
    df = docs.select("doc_id", "text").unionByName(spark.createDataFrame(odd, "doc_id long, text string")).withColumn("kept", F.lit(1))
    groups, every = defaultdict(list), [*texts.items(), *odd]
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    for d, t in every:
        groups[norm(t)].append(d)
    want = Counter()
    for d, t in every:
        keep = min((x for x in groups[norm(t)] if x is not None), default=None)
        want[d, keep, len(groups[norm(t)]), d == keep, hashlib.sha256(norm(t).encode()).hexdigest()] += 1
    got = Counter((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in E.exact_report(df).collect())
    assert got == want
    assert E.exact_dedup(df).count() == sum(n for k, n in want.items() if k[3])
    assert E.exact_report(df.limit(0)).count() == 0


# --------------------------------------------------------- decontamination


def brute_hits(text, grams):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate({i: i + 32 for i in range(65, 91)}))
    hit, items = set(), set()
    for n in {len(g) for g in grams}:
        for i in range(len(w) - n + 1):
            found = grams.get(tuple(w[i : i + n]))
            if found:
                hit.update(range(i, i + n))
                items |= found
    return len(w), len(hit), sorted(items)


@pytest.mark.parametrize("most", [500_000, 0])
def test_matches(spark, most):
    item = " ".join(f"w{i}" for i in range(20))
    bench = [(1, item), (2, "short item É"), (3, None), (4, "..."), (5, "W3 w4 w5 w6 w7 w8 w9 w10 w11 w12 w13 w14 w15")]
    docs = [(1, f"x {item.upper()} y"), (2, "A Short, ITEM É!"), (3, "a short item é"), (4, None), (5, ""), (None, item), (6, "z " * 5000 + item), (7, "clean words only"), (7, "clean words only"), (8, f"{item} {item}")]
    grams = defaultdict(set)
    for k, t in bench:
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate({i: i + 32 for i in range(65, 91)}))
        n = min(13, len(w))
        for i in range(len(w) - n + 1) if n else []:
            grams[tuple(w[i : i + n])].add(str(k))
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("items", F.lit(1)).withColumn("hits", F.lit(1)).withColumn("__mid", F.lit(1))
    b = spark.createDataFrame(bench, "item_id long, text string")
    got = Counter((r["__id"], r.n_words, r.n_hit, tuple(r["items"])) for r in D.matches(d, b, max_broadcast=most).collect())
    assert got == Counter((k, n, h, tuple(i)) for k, t in docs for n, h, i in [brute_hits(t, grams)])
    kept = {r.doc_id for r in D.decontaminate(d, b, max_broadcast=most).collect()}
    assert kept == {3, 4, 5, 6, 7}
    cut = {r.doc_id: r for r in D.decontaminate(d, b, remove="spans", max_broadcast=most).collect()}
    assert cut[1].text == "x y" and cut[2].text == "A!" and cut[6].text.strip() == ("z " * 5000).strip() and cut[7].text == "clean words only" and cut[4].text is None
    assert D.matches(d.limit(0), b).count() == 0 and D.matches(d, b.limit(0)).filter("n_hit > 0").count() == 0


def test_matches_by_shuffle_carries_no_text(spark):
    """Beyond the broadcast's bounds, in windows or in bytes, the same rows come out, and no exchange of windows holds a document's words."""
    d, b = load(spark, SF, "documents"), load(spark, SF, "benchmark")
    d = d.unionByName(d.limit(3))
    want = Counter(map(str, D.matches(d, b).collect()))
    for bound in ({"max_broadcast": 0}, {"max_bytes": 100}):
        df = D.matches(d, b, **bound)
        assert Counter(map(str, df.collect())) == want
    plan = df._jdf.queryExecution().executedPlan().toString()
    keys = [line for line in plan.split("\n") if "hashpartitioning" in line]
    assert keys and not any("slice" in line for line in keys)


def test_exact_dedup_keeps_one_of_identical_rows(spark):
    rows = [(1, "a b", 1), (1, "a  b", 2), (2, "x", 3), (2, "x", 4), (None, "x", 5), (3, None, 6), (4, "", 7), (None, "q", 8), (None, "q", 9), (5, "solo", 1), (6, "solo two", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, z int")
    left = E.exact_dedup(df)
    assert left.columns == df.columns and Counter(r.doc_id for r in left.collect()) == Counter([1, 2, 3, None, 5, 6])
    report = E.exact_report(df).collect()
    assert len(report) == len(rows)
    kept, size = Counter(), {}
    for r in report:
        kept[r.text_sha256] += r.kept
        size[r.text_sha256] = r.group_size
    assert set(kept.values()) == {1} and sorted(size.values()) == [1, 1, 2, 2, 2, 3]
    assert E.exact_dedup(df.limit(0)).count() == 0 == E.exact_report(df.limit(0)).count()


def test_which_blocks_meet(spark):
    """The pairs of ranges are those of a loop over all pairs, for bit counts and for sizes of sets."""
    rng = random.Random(6)
    ranges = [(i, lo, lo + rng.randrange(4)) for i in range(60) for lo in [rng.randrange(1, 65)]]
    wide = [(i, lo, lo + rng.randrange(1 + lo)) for i in range(60) for lo in [int(10 ** rng.uniform(0, 6))]]
    for rows, similarity in ((ranges, 0.0), (wide, 0.8)):
        got = {tuple(r) for r in S._cells(spark.createDataFrame(rows, "block bigint, low int, high int"), 4, similarity).collect()}
        near = lambda x, y: min(x[2], y[2]) >= 0.8 * max(x[1], y[1]) - 1e-9 if similarity else max(y[1] - x[2], x[1] - y[2]) <= 4  # noqa: E731, B023
        assert got == {(x[0], y[0]) for x in rows for y in rows if x[0] <= y[0] and near(x, y)}
    assert S.link_fingerprints(spark.createDataFrame([], "simhash binary")).count() == 0


def test_very_long_and_repeated_rows(spark):
    """Line dedup and SimHash read whole texts; rows equal in id and text are one document."""
    line = " ".join(f"w{i}" for i in range(60))
    long = "\n".join(f"only {i} here" for i in range(30_000)) + "\n" + line
    df = spark.createDataFrame([(1, line), (2, long), (3, "x " * 200_000), (4, "x " * 200_000), (5, "solo"), (5, "solo"), (5, line + " more"), (None, None)], "doc_id long, text string")
    cut = {(r.doc_id, r.text is None or len(r.text)): r.lines_removed for r in LD.dedup_lines(df).collect()}
    assert cut[2, len(long) - len(line) - 1] == 1 and cut[1, len(line)] == 0
    found = S.simhash_components(df)
    by = {}
    for r in found.collect():
        by.setdefault(r.doc_id, []).append(r.component_id)
    assert found.count() == 8 and by[3] == by[4] == [3] and len(by[5]) == 3


def test_no_machine_local_folder_on_a_cluster(spark, monkeypatch):
    from spanloom.llm import common

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf = type("Conf", (), {"get": staticmethod(lambda key, default=None: default)})
        sparkContext = Context()

    with pytest.raises(ValueError, match=r"spark\.checkpoint\.dir"):
        common.shared_dir(Session())


# -------------------------------------------------------------------- warc


def _by_hand(data):
    """A record read by the format's rules alone: header lines up to an empty line, then Content-Length bytes and two line ends."""
    head, _, rest = data.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    fields = dict(x.split(": ", 1) for x in lines)
    n = int(fields["Content-Length"])
    assert first == "WARC/1.1" and rest[n:] == b"\r\n\r\n"
    return fields, rest[:n]


def test_warc_bytes_by_hand():
    import base64
    import hashlib

    data = Wc.response("http://a.example/x\r\nWARC-Type: forged", "<p>Hi.</p>", "2024-01-01T00:00:00Z", "7")
    fields, block = _by_hand(data)
    assert fields["WARC-Type"] == "response" and "%0D%0A" in fields["WARC-Target-URI"]
    assert fields["WARC-Block-Digest"] == "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()
    for made in Wc.derivatives(data):
        own, body = _by_hand(made["record"])
        assert own["WARC-Type"] == made["record_type"] and own["WARC-Refers-To"] == fields["WARC-Record-ID"]
        assert own["WARC-Block-Digest"] == "sha1:" + base64.b32encode(hashlib.sha1(body).digest()).decode() and own["WARC-Target-URI"] == fields["WARC-Target-URI"]


def test_warc_round_trip():
    data = Wc.response("http://a.example/é", "<p>Hi, <b>you</b>.</p>", "2024-01-01T00:00:00Z", "7")
    meta, conv = Wc.derivatives(data)
    head, block = Wc.parse(conv["record"])
    source = dict(Wc.parse(data)[0])
    assert block.decode() == "Hi, you." and dict(head)["WARC-Refers-To"] == source["WARC-Record-ID"] == meta["refers_to"]
    assert conv["payload_digest"] == source["WARC-Payload-Digest"] == Wc.digest(b"<p>Hi, <b>you</b>.</p>") and conv["block_digest"] == Wc.digest(block)
    fields = Wc.parse(meta["record"])[1].decode()
    assert "httpStatus: 200" in fields and "httpHeader-Content-Type: text/html; charset=utf-8" in fields and "digestVerified: true" in fields
    assert dict(Wc.parse(meta["record"])[0])["WARC-Concurrent-To"] == conv["record_id"] and Wc.derivatives(data) == [meta, conv]


def test_warc_codings():
    import gzip

    page = "<p>caf\xe9, ok.</p>".encode("latin-1")
    packed = gzip.compress(page)
    chunked = b"%x\r\n%b\r\n0\r\n\r\n" % (len(packed), packed)
    http = b"HTTP/1.1 404 Not Found\r\nContent-Type: text/html; charset=iso-8859-1\r\nContent-Encoding: gzip\r\nTransfer-Encoding: chunked\r\n\r\n" + chunked
    data = Wc.serialise([("WARC-Type", "response"), ("WARC-Record-ID", "<urn:x>"), ("WARC-Target-URI", "u")], http)
    meta, conv = Wc.derivatives(gzip.compress(data))
    assert Wc.parse(conv["record"])[1].decode() == "café, ok." and b"httpStatus: 404" in meta["record"]


def test_warc_rejects_the_rest():
    good = Wc.response("u", "x", "d")
    for data in (None, b"", b"junk", good[:-30], Wc.serialise([("WARC-Type", "request")], b""), b"\x1f\x8bjunk"):
        assert Wc.derivatives(data) == []


def test_warc_rows(spark):
    pages = spark.createDataFrame([(1, "u", "<p>a, b.</p>"), (2, None, None), (2, None, None), (None, "v", "x" * 100_000)], "page_id long, url string, html string").withColumn("record_type", F.lit(1))
    made = Wc.build_derivatives(Wc.responses(pages))
    rows = made.collect()
    assert len(rows) == 8 and made.columns.count("record_type") == 1 and all(Wc.parse(bytes(r.record)) for r in rows)
    import gzip

    member = Wc.gzip_members(made).first()
    assert gzip.decompress(bytes(member.member)) == bytes(member.record)
    assert Wc.build_derivatives(Wc.responses(pages.limit(0))).count() == 0


# --------------------------------------------------------------------- sql


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_sql(spark, name):
    import duckdb

    c = duckdb.connect()
    for t in ("documents", "benchmark"):
        c.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    df = queries()[name](spark, SF)
    cols = sorted(df.columns)
    ours = sorted(map(tuple, df.select(*cols).collect()), key=repr)
    assert ours == sorted(c.sql(oracle_sql()[name]).select(*cols).fetchall(), key=repr)
