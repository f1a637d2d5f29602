"""SimHash near-duplicates: tiled exact comparison of all fingerprints.

Fingerprints are made distinct, sorted by their bit counts and cut into blocks;
block pairs whose bit counts can't be within the radius are never formed.
Inside a block pair, small tiles are compared with numpy exclusive-or and bit
counts, again skipping tile pairs whose bit counts (of the whole and of four
16-bit lanes) differ beyond the radius.  Each block pair yields a spanning
forest of its links with bounded degree, never all pairs of a group, and
:mod:`.components` joins the forests.

Near copies (:func:`keep_one_per_component`) are pairs of shingle sets, without repeats, with a
given Jaccard similarity.  Fingerprints within a wide radius and of sets whose
sizes allow it only name candidates; the sets themselves are compared before a
pair counts as a link.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import append_columns, materialize, release
from .components import connected_components

_UPPER = bytes(range(65, 91))
_LOWER_TABLE = bytes.maketrans(_UPPER, _UPPER.lower())
LANES = 4
FANOUT = 16


def shingle_hashes(text: str, shingle: int = 4, seed: int = 42) -> np.ndarray:
    """XXH64 of each word shingle in text order, repeats included; a shorter text is one shingle, one without words none."""
    tokens = text.encode("utf-8", "surrogatepass").translate(_LOWER_TABLE).split()
    if not tokens:
        return np.zeros(0, dtype="<u8")
    digest = xxhash.xxh64_intdigest
    shingles = zip(*(tokens[i:] for i in range(shingle)), strict=False) if len(tokens) > shingle else [tokens]
    return np.array([digest(b" ".join(t), seed) for t in shingles], dtype="<u8")


def simhash_of(hashes: np.ndarray, words: int = 1) -> np.ndarray:
    """``words`` 64-bit words of SimHash: the first takes the votes of the hashes, each further one those of the hash mixed once more."""
    if not len(hashes):
        return np.zeros(words, dtype=np.uint64)
    out = []
    for word in range(words):
        if word:
            hashes = (hashes ^ (hashes >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            hashes = (hashes ^ (hashes >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
        votes = np.zeros(64, dtype=np.int64)
        for at in range(0, len(hashes), 16384):
            part = hashes[at : at + 16384]
            votes += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        out.append(np.packbits(2 * votes > len(hashes), bitorder="little").view("<u8")[0])
    return np.array(out, dtype=np.uint64)


def fingerprint(text: str, shingle: int = 4, seed: int = 42, words: int = 1, distinct: bool = False) -> np.ndarray:
    """SimHash of the word shingles (repeats count unless ``distinct``) in ``words`` 64-bit words; zero for a text without words."""
    hashes = shingle_hashes(text, shingle, seed)
    return simhash_of(np.unique(hashes) if distinct else hashes, words)


def with_fingerprints(docs: DataFrame, text_col: str = "text", shingle: int = 4, seed: int = 42, words: int = 1) -> DataFrame:
    """``docs`` plus ``simhash`` (binary: the words, big-endian).  Null text: zero."""

    def make():
        def run(texts: list[str]) -> list[list]:
            return [[fingerprint(t, shingle, seed, words).astype(">u8").tobytes() for t in texts]]

        return run

    return append_columns(docs, text_col, [("simhash", "binary")], make)


def counts_of(fps: np.ndarray) -> np.ndarray:
    """Bit counts of the fingerprints (rows of words): of the whole, then of the four 16-bit lanes of all words together."""
    lanes = np.bitwise_count(np.ascontiguousarray(fps).view("<u2").reshape(len(fps), -1, LANES)).sum(axis=1, dtype=np.int16)
    return np.concatenate([lanes.sum(axis=1, keepdims=True, dtype=np.int16), lanes], axis=1)


def fold(labels: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Labels (each the smallest index known to be connected) after adding the links i-j."""
    while True:
        a, b = labels[i], labels[j]
        differ = a != b
        if not differ.any():
            return labels
        i, j, a, b = i[differ], j[differ], a[differ], b[differ]
        np.minimum.at(labels, np.maximum(a, b), np.minimum(a, b))
        while True:
            jumped = labels[labels]
            if np.array_equal(jumped, labels):
                break
            labels = jumped


def forest(labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (two index arrays) of a tree of bounded degree over each label's members."""
    size = np.bincount(labels, minlength=len(labels))
    members = np.flatnonzero(size[labels] > 1)
    members = members[np.argsort(labels[members], kind="stable")]
    own = labels[members]
    first = np.r_[True, own[1:] != own[:-1]] if len(own) else np.zeros(0, dtype=bool)
    base = np.flatnonzero(first)[np.cumsum(first) - 1] if len(own) else np.zeros(0, dtype=np.int64)
    rank = np.arange(len(own)) - base
    child = rank > 0
    parent = base[child] + (rank[child] - 1) // FANOUT
    return members[child], members[parent]


def near(a: np.ndarray, b: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of two tiles whose fingerprints differ in at most ``radius`` bits: half of the words first (more for a wide radius), the rest where those allow it."""
    words = a.shape[1]
    lead = min(words, max(-(-words // 2), -(-radius // 24)))  # unrelated words differ in 32 bits
    differ = np.bitwise_count(a[:, None, 0] ^ b[None, :, 0])
    if 64 * lead > 255:
        differ = differ.astype(np.int16)
    for w in range(1, lead):
        differ = differ + np.bitwise_count(a[:, None, w] ^ b[None, :, w])
    i, j = np.nonzero(differ <= radius)
    if words > lead and len(i):
        total = differ[i, j] + np.bitwise_count(a[i, lead:] ^ b[j, lead:]).sum(axis=1, dtype=np.int64)
        i, j = i[total <= radius], j[total <= radius]
    return i, j


def sizes_allow(low: np.ndarray, high: np.ndarray, similarity: float) -> np.ndarray:
    """Whether sets of these sizes can have that Jaccard similarity."""
    return low >= similarity * high - 1e-9


def links_between(a: np.ndarray, b: np.ndarray | None, radius: int, tile: int = 512, similarity: float = 0.0) -> tuple[np.ndarray, np.ndarray]:
    """Bounded-degree forest of the links within ``a`` (b None) or between ``a`` and ``b``, given as rows of words.

    Both are sorted by bit counts; with a ``similarity`` the first word is the
    size of a set, both are sorted by it, and only sizes that allow the
    similarity link.  Returns two arrays of fingerprints; every
    pair of linked fingerprints ends in one tree.
    """
    both = a if b is None else np.concatenate([a, b])
    labels, prints = np.arange(len(both)), both[:, 1:] if similarity else both
    sizes = both[:, 0].astype(np.int64)
    counts = counts_of(prints)
    starts = [(s, min(s + tile, len(a))) for s in range(0, len(a), tile)]
    others = starts if b is None else [(s, min(s + tile, len(both))) for s in range(len(a), len(both), tile)]
    low = np.array([counts[s:e].min(axis=0) for s, e in others]).reshape(-1, LANES + 1)
    high = np.array([counts[s:e].max(axis=0) for s, e in others]).reshape(-1, LANES + 1)
    least, most = sizes[[s for s, _ in others]], sizes[[e - 1 for _, e in others]]
    held_i, held_j, held = [], [], 0
    for at, (s, e) in enumerate(starts):
        lo, hi = counts[s:e].min(axis=0), counts[s:e].max(axis=0)
        gap = np.maximum(0, np.maximum(low - hi, lo - high))  # least difference of each count
        can = (gap[:, 0] <= radius) & (gap[:, 1:].sum(axis=1) <= radius)
        if similarity:
            can &= sizes_allow(np.minimum(sizes[e - 1], most), np.maximum(sizes[s], least), similarity)
        met = np.flatnonzero(can)
        if b is None:
            met = met[met >= at]
        for k in met:
            s2, e2 = others[k]
            i, j = near(prints[s:e], prints[s2:e2], radius)
            i, j = i + s, j + s2
            keep = labels[i] != labels[j]
            if similarity:
                keep &= sizes_allow(np.minimum(sizes[i], sizes[j]), np.maximum(sizes[i], sizes[j]), similarity)
            if keep.any():
                held_i.append(i[keep])
                held_j.append(j[keep])
                held += len(held_i[-1])
                if held > 1 << 18:
                    labels = fold(labels, np.concatenate(held_i), np.concatenate(held_j))
                    held_i, held_j, held = [], [], 0
    if held:
        labels = fold(labels, np.concatenate(held_i), np.concatenate(held_j))
    child, parent = forest(labels)
    return both[child], both[parent]


def _rows(packed: bytes, words: int) -> np.ndarray:
    return np.frombuffer(packed, dtype=">u8").astype(np.uint64).reshape(-1, words)


def _packed(fps: np.ndarray) -> pa.Array:
    width = 8 * fps.shape[1]
    data = fps.astype(">u8").tobytes()
    return pa.Array.from_buffers(pa.binary(), len(fps), [None, pa.py_buffer(np.arange(0, len(data) + 1, width, dtype=np.int32).tobytes()), pa.py_buffer(data)])


#: Fingerprints in a block: about a sixteenth of all, between these bounds.  The upper one, half as much again, bounds what a task holds.
LEAST_BLOCK, MOST_BLOCK = 1 << 13, 1 << 16


def link_fingerprints(fps: DataFrame, radius: int = 4, words: int = 1, block: int | None = None, similarity: float = 0.0) -> DataFrame:
    """Distinct ``simhash`` values -> (u, v) edges that connect exactly the linked ones.

    With a ``similarity``, a value is the size of a set (a word of its own)
    followed by its fingerprint, and blocks of sizes too different for it are
    never compared.  A task holds two blocks of fingerprints and the links of a
    few tiles; which blocks meet is a join, nothing of it is on the driver.  An
    empty table has no edges.
    """
    spark = fps.sparkSession
    if similarity:
        words += 1

    def order_of(rows: np.ndarray) -> np.ndarray:
        return rows[:, :1].astype(np.int64) if similarity else counts_of(rows)

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = _rows(b"".join(batch.column(0).to_pylist()), words)
            keys = np.ascontiguousarray(order_of(rows).astype(">u4" if similarity else ">u2")).view("S4" if similarity else "S10").ravel().astype(object) if len(rows) else []
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([bytes(k).ljust(10, b"\0") for k in keys], pa.binary())], names=["simhash", "order"])

    ordered = materialize(fps.select("simhash").mapInArrow(keyed, "simhash binary, order binary"), "keyed")
    n = ordered.count()
    block = block or min(MOST_BLOCK, max(LEAST_BLOCK, n // 16))
    parts = max(1, -(-n // block))
    ranged = ordered.repartitionByRange(parts, "order", "simhash").sortWithinPartitions("order", "simhash")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        pid, k, held = TaskContext.get().partitionId(), 0, np.zeros((0, words), dtype=np.uint64)

        def out(part: np.ndarray) -> pa.RecordBatch:
            nonlocal k
            c = order_of(part)[:, 0]
            k += 1
            return pa.RecordBatch.from_pydict({"block": pa.array([(pid << 20) + k], pa.int64()), "low": pa.array([int(c.min())], pa.int32()), "high": pa.array([int(c.max())], pa.int32()), "fps": pa.array([part.astype(">u8").tobytes()], pa.binary())})

        for batch in batches:
            held = np.concatenate([held, _rows(b"".join(batch.column(0).to_pylist()), words)])
            while len(held) > 2 * block:
                yield out(held[:block])
                held = held[block:]
        for part in np.array_split(held, max(1, -(-len(held) * 2 // (3 * block)))):  # no block over 1.5 times the size, and no small rest
            if len(part):
                yield out(part)

    blocks = materialize(ranged.select("simhash").mapInArrow(pack, "block bigint, low int, high int, fps binary"), "blocks")
    cells = materialize(_cells(blocks.select("block", "low", "high"), radius, similarity), "cells")
    sides = cells.select("a", "b", F.explode(F.expr("if(a = b, array(struct(a as block, 0 as side)), array(struct(a as block, 0 as side), struct(b as block, 1 as side)))")).alias("x"))
    dealt = blocks.select("block", "fps").join(sides.select("a", "b", "x.*"), "block")

    def compare(key, table):
        rows = sorted(zip(table.column("side").to_pylist(), table.column("block").to_pylist(), table.column("fps").to_pylist(), strict=True))
        both = [_rows(f, words) for _, _, f in rows]
        u, v = links_between(both[0], both[1] if len(both) > 1 else None, radius, similarity=similarity)
        return pa.table({"u": _packed(u), "v": _packed(v)})

    # cells are few and small but slow: one task for each, not as many as their bytes suggest
    tasks = max(1, min(cells.count(), max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)))
    return dealt.repartition(tasks, "a", "b").groupBy("a", "b").applyInArrow(compare, "u binary, v binary")


def _cells(blocks: DataFrame, radius: int, similarity: float) -> DataFrame:
    """(a, b), a <= b: the pairs of blocks that may hold links, a joined with itself included.

    Blocks cover ranges of bit counts (of sizes, with a ``similarity``).  Each
    range is cut into the strips that it touches, and a range meets another by
    the strips that both touch, one of them widened by what links may differ in.
    """
    if similarity:
        strip = lambda c: F.floor(F.log(F.greatest(c, F.lit(1))) / F.lit(-math.log(similarity))).cast("int")
        wider = strip(F.col("high")) + 1
    else:
        strip = lambda c: c
        wider = F.col("high") + radius
    own = blocks.withColumn("strip", F.explode(F.sequence(strip(F.col("low")), strip(F.col("high")))))
    reached = blocks.select(*[F.col(c).alias(f"{c}2") for c in blocks.columns], F.explode(F.sequence(strip(F.col("low")), wider)).alias("strip"))
    if similarity:
        can = F.least("high", "high2") >= F.lit(similarity) * F.greatest("low", "low2") - 1e-9
    else:
        can = F.greatest(F.col("low2") - F.col("high"), F.col("low") - F.col("high2")) <= radius
    return own.join(reached, "strip").filter(can).select(F.least("block", "block2").alias("a"), F.greatest("block", "block2").alias("b")).distinct()


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = 4, shingle: int = 4, seed: int = 42, words: int = 1, block: int | None = None) -> DataFrame:
    """Every row with its ``fingerprint`` (16 hex digits for each of its ``words``) and ``component_id``.

    Two rows are linked when their fingerprints differ in at most ``radius``
    bits; ``component_id`` is the smallest id that links reach, the row's own
    included.

    Null or empty texts have fingerprint zero and link like any other.  Null
    ids never become a component's id unless it has no other (then null).
    Repeated rows each appear in the result.  Returned columns: the id,
    ``fingerprint``, ``component_id``; other input columns are not read.
    """
    base = docs.select(F.col(f"`{id_col}`").alias("__id"), F.col(f"`{text_col}`").alias("__text"))
    own = materialize(with_fingerprints(base, "__text", shingle, seed, words).select("__id", "simhash"), "fingerprints")
    distinct = materialize(own.groupBy("simhash").agg(F.min("__id").alias("first_id")), "distinct")
    edges = materialize(link_fingerprints(distinct.select("simhash"), radius, words, block), "links")
    roots = connected_components(edges)
    release(edges)
    rooted = distinct.join(roots.select(F.col("node").alias("simhash"), "root"), "simhash", "left").select("simhash", "first_id", F.coalesce("root", "simhash").alias("root"))
    rooted = materialize(rooted, "rooted")
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    classes = materialize(rooted.join(least, "root").select("simhash", "component_id"), "classes")
    return own.join(classes, "simhash").select(F.col("__id").alias(id_col), F.lower(F.hex("simhash")).alias("fingerprint"), "component_id")


#: Members of a candidate group that are compared at a time: a sixteenth of the group, between these bounds.
LEAST_SHARE, MOST_SHARE = 128, 1024


def similar_pairs(of: list, sides: list, prints: np.ndarray, sets: list[np.ndarray], radius: int, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Bounded-degree forest of the pairs with the given Jaccard similarity among the rows of each group (``of``), only across sides where a group has two.

    Pairs within ``radius`` are candidates; each is decided by its two sets,
    unless decided ones connect its ends already.
    """
    root = list(range(len(sets)))

    def top(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    sizes = np.array([len(x) for x in sets], dtype=np.int64)
    groups: dict = {}
    for i, g in enumerate(of):
        groups.setdefault(g, ([], []))[sides[i]].append(i)
    for a, b in groups.values():
        a, b = np.array(a, dtype=np.int64), np.array(b or a, dtype=np.int64)
        within = len(a) and b[0] == a[0]
        if not len(a):
            continue
        i, j = near(prints[a], prints[b], radius)
        i, j = a[i], b[j]
        can = sizes_allow(np.minimum(sizes[i], sizes[j]), np.maximum(sizes[i], sizes[j]), similarity)
        if within:
            can &= i < j
        for x, y in zip(i[can].tolist(), j[can].tolist(), strict=True):
            p, q = top(x), top(y)
            if p != q:
                shared = len(np.intersect1d(sets[x], sets[y], assume_unique=True))
                if shared >= similarity * (len(sets[x]) + len(sets[y]) - shared) - 1e-9:
                    root[q] = p
    return forest(np.array([top(i) for i in range(len(sets))], dtype=np.int64))


def _verified_links(docs: DataFrame, id_col: str, text_col: str, members: DataFrame, n: int, radius: int, words: int, shingle: int, seed: int, similarity: float) -> DataFrame:
    """(u, v) edges between ``set_key``s of the same candidate group whose sets have the similarity.

    Only texts of candidates are read again.  A group larger than its share is
    compared in pairs of shares, so that no task holds a whole group.
    """
    spark = docs.sparkSession
    text = docs.select(F.col(f"`{id_col}`").alias("__id"), F.xxhash64(f"`{text_col}`").alias("__k"), F.col(f"`{text_col}`").alias("text"))
    on = text["__id"].eqNullSafe(members["rep_id"]) & (text["__k"] == members["rep_k"])
    found = text.join(members, on).select("set_key", "root", "node", "m", "text")

    def make():
        def run(texts: list[str]) -> list[list]:
            return [[np.unique(shingle_hashes(t, shingle, seed)).tobytes() for t in texts]]

        return run

    sets = append_columns(found, "text", [("hashes", "binary")], make).drop("text")
    share = F.least(F.lit(MOST_SHARE), F.greatest(F.lit(LEAST_SHARE), F.expr("int(m div 16)")))
    shares = F.when(F.col("m") <= 2 * LEAST_SHARE, F.lit(1)).otherwise(F.ceil(F.col("m") / share).cast("int"))
    sets = sets.withColumn("shares", shares).withColumn("part", F.expr("int(pmod(xxhash64(set_key, 7), shares))"))
    small = max(1, -(-n // LEAST_SHARE))  # groups of one share go together
    dealt = sets.withColumn("other", F.explode(F.expr("sequence(0, shares - 1)"))).select(
        "set_key", "root", "node", "hashes", F.expr("int(part > other)").alias("side"),
        F.expr(f"if(shares = 1, pmod(xxhash64(root, 3), {small}), xxhash64(root, least(part, other), greatest(part, other)))").alias("cell"),
    )

    def compare(key, table):
        columns = {c: table.column(c).to_pylist() for c in ("set_key", "root", "node", "hashes", "side")}
        rows = sorted({k: (r, s, k, f, h) for k, r, f, h, s in zip(columns["set_key"], columns["root"], columns["node"], columns["hashes"], columns["side"], strict=True)}.values())
        prints = _rows(b"".join(r[3] for r in rows), words + 1)[:, 1:]
        u, v = similar_pairs([r[0] for r in rows], [r[1] for r in rows], prints, [np.frombuffer(r[4], dtype="<u8") for r in rows], radius, similarity)
        return pa.table({"u": pa.array([rows[i][2] for i in u], pa.binary()), "v": pa.array([rows[i][2] for i in v], pa.binary())})

    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(n // LEAST_SHARE, 4 * spark.sparkContext.defaultParallelism))
    return dealt.repartition(tasks, "cell").groupBy("cell").applyInArrow(compare, "u binary, v binary")


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = 0.8, radius: int = 72, shingle: int = 5, seed: int = 42, words: int = 4, block: int | None = None) -> DataFrame:
    """(__id, __k, keep_id, keep_k): every row's id and text hash, and those of the row that its component keeps.

    Rows are linked when their sets of word shingles have a Jaccard similarity
    of ``similarity`` or more; sets are compared by the shingles' XXH64.  Pairs
    of different sets are compared where their fingerprints differ in at most
    ``radius`` bits.  Null and empty texts have the same, empty set.  A component
    keeps the row with the smallest id, then text hash; null ids are never kept
    as such (null if it has no other).
    """
    base = docs.select(F.col(f"`{id_col}`").alias("__id"), F.xxhash64(f"`{text_col}`").alias("__k"), F.col(f"`{text_col}`").alias("__text"))

    def make():
        def run(texts: list[str]) -> list[list]:
            keys, found = [], []
            for t in texts:
                own = np.unique(shingle_hashes(t, shingle, seed))
                keys.append(xxhash.xxh3_128_digest(own.tobytes()))
                found.append(np.r_[np.uint64(len(own)), simhash_of(own, words)].astype(">u8").tobytes())
            return [keys, found]

        return run

    own = materialize(append_columns(base, "__text", [("set_key", "binary"), ("node", "binary")], make).drop("__text"), "sets")
    row = F.struct("__id", "__k")
    distinct = materialize(own.groupBy("set_key", "node").agg(F.min(row).alias("rep"), F.min(F.when(F.col("__id").isNotNull(), row)).alias("keep")), "distinct")
    size = F.conv(F.hex(F.substring("node", 1, 8)), 16, 10).cast("long")
    # a set too small to be that similar to any other one is like itself only
    able = distinct.filter(size >= F.lit(similarity) * (size + 1) - 1e-9)
    edges = materialize(link_fingerprints(able.select(F.col("node").alias("simhash")).distinct(), radius, words, block, similarity), "links")
    roots = connected_components(edges)
    release(edges)
    rooted = materialize(able.select("set_key", "node", "rep").join(roots.select("node", "root"), "node", "left").withColumn("root", F.coalesce("root", "node")), "rooted")
    groups = materialize(rooted.groupBy("root").agg(F.count(F.lit(1)).alias("m")).filter("m > 1"), "groups")
    members = materialize(rooted.join(groups, "root").select("set_key", "root", "node", "m", F.col("rep.__id").alias("rep_id"), F.col("rep.__k").alias("rep_k")), "members")
    links = materialize(_verified_links(docs, id_col, text_col, members, members.count(), radius, words, shingle, seed, similarity), "verified")
    joined = connected_components(links)
    release(links)
    components = materialize(distinct.select("set_key", "keep").join(joined.select(F.col("node").alias("set_key"), "root"), "set_key", "left").withColumn("root", F.coalesce("root", "set_key")), "components")
    least = materialize(components.groupBy("root").agg(F.min("keep").alias("keep")), "least")
    classes = materialize(components.select("set_key", "root").join(least, "root").select("set_key", "keep"), "classes")
    return own.join(classes, "set_key").select("__id", "__k", F.col("keep.__id").alias("keep_id"), F.col("keep.__k").alias("keep_k"))


def keep_one_per_component(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """``docs`` without near copies: of each component of :func:`near_copies` the row with the smallest id (then text hash) stays.

    All input columns are kept.  A row is known by its id and a hash of its text:
    rows with other texts may share an id.  Rows with a null id stay: nothing
    identifies them as a copy of a kept row.
    """
    found = near_copies(docs, id_col, text_col, **how)
    gone = found.filter("__id <> keep_id or (__id is not null and __k <> keep_k)").select(F.col("__id").alias("__gid"), F.col("__k").alias("__gk")).distinct()
    on = (docs[f"`{id_col}`"] == gone["__gid"]) & (F.xxhash64(docs[f"`{text_col}`"]) == gone["__gk"])
    return docs.join(gone, on, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
