"""Exact Lloyd rounds by dual trees: a cover tree over each block of vectors, a tree over the centroids of each round.

Vectors are whole numbers, so sums, means and distances are exact and any order
of work gives the same result.  Blocks are cut from the input as it is read and
never grouped by a key: copies of one vector, however many, stay spread.  A
block's cover tree is built once and stored with it; each round sends the bounded
set of centroids out and brings one row of sums per cluster and task back.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, release

#: Vectors in a block, and in a leaf of a cover tree.
BLOCK, LEAF = 2048, 24
#: Radii of a cover tree shrink by this factor from level to level.  In many dimensions distances are alike, and halving would part a node into single points.
BASE = 1.3
#: Largest magnitude of a component: squared distances of 64 such numbers fit 64 bits.
LARGEST = 1 << 27
#: Distances are computed in floating point to prune; what is nearer than this share of them is not pruned by it.
MARGIN = 1e-9


def cover_tree(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, nodes): the points' order in which each node is a run of points, and a row (first, end, children's first, end, radius) per node.

    Node 0 covers all points; a node's first point in ``order`` is its centre and
    again the centre of its first child.  A child of a node of radius r covers
    points within r / BASE of its centre, and its centre is farther than that from the
    centres before it.  Points that equal a centre are never split, and nodes of up
    to :data:`LEAF` points have no children.  No recursion: depth is no limit.
    """
    order, nodes = np.arange(len(x)), []
    y = x.astype(np.float64)
    far = np.sqrt(((y - y[0]) ** 2).sum(axis=1)) if len(x) else np.zeros(0)
    nodes.append([0, len(x), 0, 0, far.max(initial=0.0)])
    waiting = [(0, far)]
    while waiting:
        at, dist = waiting.pop()
        first, end, _, _, radius = nodes[at]
        if end - first <= LEAF or radius == 0:
            continue
        left, away, to = order[first:end], dist, []
        centre, reach = left[0], radius / BASE
        while len(left):
            d = away if centre == order[first] else np.sqrt(((y[left] - y[centre]) ** 2).sum(axis=1))
            near = d <= reach
            mine, own = left[near], d[near]
            lead = np.flatnonzero(mine == centre)[0]
            swap = np.r_[lead, 0:lead, lead + 1 : len(mine)].astype(np.int64)
            to.append((mine[swap], own[swap]))
            left, away = left[~near], away[~near]
            if len(left):
                centre = left[np.argmax(away)]  # the farthest from the node's centre: far groups part early
        place, child = first, len(nodes)
        nodes[at][2:4] = child, child + len(to)
        for mine, own in to:
            order[place : place + len(mine)] = mine
            waiting.append((len(nodes), own))
            nodes.append([place, place + len(mine), 0, 0, own.max()])
            place += len(mine)
    return order, np.array(nodes, dtype=np.float64)


def centroid_tree(c: np.ndarray) -> np.ndarray:
    """Rows (left, right, centroid or -1, radius, *centre*): a binary tree whose leaves are single centroids."""
    y, rows, waiting = c.astype(np.float64), [], [(np.arange(len(c)), 0)]
    rows.append(None)
    while waiting:
        ids, at = waiting.pop()
        centre = y[ids].mean(axis=0)
        d = np.sqrt(((y[ids] - centre) ** 2).sum(axis=1))
        if len(ids) == 1:
            rows[at] = [0, 0, ids[0], 0.0, *y[ids[0]]]
            continue
        a = y[ids[np.argmax(d)]]
        b = y[ids[np.argmax(((y[ids] - a) ** 2).sum(axis=1))]]
        side = ((y[ids] - a) ** 2).sum(axis=1) <= ((y[ids] - b) ** 2).sum(axis=1)
        if side.all():  # equal centroids: any halves do
            side = np.arange(len(ids)) < len(ids) // 2
        rows[at] = [len(rows), len(rows) + 1, -1, d.max(), *centre]
        waiting += [(ids[side], len(rows)), (ids[~side], len(rows) + 1)]
        rows += [None, None]
    return np.array(rows, dtype=np.float64)


def nearest(x: np.ndarray, nodes: np.ndarray, c: np.ndarray, tree: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(cluster, squared distance) of each point of a block in tree order, and how many exact distances that took.

    Pairs of a vector node and a centroid node go down both trees together,
    level by level.  A pair whose least possible distance exceeds the largest that
    the vector node can have to its nearest centroid is pruned.  Pairs of leaves
    are compared by whole numbers; of equal distances the smaller number wins.
    """
    first, end, low, high = (nodes[:, k].astype(np.int64) for k in range(4))
    radius, y = nodes[:, 4], x.astype(np.float64)
    most = np.full(len(nodes), np.inf)
    q, t, met = np.zeros(1, np.int64), np.zeros(1, np.int64), []
    left, right, leaf_of, spread, centres = tree[:, 0].astype(np.int64), tree[:, 1].astype(np.int64), tree[:, 2].astype(np.int64), tree[:, 3], tree[:, 4:]
    while len(q):
        d = np.sqrt(((y[first[q]] - centres[t]) ** 2).sum(axis=1))
        np.minimum.at(most, q, (d + radius[q] + spread[t]) * (1 + MARGIN))
        alive = (d - radius[q] - spread[t]) * (1 - MARGIN) <= most[q]
        q, t = q[alive], t[alive]
        q_leaf, t_leaf = high[q] == 0, leaf_of[t] >= 0
        done = q_leaf & t_leaf
        met.append((q[done], leaf_of[t[done]]))
        q, t, q_leaf, t_leaf = q[~done], t[~done], q_leaf[~done], t_leaf[~done]
        down = ~t_leaf & (q_leaf | (spread[t] > radius[q]))  # the larger ball is opened
        by_t = (np.repeat(q[down], 2), np.stack([left[t[down]], right[t[down]]], axis=1).reshape(-1))
        n = high[q[~down]] - low[q[~down]]
        kids = np.repeat(low[q[~down]], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        np.minimum.at(most, kids, np.repeat(most[q[~down]], n))
        q, t = np.r_[by_t[0], kids], np.r_[by_t[1], np.repeat(t[~down], n)]
    q, t = (np.concatenate(a) for a in zip(*met, strict=True))
    best, of, exact = np.full(len(x), np.iinfo(np.int64).max), np.zeros(len(x), np.int64), 0
    for k in np.unique(t):  # in ascending order: an equal distance does not replace a smaller number
        mine = q[t == k]
        n = end[mine] - first[mine]
        at = np.repeat(first[mine], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        d = ((x[at] - c[k]) ** 2).sum(axis=1)
        exact += len(at)
        nearer = d < best[at]
        best[at[nearer]], of[at[nearer]] = d[nearer], k
    return of, best, exact


def kept_vectors(vectors: DataFrame, id_col: str, vector_col: str, size: int) -> DataFrame:
    """(__id, x): vectors of exactly ``size`` finite components, each as the whole number floor(64 * component)."""
    v = F.transform(F.col(f"`{vector_col}`"), lambda e: e.cast("double"))
    fine = F.forall(v, lambda e: F.coalesce(~F.isnan(e) & (F.abs(e) < float("inf")), F.lit(False)))
    rows = vectors.select(F.col(f"`{id_col}`").alias("__id"), v.alias("v")).filter((F.size("v") == size) & fine)
    whole = F.transform("v", lambda e: F.when(F.abs(e) * 64 < LARGEST, F.floor(e * 64)).otherwise(F.raise_error(F.lit("a component is too large for exact 64-bit distances"))).cast("int"))
    return rows.select("__id", whole.alias("x"))


def _blocks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[pa.Array, np.ndarray]]:
    waiting, n = [], 0
    for batch in batches:
        waiting.append(batch)
        n += len(batch)
        if n >= BLOCK:
            table = pa.Table.from_batches(waiting)
            whole = n - n % BLOCK
            for at in range(0, whole, BLOCK):
                yield _parts(table.slice(at, BLOCK), size)
            waiting, n = table.slice(whole).to_batches(), n - whole
    if n:
        yield _parts(pa.Table.from_batches(waiting), size)


def _parts(table: pa.Table, size: int) -> tuple[pa.Array, np.ndarray]:
    flat = table.column("x").combine_chunks().flatten()
    return table.column("__id").combine_chunks(), flat.to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, size)


def forest(kept: DataFrame, size: int) -> DataFrame:
    """One row per block: its ids and vectors in the order of its cover tree, and the tree."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, x in _blocks(batches, size):
            order, nodes = cover_tree(x)
            made = [pa.array([ids.take(pa.array(order)).to_pylist()], pa.list_(ids.type)), pa.array([x[order].astype("<i4").tobytes()]), pa.array([nodes.astype("<f8").tobytes()])]
            yield pa.RecordBatch.from_arrays(made, names=["ids", "x", "nodes"])

    return kept.mapInArrow(run, f"ids array<{kept.schema['__id'].dataType.simpleString()}>, x binary, nodes binary")


def _read(batch: pa.RecordBatch, i: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    x, nodes = (batch.column(batch.schema.get_field_index(k))[i].as_py() for k in ("x", "nodes"))
    return np.frombuffer(x, "<i4").astype(np.int64).reshape(-1, size), np.frombuffer(nodes, "<f8").reshape(-1, 5)


def cluster_sums(trees: DataFrame, centroids: np.ndarray) -> DataFrame:
    """(cluster, n, sums): one row per cluster that has vectors."""
    size, k = centroids.shape[1], len(centroids)
    names = [f"s{i}" for i in range(size)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, n, sums = centroid_tree(centroids), np.zeros(k, np.int64), np.zeros((k, size), np.int64)
        for batch in batches:
            for i in range(len(batch)):
                x, nodes = _read(batch, i, size)
                of, _, _ = nearest(x, nodes, centroids, tree)
                n += np.bincount(of, minlength=k)
                for j in np.unique(of):
                    sums[j] += x[of == j].sum(axis=0)
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(n[some]), *[pa.array(sums[some, i]) for i in range(size)]], names=["cluster", "n", *names])

    each = trees.select("x", "nodes").mapInArrow(run, "cluster int, n bigint, " + ", ".join(f"{c} bigint" for c in names))
    return each.groupBy("cluster").agg(F.sum("n").alias("n"), F.array(*[F.sum(c) for c in names]).alias("sums"))


def assigned(trees: DataFrame, centroids: np.ndarray) -> DataFrame:
    """(__id, cluster, distance) of every vector."""
    size = centroids.shape[1]
    kind = trees.schema["ids"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = centroid_tree(centroids)
        for batch in batches:
            for i in range(len(batch)):
                x, nodes = _read(batch, i, size)
                of, best, _ = nearest(x, nodes, centroids, tree)
                ids = batch.column(batch.schema.get_field_index("ids")).slice(i, 1).flatten()
                yield pa.RecordBatch.from_arrays([ids, pa.array(of.astype(np.int32)), pa.array(best)], names=["__id", "cluster", "distance"])

    return trees.mapInArrow(run, f"__id {kind}, cluster int, distance bigint")


def start_centroids(kept: DataFrame, k: int) -> np.ndarray:
    """The vectors of the ``k`` ids with the smallest SHA-256 of ``1:<id>``, in that order; a null id counts as no digits.

    Rows with the same id follow one another by their components.
    """
    key = F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col("__id").cast("string"), F.lit(""))), 256)
    return np.array([r["x"] for r in kept.select(key.alias("h"), "x").orderBy("h", "x").limit(k).collect()], dtype=np.int64)


def cluster_centroids(vectors: DataFrame, k: int = 16, rounds: int = 3, size: int = 64, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row per kept vector: its id, ``cluster``, ``distance``, ``cluster_inertia``, ``inertia`` and ``centroid_sha256``.

    Kept are vectors of exactly ``size`` components of which none is null or
    non-finite; a null vector is not kept.  With fewer than ``k`` vectors each is a
    centroid; with none the result is empty.  Rows with a null id, repeated rows and
    repeated ids are vectors of their own.  Equal distances go to the smaller
    number, so a centroid that equals an earlier one stays empty and where it is.
    A component whose 64-fold reaches 2**27 raises an error, as its squared distances would
    not fit the result's type.  Other input columns are ignored.
    """
    kept = kept_vectors(vectors, id_col, vector_col, size)
    centroids = start_centroids(kept, k)
    if not len(centroids):
        empty = kept.limit(0)
        return empty.select(F.col("__id").alias(id_col), *[F.lit(None).cast(t).alias(c) for c, t in (("cluster", "int"), ("distance", "bigint"), ("cluster_inertia", "bigint"), ("inertia", "bigint"), ("centroid_sha256", "string"))])
    trees = materialize(forest(kept, size), "cover-trees")
    for _ in range(rounds):
        centroids = centroids.copy()
        for r in cluster_sums(trees, centroids).collect():  # one row per cluster
            centroids[r["cluster"]] = [s // r["n"] for s in r["sums"]]
    found = materialize(assigned(trees, centroids), "assigned")
    release(trees)
    totals = {r["cluster"]: int(r["d"]) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("d")).collect()}
    facts = [(j, totals[j], sum(totals.values()), hashlib.sha256(",".join(map(str, centroids[j].tolist())).encode()).hexdigest()) for j in sorted(totals)]
    known = vectors.sparkSession.createDataFrame(facts, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return found.join(F.broadcast(known), "cluster").select(F.col("__id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
