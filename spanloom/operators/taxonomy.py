"""Taxonomy trees as adjacency tables: paths, statistics, sampling, expansion."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import bucket, path_weight
from ..sources.snapshots import Snapshots
from ..storage import stored


def paths(nodes: DataFrame) -> DataFrame:
    """Every root-to-leaf path in depth-first order: node_ids, labels, path_id (ids joined by an arrow), depth (nodes), dfs_key.

    Walked level by level, one join each, however many paths there are; a node
    that is its own ancestor is never reached from a root.
    """
    tree = stored(nodes.select("framework", "id", "parent_id", "en", "zh", "sib_pos"), "taxonomy")
    level = tree.filter("parent_id is null").select("framework", "id", F.array("id").alias("node_ids"), F.array("en").alias("labels_en"), F.array("zh").alias("labels_zh"), F.array("sib_pos").alias("dfs_key"))
    under = tree.filter("parent_id is not null").select("framework", F.col("parent_id").alias("above"), F.col("id").alias("next"), "en", "zh", "sib_pos")
    inner = under.select("framework", F.col("above").alias("id")).distinct()
    leaves = None
    while True:
        level = stored(level, "taxonomy-level")
        ends = level.join(inner, ["framework", "id"], "left_anti")
        leaves = ends if leaves is None else leaves.unionByName(ends)
        if level.join(inner, ["framework", "id"], "left_semi").isEmpty():
            break
        grown = level.join(under, (level["framework"] == under["framework"]) & (F.col("id") == F.col("above")))
        level = grown.select(level["framework"], F.col("next").alias("id"), *[F.array_append(a, F.col(b)).alias(a) for a, b in (("node_ids", "next"), ("labels_en", "en"), ("labels_zh", "zh"), ("dfs_key", "sib_pos"))])
    return leaves.select("framework", path_id(F.col("node_ids")).alias("path_id"), "node_ids", "labels_en", "labels_zh", F.size("node_ids").alias("depth"), "dfs_key")


def path_id(ids: Column) -> Column:
    return F.array_join(ids, "→")


def label_string(labels: Column) -> Column:
    return F.array_join(labels, " → ")


def statistics(nodes: DataFrame, found: DataFrame) -> DataFrame:
    """Per framework: distinct node ids, node rows, paths, largest, smallest and mean depth (a root has depth 1)."""
    n = nodes.groupBy("framework").agg(F.count_distinct("id").alias("total_nodes"), F.count(F.lit(1)).alias("node_rows"))
    d = found.groupBy("framework").agg(F.count(F.lit(1)).alias("total_paths"), F.max("depth").alias("max_depth"), F.min("depth").alias("min_depth"), F.avg("depth").alias("avg_depth"))
    return n.join(d, "framework")


def count_samples(draws: DataFrame) -> DataFrame:
    return draws.groupBy("framework", "path_id").agg(F.count(F.lit(1)).alias("n"))


def merge_counts(stored: DataFrame, delta: DataFrame) -> DataFrame:
    return stored.unionByName(delta).groupBy("framework", "path_id").agg(F.sum("n").alias("n"))


def count_statistics(counts: DataFrame) -> DataFrame:
    return counts.groupBy("framework").agg(F.sum("n").alias("total_samples"), F.count(F.lit(1)).alias("total_paths_tracked"), F.min("n").alias("min_count"), F.max("n").alias("max_count"), F.avg("n").alias("avg_count"))


def probabilities(found: DataFrame, counts: DataFrame) -> DataFrame:
    """Each path's weight and its share of its framework's weight; without any weight all shares are equal."""
    joined = found.select("framework", "path_id").join(counts, ["framework", "path_id"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    weighted = joined.withColumn("weight", path_weight(F.col("n")))
    # one row per framework, combined before the shuffle: a framework of many paths is no single task
    total = weighted.groupBy("framework").agg(F.sum("weight").alias("__total"), F.count(F.lit(1)).alias("__n"))
    share = F.when(F.col("__total") > 0, F.col("weight") / F.col("__total")).otherwise(1 / F.col("__n"))
    return weighted.join(total, "framework").withColumn("probability", share).select("framework", "path_id", "n", "weight", "probability")


def stretches(rows: DataFrame, group: str, *order: str) -> DataFrame:
    """``rows`` stored in ranges of (group, order), the range's number in ``__part``: a group of many rows lies in many ranges."""
    return stored(rows.repartitionByRange(group, *order).withColumn("__part", F.spark_partition_id()), "stretches")


def prefix(rows: DataFrame, group: str, order: str, value: str | None = None) -> DataFrame:
    """``rows`` with ``place`` (from 0, by ``order`` within the group) and, for a ``value``, ``upto``: its sum to this row.

    Two levels: sums within each range, and sums of the ranges before it, of which
    there is one row per range.  No group is ever sorted by one task.
    """
    cut = stretches(rows, group, order)
    within = W.partitionBy(group, "__part").orderBy(order)
    amount = F.col(value) if value else F.lit(0.0)
    parts = cut.groupBy(group, "__part").agg(F.count(F.lit(1)).alias("__n"), F.sum(amount).alias("__v"))
    before = W.partitionBy(group).orderBy("__part").rowsBetween(W.unboundedPreceding, -1)
    base = parts.select(group, "__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__base_n"), F.coalesce(F.sum("__v").over(before), F.lit(0.0)).alias("__base_v"))
    own = cut.withColumn("__at", F.row_number().over(within) - 1).withColumn("__sum", F.sum(amount).over(within.rowsBetween(W.unboundedPreceding, 0)))
    out = own.join(base, [group, "__part"]).withColumn("place", F.col("__base_n") + F.col("__at"))
    out = out.withColumn("upto", F.col("__base_v") + F.col("__sum")) if value else out
    return out.select(*rows.columns, "place", *(["upto"] if value else []))


def draw_paths(shares: DataFrame, draws: DataFrame, seed: str) -> DataFrame:
    """One path for each row of ``draws`` (framework, draw_id), by its framework's shares; all draws see one snapshot of the counts.

    Shares become intervals in the order of the path ids; a draw takes the last
    path whose interval begins at or before its number.  Beginnings and draws are
    sorted together in ranges: a draw looks back within its range, and where its
    range has no beginning before it, at the last one of the ranges before.  Neither
    many paths nor many draws of one framework meet in one task.  The drawn
    number is a hash: a repeated run draws the same.  Paths without weight, and
    draws of frameworks without paths, take no part.
    """
    begins = prefix(shares.filter("probability > 0").select("framework", "path_id", "probability"), "framework", "path_id", "probability")
    begins = begins.select("framework", F.when(F.col("place") == 0, 0.0).otherwise(F.col("upto") - F.col("probability")).alias("__u"), "path_id", F.lit(None).cast(draws.schema).alias("__draw"))
    drawn = draws.select("framework", bucket(F.lit(seed), F.col("framework"), F.col("draw_id")).alias("__u"), F.lit(None).cast("string").alias("path_id"), F.struct(*draws.columns).alias("__draw"))
    line = stretches(begins.unionByName(drawn).withColumn("__k", F.col("__draw").isNotNull()), "framework", "__u", "__k", "path_id")
    back = W.partitionBy("framework", "__part").orderBy("__u", "__k", "path_id").rowsBetween(W.unboundedPreceding, 0)
    ends = line.groupBy("framework", "__part").agg(F.max(F.when(~F.col("__k"), F.struct("__u", "path_id"))).alias("__end"))
    before = W.partitionBy("framework").orderBy("__part").rowsBetween(W.unboundedPreceding, -1)
    ends = ends.select("framework", "__part", F.last("__end", ignorenulls=True).over(before)["path_id"].alias("__before"))
    met = line.withColumn("__own", F.last("path_id", ignorenulls=True).over(back)).filter("__k").join(ends, ["framework", "__part"])
    out = met.withColumn("__path", F.coalesce("__own", "__before")).filter("__path is not null")
    return out.select(*[F.col("__draw")[c].alias(c) for c in draws.columns], F.col("__path").alias("path_id"))


def tag_traces(found: DataFrame, counts: DataFrame, draws: DataFrame, seed: str, expansion: float = 0.0, new_tag=None) -> tuple[DataFrame, DataFrame]:
    """A tag trace for each draw (framework, draw_id), and the counts after them.

    A path is drawn by its weight; a draw that the gate ``expansion`` lets pass
    asks ``new_tag`` (rows with ``parent_id`` -> rows with ``tag``, null for none)
    for a new node under one of its path's nodes, which then ends the trace.  All
    draws see the counts as they were; the new counts include them.
    """
    drawn = draw_paths(probabilities(found, counts), draws, seed).join(found.select("framework", "path_id", "node_ids"), ["framework", "path_id"])
    at = 1 + F.floor(bucket(F.lit(seed), F.lit("node"), F.col("draw_id")) * (F.size("node_ids") - 1))
    grows = (bucket(F.lit(seed), F.lit("expand"), F.col("draw_id")) < expansion) & (F.size("node_ids") > 1)
    drawn = stored(drawn.withColumn("parent_id", F.when(grows, F.get("node_ids", at.cast("int")))), "drawn")
    if new_tag is not None and expansion > 0:
        tags = new_tag(drawn.filter("parent_id is not null")).select("framework", "draw_id", "tag")
        drawn = drawn.join(tags, ["framework", "draw_id"], "left")
        cut = F.slice("node_ids", 1, F.array_position("node_ids", F.col("parent_id")).cast("int"))
        drawn = drawn.withColumn("node_ids", F.when(F.col("tag").isNotNull(), F.array_append(cut, F.col("tag"))).otherwise(F.col("node_ids"))).drop("tag")
    traces = drawn.select(*draws.columns, "path_id", path_id(F.col("node_ids")).alias("trace"), "node_ids")
    return traces, merge_counts(counts, count_samples(drawn))


def trace_rounds(state: Snapshots, draws: DataFrame, seed: str, rounds: int, expansion: float = 0.0, new_tag=None) -> DataFrame:
    """Tag traces of ``draws`` (framework, draw_id, round from 0): each round draws by the counts, and from the paths, that the one before left.

    ``state`` holds (framework, path_id, node_ids, n); version 0 must be there, and
    round k makes version k + 1: the paths it was given and those that it grew, with
    their counts.  A path that several draws grow is one path; a new path begins
    uncounted.  A round's traces are committed before its state, and a round that is
    committed is not drawn again: a run that was cut off goes on where it was, and
    repeats the round that it lost with the same result.
    """
    spark, kept = draws.sparkSession, []
    for k in range(rounds):
        made = Snapshots(f"{state.path}/traces-{k}")
        if max(state.versions(spark)) <= k:
            now = state.read(spark)
            traces, after = tag_traces(now, now.select("framework", "path_id", "n"), draws.filter(F.col("round") == k), f"{seed}.{k}", expansion, new_tag)
            made.commit(traces, 0)
            grown = made.read(spark).select("framework", F.col("trace").alias("path_id"), "node_ids").dropDuplicates(["framework", "path_id"])
            every = now.select("framework", "path_id", "node_ids").unionByName(grown.join(now, ["framework", "path_id"], "left_anti"))
            counted = every.join(after, ["framework", "path_id"], "left").withColumn("n", F.coalesce("n", F.lit(0)).cast("long"))
            state.commit(counted, k + 1)
        kept.append(made.read(spark))
    return reduce(DataFrame.unionByName, kept)


def uniform_pick(rows: DataFrame, draws: DataFrame, seed: str, purpose: str) -> DataFrame:
    """Each draw (framework, draw_id) with one of its framework's ``rows`` (framework, item), all alike likely."""
    numbered = prefix(rows.select("framework", "item"), "framework", "item").withColumnRenamed("place", "__at")
    sizes = rows.groupBy("framework").agg(F.count(F.lit(1)).alias("__n"))
    at = F.floor(bucket(F.lit(seed), F.lit(purpose), F.col("draw_id")) * F.col("__n")).cast("int")
    return draws.join(sizes, "framework").withColumn("__at", at).join(numbered, ["framework", "__at"]).drop("__at", "__n").withColumnRenamed("item", purpose)


def truncate(node_ids: Column, *key: Column) -> Column:
    """The path cut after its third or a later node, drawn by hash; null for paths of fewer than three nodes."""
    n = F.size(node_ids)
    return F.when(n >= 3, F.slice(node_ids, 1, (3 + F.floor(bucket(*key) * (n - 2))).cast("int")))


def expansion_parents(found: DataFrame, draws: DataFrame, seed: str) -> DataFrame:
    """For each draw the node under which a new tag goes: a path at random, then one of its nodes but the root.

    Paths are numbered, and a draw meets the one path of its number.
    """
    numbered = prefix(found.select("framework", "node_ids"), "framework", "node_ids").withColumnRenamed("place", "__at")
    sizes = found.groupBy("framework").agg(F.count(F.lit(1)).alias("__n"))
    picked = draws.join(sizes, "framework").withColumn("__at", F.floor(bucket(F.lit(seed), F.lit("path"), F.col("draw_id")) * F.col("__n")).cast("int"))
    picked = picked.join(numbered, ["framework", "__at"])
    at = 1 + F.floor(bucket(F.lit(seed), F.lit("node"), F.col("draw_id")) * (F.size("node_ids") - 1))
    return picked.withColumn("parent_id", F.get("node_ids", at.cast("int"))).drop("__at", "__n", "node_ids")


def add_children(nodes: DataFrame, new: DataFrame) -> DataFrame:
    """``nodes`` and the new ones (framework, id, parent_id, en, zh), each after its last sibling; known ids and unknown parents are dropped."""
    fresh = new.dropDuplicates(["framework", "id"]).join(nodes.select("framework", "id"), ["framework", "id"], "left_anti")
    fresh = fresh.join(nodes.select("framework", F.col("id").alias("parent_id")).distinct(), ["framework", "parent_id"], "left_semi")
    last = nodes.groupBy("framework", "parent_id").agg(F.max("sib_pos").alias("last"))
    placed = fresh.join(last, ["framework", "parent_id"], "left").withColumn("sib_pos", (F.coalesce("last", F.lit(-1)) + F.row_number().over(W.partitionBy("framework", "parent_id").orderBy("id"))).cast("int"))
    return nodes.unionByName(placed.select(*nodes.columns))
