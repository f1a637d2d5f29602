"""Counts, rates and shares over runs, conversations and traces."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..storage import stored

def agent_distribution(spans: DataFrame, agent: str = "agent_name") -> DataFrame:
    """Rows of each agent; a null agent counts as ``unknown``."""
    return spans.groupBy(F.coalesce(F.col(agent), F.lit("unknown")).alias(agent)).agg(F.count(F.lit(1)).alias("n"))


def run_statistics(queries: DataFrame) -> DataFrame:
    """One row: totals, count by difficulty, distinct problem types, mean query length (0 if there are none)."""
    n = F.count(F.lit(1))
    by = [F.count_if(F.col("difficulty") == d).alias(f"n_{d}") for d in ("easy", "medium", "hard")]
    return queries.agg(n.alias("total"), *by, F.count_distinct("problem_type").alias("problem_types"), F.coalesce(F.try_divide(F.sum(F.length("query")), n), F.lit(0.0)).alias("avg_length"), F.count_if("success").alias("succeeded"), F.count_if(~F.col("success")).alias("failed"))


def run_summary(runs: DataFrame) -> DataFrame:
    """Successes, failures and rate; no row for no runs."""
    n = F.count(F.lit(1))
    return runs.agg(n.alias("total"), F.count_if("success").alias("succeeded"), F.count_if(~F.col("success")).alias("failed"), F.try_divide(F.count_if("success"), n).alias("rate")).filter("total > 0")


def outcome_counts(rows: DataFrame, status: str = "status") -> DataFrame:
    return rows.groupBy(status).agg(F.count(F.lit(1)).alias("n"))


def summary_by_framework(personas: DataFrame) -> DataFrame:
    return personas.groupBy("framework").agg(F.count(F.lit(1)).alias("personas"))


def timing_share(times: DataFrame, group: str, stage: str, seconds: str) -> DataFrame:
    """Each stage's time and its percentage of the group's, longest first in ``place``."""
    per = times.groupBy(group, stage).agg(F.sum(seconds).alias("seconds"))
    whole = W.partitionBy(group)
    share = F.coalesce(F.try_divide(F.col("seconds") * 100, F.sum("seconds").over(whole)), F.lit(0.0))
    return per.withColumn("percent", share).withColumn("place", F.row_number().over(whole.orderBy(F.col("seconds").desc(), F.col(stage))))


def ordered_distinct(*texts: Column) -> Column:
    """The non-empty texts in order, each once."""
    return F.array_distinct(F.filter(F.array(*texts), lambda t: F.coalesce(t, F.lit("")) != ""))


def last_of_each(pairs: Column) -> Column:
    """map from key to the value of its last pair, of array<struct<k,v>>; keys in the order of their first pairs.

    Pairs without a key are left out; null pairs give null.  Sorted by key and
    place, each key's first and last pair stand at the ends of its run.
    """

    def bound(array: Column, f) -> Column:
        """``f`` of an array that is made once, not once for each element it is compared with."""
        return F.get(F.transform(F.array(array), f), 0)

    firsts = lambda a: F.filter(a, lambda p, i: (i == 0) | (F.get(a, i - 1)["k"] != p["k"]))
    lasts = lambda a: F.filter(a, lambda p, i: (i == F.size(a) - 1) | (F.get(a, i + 1)["k"] != p["k"]))

    def entries(pairs: Column) -> Column:
        placed = F.array_sort(F.filter(F.transform(pairs, lambda p, i: F.struct(p["k"].alias("k"), i.alias("i"))), lambda p: p["k"].isNotNull()))
        ends = bound(placed, lambda a: F.array_sort(F.zip_with(firsts(a), lasts(a), lambda f, l: F.struct(f["i"].alias("first"), l["i"].alias("last")))))
        picked = F.transform(ends, lambda e: F.get(pairs, e["last"]))
        return F.transform(picked, lambda p: F.struct(p["k"].alias("key"), p["v"].alias("value")))

    return F.map_from_entries(bound(pairs, entries))


def numbered(rows: DataFrame, *order: str) -> DataFrame:
    """``rows`` numbered from 1 in the given order, without gathering them: parts are counted, then each row adds its part's base."""
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__id", F.monotonically_increasing_id())
    ranged = ranged.withColumn("__part", F.shiftright("__id", 33)).withColumn("__at", F.col("__id").bitwiseAND(F.lit((1 << 33) - 1)))
    ranged = stored(ranged, "numbered")
    sizes = ranged.groupBy("__part").agg(F.count(F.lit(1)).alias("n"))  # one row per partition
    base = sizes.select("__part", F.coalesce(F.sum("n").over(W.orderBy("__part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    return ranged.join(F.broadcast(base), "__part").withColumn("number", F.col("base") + F.col("__at") + 1).drop("__id", "__part", "__at", "base")
