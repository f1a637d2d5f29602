"""Sinks: JSON lines, partitioned files, counters, ledgers and dead letters.

Every sink writes through Spark's committers: a lost task is run again and its
half-written file is never seen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import trace_name
from .snapshots import Snapshots

_JSON = {"ignoreNullFields": "false"}


def write_json_lines(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One JSON object a line, nulls kept; ``append`` adds files and never touches those that are there."""
    df.write.mode(mode).options(**_JSON).json(path)


def write_text(df: DataFrame, column: str, path: str, mode: str = "errorifexists") -> None:
    df.select(F.col(column).alias("value")).write.mode(mode).text(path)


def write_documents(df: DataFrame, column: str, name: str, path: str, mode: str = "errorifexists") -> None:
    """One document a row, each in a file of its own under ``path``/``name``=value."""
    df.select(F.col(name), F.col(column).alias("value")).write.mode(mode).option("maxRecordsPerFile", 1).partitionBy(name).text(path)


def as_json_array(df: DataFrame, group: list[str]) -> DataFrame:
    """One JSON array per group, for exports of a group that fits a row."""
    rest = [c for c in df.columns if c not in group]
    return df.groupBy(*group).agg(F.to_json(F.collect_list(F.struct(*rest)), _JSON).alias("document"))


def with_constants(df: DataFrame, **values: object) -> DataFrame:
    """``df`` with constant columns; existing ones of the same names are replaced."""
    return df.withColumns({k: F.lit(v) for k, v in values.items()})


def write_by_trace_name(df: DataFrame, path: str, name_col: str = "trace_name") -> None:
    """One folder per safe trace name."""
    named = df.withColumn("trace_name_safe", trace_name(F.col(name_col)))
    # rows of a name meet in as many tasks as Spark's advised partition size asks for: few files a name, and no task for a hot one alone
    named.hint("rebalance", "trace_name_safe").write.partitionBy("trace_name_safe").mode("append").options(**_JSON).json(path)


def valid_only(checked: DataFrame, path: str) -> None:
    """The valid rows' lines; with none, an empty output."""
    write_text(checked.filter("valid"), "line", path)


def rewrite_valid(lines: Snapshots, spark: SparkSession, valid: Column) -> int:
    """Drop the rows of a table that aren't valid, in place: readers see the old version until the new one is whole."""
    return lines.update(spark, lambda rows: rows.filter(F.coalesce(valid, F.lit(False))))


def merge_counts(counters: Snapshots, delta: DataFrame) -> int:
    """The next version of stored counters: those that are there and their increments."""
    return counters.update(delta.sparkSession, lambda rows: delta if rows is None else new_counts(rows, delta))


def mark_done(ledger: Snapshots, done: DataFrame, key: str = "trace_id") -> int:
    """The ledger with the keys of ``done``, each once; null keys are never done."""
    keys = done.select(key).filter(F.col(key).isNotNull())
    return ledger.update(done.sparkSession, lambda rows: (keys if rows is None else rows.unionByName(keys)).distinct())


def save_taxonomy(trees: Snapshots, nodes: DataFrame) -> int:
    """Adjacency rows as the next version; the one before stays as the backup."""
    return trees.commit(nodes)


def new_counts(stored: DataFrame, delta: DataFrame) -> DataFrame:
    """Stored counters and their increments as one table, to be written as the next version."""
    keys = [c for c in stored.columns if c != "n"]
    return stored.unionByName(delta).groupBy(*keys).agg(F.sum("n").alias("n"))


def not_done(rows: DataFrame, ledger: DataFrame, key: str = "trace_id") -> DataFrame:
    """Rows whose key the ledger lacks; null keys are never done."""
    return rows.join(ledger.select(key).distinct(), key, "left_anti")


def split_dead_letters(df: DataFrame, ok: Column) -> tuple[DataFrame, DataFrame]:
    """(good rows, the others); a null condition is not good."""
    good = F.coalesce(ok, F.lit(False))
    return df.filter(good), df.filter(~good)
