"""Registration of queries with their SQL, and the reading of tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]


class Registry:
    """Query functions and SQL by key; a query without SQL has an operator that SQL can't express."""

    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def __call__(self, sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
        def add(f: Query) -> Query:
            key = name or f.__name__
            self.queries[key] = f
            if sql:
                self.sql[key] = sql
            return f

        return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def iso(ts: str) -> Column:
    """A time as ISO text with milliseconds."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def event_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as spans: the user is the parent (users divisible by 50 have none), a click or view is a generation."""
    e = table(spark, sf_dir, "events")
    return e.select(
        (F.col("user_id") % 10).cast("string").alias("trace_id"), F.col("event_id").cast("string").alias("span_id"),
        F.when(F.col("event_type").isin("click", "view", "purchase"), "GENERATION").otherwise("SPAN").alias("span_type"),
        F.when(F.col("event_type") == "view", "other-llm").otherwise("OpenAI-generation").alias("span_name"),
        iso("ts").alias("start_time_s"), F.when(F.col("user_id") % 50 != 0, F.concat(F.lit("u"), F.col("user_id").cast("string"))).alias("parent_id"),
        F.col("event_id").alias("line_no"),
    )


#: The same in SQL.
EVENT_SPANS = """spans AS (SELECT CAST(user_id % 10 AS VARCHAR) AS trace_id, CAST(event_id AS VARCHAR) AS span_id,
  CASE WHEN event_type IN ('click', 'view', 'purchase') THEN 'GENERATION' ELSE 'SPAN' END AS span_type,
  CASE WHEN event_type = 'view' THEN 'other-llm' ELSE 'OpenAI-generation' END AS span_name,
  strftime(ts, '%Y-%m-%dT%H:%M:%S.%gZ') AS start_time_s, CASE WHEN user_id % 50 <> 0 THEN 'u' || user_id END AS parent_id, event_id AS line_no FROM events)"""
