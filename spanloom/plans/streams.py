"""Streaming queries over the file stream of ``events``; all that is there is read, then the stream ends."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..storage import shared_folder
from ..streaming import streams
from .base import Registry, table

query = Registry()


def _stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The file source reads folders: a single file is matched by name in its folder."""
    path = f"{sf_dir}/events.parquet"
    schema = spark.read.parquet(path).schema
    fs_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    is_dir = fs_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(fs_path).isDirectory()
    reader = spark.readStream.schema(schema)
    return reader.parquet(path) if is_dir else reader.option("pathGlobFilter", "events.parquet").parquet(sf_dir)


def _checkpoint(spark: SparkSession) -> str:
    return shared_folder(spark, "stream")


@query("""SELECT user_id, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type FROM events GROUP BY user_id""")
def stream_last_generation(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = streams.last_per_key(_stream(spark, sf_dir), "user_id", "event_id", ["event_type"])
    return streams.run_available(s, f"last_{uuid.uuid4().hex}", "complete", _checkpoint(spark)).select("user_id", "event_id", "event_type")


#: Arrivals of ``events``: by the day of the month, but one row in ten comes with the last part, however old it is.
_ARRIVALS = "CASE WHEN event_id % 10 = 3 THEN 2 WHEN day(ts) <= 10 THEN 0 WHEN day(ts) <= 20 THEN 1 ELSE 2 END"


def _parts(spark: SparkSession, sf_dir: str, *columns: str) -> list[DataFrame]:
    """``events`` in three parts, as they arrive."""
    e = table(spark, sf_dir, "events").withColumn("ts", F.to_timestamp("ts")).withColumn("__part", F.expr(_ARRIVALS))
    return [e.filter(F.col("__part") == k).selectExpr(*columns) for k in range(3)]


#: What a watermark of an hour lets through: rows of part k that are younger than an hour before the youngest row of the parts before.
_IN_TIME = f"""arrived AS (SELECT *, {_ARRIVALS} AS part FROM events),
marks AS (SELECT p.part, max(a.ts) - INTERVAL 1 HOUR AS mark FROM (SELECT DISTINCT part FROM arrived) p LEFT JOIN arrived a ON a.part < p.part GROUP BY 1),
in_time AS (SELECT a.* FROM arrived a JOIN marks m USING (part) WHERE mark IS NULL OR ts > mark)"""


@query(f"""WITH {_IN_TIME} SELECT DISTINCT user_id, event_type FROM in_time""")
def stream_incremental_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = _parts(spark, sf_dir, "user_id", "event_type", "ts AS at")
    kept = streams.run_in_arrivals(parts, lambda s: streams.without_repeats(s, ["user_id", "event_type"], "at", "1 hour"), f"dedup_{uuid.uuid4().hex}")
    return kept.select("user_id", "event_type").distinct()


@query(f"""WITH {_IN_TIME},
r AS (SELECT user_id, epoch_us(ts) // 1000 AS ms, CAST(event_id AS VARCHAR) AS id FROM in_time),
s AS (SELECT *, sum(CASE WHEN ms > before + 21600000 OR before IS NULL THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ms, id) AS g FROM (SELECT *, lag(ms) OVER (PARTITION BY user_id ORDER BY ms, id) AS before FROM r)),
c AS (SELECT user_id, g, min(ms) AS first_ms, max(ms) AS last_ms, arg_max(id, (ms, id)) AS last_value, count(*) AS n FROM s GROUP BY ALL)
SELECT CAST(user_id AS VARCHAR) AS user_id, first_ms, last_ms, last_value, n FROM c WHERE last_ms + 21600000 <= (SELECT epoch_us(max(ts)) // 1000 - 3600000 FROM events)""")
def stream_closed_generation(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = _parts(spark, sf_dir, "cast(user_id as string) AS user_id", "ts", "cast(event_id as string) AS id")
    return streams.run_in_arrivals(parts, lambda s: streams.closed_generations(s, "user_id", "ts", "id", 6 * 3_600_000, "1 hour"), f"closed_{uuid.uuid4().hex}")


@query(f"""WITH sides AS (SELECT *, {_ARRIVALS} AS part FROM events WHERE event_type IN ('view', 'purchase')),
upto AS (SELECT p.part, least(max(s.ts) FILTER (event_type = 'view'), max(s.ts) FILTER (event_type = 'purchase')) - INTERVAL 1 HOUR AS mark FROM range(4) AS p(part) LEFT JOIN sides s ON s.part < p.part GROUP BY 1),
in_time AS (SELECT s.* FROM sides s JOIN upto USING (part) WHERE mark IS NULL OR ts > mark),
c AS (SELECT user_id, event_id AS child_id, ts AS child_ts FROM in_time WHERE event_type = 'purchase'), p AS (SELECT user_id, event_id AS parent_id, ts AS parent_ts FROM in_time WHERE event_type = 'view')
SELECT c.user_id, child_id, parent_id FROM c LEFT JOIN p ON c.user_id = p.user_id AND parent_ts BETWEEN child_ts - INTERVAL 12 HOUR AND child_ts
WHERE parent_id IS NOT NULL OR child_ts < (SELECT mark FROM upto WHERE part = 3)""")
def stream_parent_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases with the views of their user in the twelve hours before; one without any comes out once the watermark has passed it."""

    def joined(s: DataFrame) -> DataFrame:
        side = lambda kind, name: s.filter(F.col("event_type") == kind).selectExpr("user_id", f"event_id AS {name}_id", f"ts AS {name}_ts")
        return streams.with_parent_in_time(side("purchase", "child"), side("view", "parent"), "user_id", "12 hours", "1 hour")

    parts = [p.filter("event_type in ('view', 'purchase')") for p in _parts(spark, sf_dir, "user_id", "event_id", "event_type", "ts")]  # no other row arrives: both sides would read it
    return streams.run_in_arrivals(parts, joined, f"parents_{uuid.uuid4().hex}").select("user_id", "child_id", "parent_id")


@query("""SELECT event_type, user_id % 10 AS bucket, count(*) AS n FROM events GROUP BY ALL""")
def stream_resumed_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return streams.merge_counts_once(_parts(spark, sf_dir, "event_type", "user_id % 10 AS bucket"), "event_type", "bucket")[0]


@query("""SELECT event_type, count(*) AS n FROM events GROUP BY 1""")
def stream_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = streams.counters(_stream(spark, sf_dir), "event_type")
    return streams.run_available(s, f"count_{uuid.uuid4().hex}", "complete", _checkpoint(spark)).select("event_type", "n")
