"""Plain engine queries, beside those of the operator inventory; all keys begin with ``base_``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .base import Registry, table

query = Registry()


@query("""SELECT r_name, n_name, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2""")
def base_star_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = {k: table(spark, sf_dir, k) for k in ("lineitem", "orders", "customer", "nation", "region")}
    j = t["lineitem"].join(t["orders"], F.col("l_orderkey") == F.col("o_orderkey")).join(t["customer"], F.col("o_custkey") == F.col("c_custkey"))
    j = j.join(t["nation"], F.col("c_nationkey") == F.col("n_nationkey")).join(t["region"], F.col("n_regionkey") == F.col("r_regionkey"))
    return j.groupBy("r_name", "n_name").agg(F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double").alias("revenue"))


@query("""SELECT coalesce(l_returnflag, '*') AS flag, coalesce(l_linestatus, '*') AS status, count(*) AS n FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus)""")
def base_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "lineitem").cube("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("n"))
    return c.select(F.coalesce("l_returnflag", F.lit("*")).alias("flag"), F.coalesce("l_linestatus", F.lit("*")).alias("status"), "n")


@query("""SELECT event_id, count(*) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS n, lag(event_id) OVER (PARTITION BY user_id ORDER BY event_id) AS before FROM events""")
def base_window_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = W.partitionBy("user_id").orderBy("event_id")
    return table(spark, sf_dir, "events").select("event_id", F.count(F.lit(1)).over(w.rowsBetween(-2, 0)).alias("n"), F.lag("event_id").over(w).alias("before"))


@query("""WITH e AS (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) <= INTERVAL 1 HOUR THEN 0 ELSE 1 END AS s FROM events),
g AS (SELECT *, sum(s) OVER (PARTITION BY user_id ORDER BY ts) AS k FROM e) SELECT user_id, min(event_id) AS first_id, count(*) AS n FROM g GROUP BY user_id, k""")
def base_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = W.partitionBy("user_id").orderBy("ts")
    near = F.col("ts") - F.lag("ts").over(w) <= F.expr("interval 1 hour")
    e = table(spark, sf_dir, "events").withColumn("s", F.when(near, 0).otherwise(1))
    return e.withColumn("k", F.sum("s").over(w)).groupBy("user_id", "k").agg(F.min("event_id").alias("first_id"), F.count(F.lit(1)).alias("n")).drop("k")
