"""Last values of keys within a row, and tool lists that are asked for once."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from spanloom.adapters import AnswerCache
from spanloom.operators import stats
from spanloom.sources import files


def test_last_of_each_is_a_dictionary(spark):
    draw = random.Random(5)
    rows = [None, []] + [[(draw.choice("abcdef") if draw.random() < 0.9 else None, draw.choice([None, 1, 2, 3])) for _ in range(draw.randrange(12))] for _ in range(200)]
    df = spark.createDataFrame(list(enumerate(rows)), "n long, p array<struct<k:string,v:int>>")
    made = df.select("n", stats.last_of_each(F.col("p")).alias("m")).select("n", "m", F.map_keys("m").alias("keys")).collect()
    got, keys = {r.n: r.m for r in made}, {r.n: r["keys"] for r in made}
    for n, pairs in enumerate(rows):
        want = None if pairs is None else {k: v for k, v in pairs if k is not None}
        assert got[n] == want
        if pairs:
            assert keys[n] == list(want)


def test_last_of_each_in_long_rows(spark):
    df = spark.range(1).select(F.transform(F.sequence(F.lit(1), F.lit(200_000)), lambda i: F.struct((i % 150_000).alias("k"), i.alias("v"))).alias("p"))
    m = df.select(F.explode(stats.last_of_each(F.col("p"))).alias("k", "v")).agg(F.count("*"), F.sum("v")).first()
    assert tuple(m) == (150_000, sum(range(150_000 - 100_000 + 1, 150_000 + 1)) + sum(range(150_001, 200_001)))


def test_last_of_each_makes_its_array_once(spark):
    """Pairs that are an expression of a column: not made again for each key (50,000 times 100,000 words)."""
    text = " ".join(str(i % 50_000) for i in range(100_000))
    words = F.transform(F.split("t", " "), lambda w, i: F.struct(w.alias("k"), i.alias("v")))
    m = spark.createDataFrame([(text,)], "t string").select(F.map_values(stats.last_of_each(words)).alias("v")).first().v
    assert m == list(range(50_000, 100_000))


def test_server_tools_of_odd_rows(spark, tmp_path):
    fetch = lambda urls: ["no list" if u.endswith("bad") else '[{"name": "t"}]' for u in urls]
    servers = spark.createDataFrame([("a", "u1"), ("b", "u1"), ("c", None), ("d", "bad")], "server string, url string")
    cache = AnswerCache(str(tmp_path / "cache"), "tools")
    for _ in range(2):
        got = {(r.server, r.tool_name) for r in files.server_tools(spark, servers, fetch, cache).collect()}
        assert got == {("a", "t"), ("b", "t")}
    assert cache.rows(spark).count() == 2
