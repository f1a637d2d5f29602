"""State, late rows, resuming, the paged source, versioned tables, kept answers, long conversations, many paths, deep documents."""

from __future__ import annotations

import json
import uuid

import pytest
from pyspark.sql import functions as F

from spanloom.adapters import AnswerCache, ask
from spanloom.functions import deepjson
from spanloom.functions.xmlcalls import rewrite_leaves
from spanloom.operators import calls, taxonomy
from spanloom.sources import files, sinks, traces
from spanloom.sources.snapshots import Snapshots
from spanloom.storage import shared_folder
from spanloom.streaming import streams


# ------------------------------------------------------------------ streams


def at(minute: int) -> str:
    return f"2024-01-01 {minute // 60:02d}:{minute % 60:02d}:00"


def arrivals(spark, *parts):
    return [spark.createDataFrame(p, "k string, t string, v string").withColumn("t", F.to_timestamp("t")) for p in parts]


def test_a_key_that_comes_back_opens_a_new_group(spark):
    """Closed by the timer in the first run, opened anew in the second; a late row of the second is dropped."""
    parts = arrivals(spark, [("a", at(0), "1"), ("a", at(5), "2"), ("b", at(200), "9")], [("a", at(201), "3"), ("a", at(1), "late"), ("c", at(400), "x")])
    out = streams.run_in_arrivals(parts, lambda s: streams.closed_generations(s, "k", "t", "v", 30 * 60_000, "10 minutes"), f"closed-{uuid.uuid4().hex}")
    rows = sorted((r["k"], r["last_value"], r["n"]) for r in out.collect())
    assert rows == [("a", "2", 2), ("a", "3", 1), ("b", "9", 1)]


def test_gap_within_one_batch_closes_a_group(spark):
    parts = arrivals(spark, [("a", at(0), "1"), ("a", at(90), "2"), ("a", at(91), "3"), ("z", at(300), "-")])
    out = streams.run_in_arrivals(parts, lambda s: streams.closed_generations(s, "k", "t", "v", 30 * 60_000, "10 minutes"), f"gap-{uuid.uuid4().hex}")
    assert sorted((r["k"], r["first_ms"] % 86_400_000 // 60_000, r["last_value"], r["n"]) for r in out.collect()) == [("a", 0, "1", 1), ("a", 90, "3", 2)]


def test_late_row_joins_groups_and_none_ends_before_the_watermark(spark):
    """A row beyond the pause ends nothing while rows may still come between; at the end only what the watermark has reached is final."""
    parts = arrivals(spark, [("a", at(20), "1"), ("a", at(52), "2")], [("a", at(45), "late")], [("b", at(260), "3"), ("c", at(261), "4"), ("c", at(300), "5")])
    out = streams.run_in_arrivals(parts, lambda s: streams.closed_generations(s, "k", "t", "v", 30 * 60_000, "10 minutes"), f"late-{uuid.uuid4().hex}")
    rows = sorted((r["k"], r["first_ms"] % 86_400_000 // 60_000, r["last_value"], r["n"]) for r in out.collect())
    assert rows == [("a", 20, "2", 3), ("b", 260, "3", 1)]


def test_repeated_batch_changes_nothing_and_second_run_reads_new_files_only(spark):
    rows = lambda *ks: spark.createDataFrame([(k,) for k in ks], "k string")
    found, read = streams.merge_counts_once([rows("a", "b", "a"), rows("a"), rows("c", "b")], "k")
    assert {r["k"]: r["n"] for r in found.collect()} == {"a": 3, "b": 2, "c": 1} and read == [3, 1, 2]
    kept = Snapshots(shared_folder(spark, "counts"))
    sink = streams.MergedCounts(kept, "k")
    for number, batch in ((0, rows("a")), (1, rows("a", "b")), (1, rows("a", "b"))):
        sink(batch, number)
    assert {r["k"]: r["n"] for r in kept.read(spark).collect()} == {"a": 2, "b": 1}


def test_a_stream_batch_that_comes_again_is_written_once(spark):
    folder, path, checkpoint = (shared_folder(spark, k) for k in ("in", "out", "check"))
    spark.range(5).write.parquet(folder)
    stream = lambda: spark.readStream.schema("id long").parquet(folder)
    assert streams.run_available(stream(), f"x-{uuid.uuid4().hex}", "append", checkpoint, path).count() == 5
    spark.range(5, 7).write.mode("append").parquet(folder)
    assert streams.run_available(stream(), f"x-{uuid.uuid4().hex}", "append", checkpoint, path).count() == 7
    assert streams.run_available(stream(), f"x-{uuid.uuid4().hex}", "append", checkpoint, path).count() == 7


# ------------------------------------------------------------------ sources and sinks


def flaky_source():
    """A source of which the first request of each page fails; made here, so that workers get it by value."""

    class Flaky(traces.PageFolder):
        def observations(self, trace_id, page):
            seen = self.__dict__.setdefault("seen", set())
            if page not in seen:
                seen.add(page)
                raise OSError("busy")
            return super().observations(trace_id, page)

    class FlakySource(traces.TraceSource):
        @classmethod
        def name(cls):
            return "flaky_traces"

        def store(self):
            return Flaky(self.options["path"])

    return FlakySource


def test_pushed_range_is_seen_in_the_plan_and_in_the_partitions(spark):
    rows = [(f"2024-01-{d:02d}", f"s{d}-{i}", f"2024-01-{d:02d}T{i:02d}:00:00") for d in range(1, 11) for i in range(7)]
    path = shared_folder(spark, "pages")
    traces.write_pages(spark.createDataFrame(rows, "day string, span_id string, start_time_s string"), path, "day", page=3)
    found = traces.traces(spark, path=path).filter("start_time_s >= '2024-01-03T05:00:00' and start_time_s < '2024-01-05T02:00:00' and span_id <> 's4-1'")
    plan = found._jdf.queryExecution().executedPlan().toString()
    kept = [x for x in plan.splitlines() if "Filter " in x and "BatchScan" not in x]
    assert len(kept) == 1 and "span_id" in kept[0] and "start_time_s" not in kept[0].split("isnotnull")[-1]
    assert found.rdd.getNumPartitions() == 3
    assert {r["span_id"] for r in found.collect()} == {s for _, s, t in rows if "2024-01-03T05:00:00" <= t < "2024-01-05T02:00:00" and s != "s4-1"}
    by_time = [r["start_time_s"] for r in traces.traces(spark, path=path).filter("trace_id = '2024-01-07'").orderBy("line_no").collect()]
    assert by_time == sorted(by_time) and len(by_time) == 7
    assert traces.traces(spark, flaky_source(), path=path, wait="0").count() == 70
    with pytest.raises(Exception, match="busy"):
        traces.traces(spark, flaky_source(), path=path, wait="0", attempts="1").count()


def test_an_aborted_write_leaves_the_last_version(spark):
    table = Snapshots(shared_folder(spark, "table"))
    assert table.read(spark) is None and table.versions(spark) == []
    table.commit(spark.range(3))
    with pytest.raises(Exception, match="no good"):
        table.update(spark, lambda rows: rows.withColumn("id", F.when(F.col("id") == 2, F.raise_error(F.lit("no good"))).otherwise(F.col("id"))))
    assert table.versions(spark) == [0] and table.read(spark).count() == 3
    assert sinks.rewrite_valid(table, spark, F.col("id") > 0) == 1
    assert sorted(r["id"] for r in table.read(spark).collect()) == [1, 2] and table.read(spark, below=1).count() == 3
    assert table.commit(spark.range(100), version=1) == 1 and table.read(spark).count() == 2  # a version is written once
    for _ in range(3):
        table.update(spark, lambda rows: rows)
    assert table.versions(spark) == [3, 4]


def test_ledger_and_counters_in_versions(spark):
    ledger, counts = Snapshots(shared_folder(spark, "ledger")), Snapshots(shared_folder(spark, "counts"))
    ids = lambda *xs: spark.createDataFrame([(x,) for x in xs], "trace_id string")
    sinks.mark_done(ledger, ids("a", None, "a"))
    sinks.mark_done(ledger, ids("b", "a"))
    assert sorted(r[0] for r in ledger.read(spark).collect()) == ["a", "b"]
    delta = lambda **n: spark.createDataFrame(list(n.items()), "path_id string, n long")
    sinks.merge_counts(counts, delta(p=2, q=1))
    sinks.merge_counts(counts, delta(q=3, r=1))
    assert {r["path_id"]: r["n"] for r in counts.read(spark).collect()} == {"p": 2, "q": 4, "r": 1}


def counting(folder: str):
    """A service that echoes, and notes each request in a file of a folder."""

    def service(requests):
        from pathlib import Path

        for r in requests:
            (Path(folder) / uuid.uuid4().hex).write_text(r)
        return [r.upper() for r in requests]

    return service


def test_answers_are_kept_across_runs(spark, tmp_path):
    service, cache = counting(str(tmp_path)), AnswerCache(shared_folder(spark, "answers"), "echo")
    rows = lambda *xs: spark.createDataFrame([(x,) for x in xs], "q string")
    sent = lambda: sorted(p.read_text() for p in tmp_path.iterdir())
    assert {r["q"]: r["a"] for r in ask(rows("x", "y", "x", None), F.col("q"), service, "a", cache).collect()} == {"x": "X", "y": "Y", None: None}
    assert sent() == ["x", "y"]
    assert {r["a"] for r in ask(rows("x", "y"), F.col("q"), service, "a", cache).collect()} == {"X", "Y"} and sent() == ["x", "y"]
    assert {r["a"] for r in ask(rows("x", "z"), F.col("q"), service, "a", cache).collect()} == {"X", "Z"} and sent() == ["x", "y", "z"]
    ask(rows("x"), F.col("q"), service, "a", AnswerCache(cache.path, "other")).collect()
    ask(rows("x"), F.col("q"), service, "a", AnswerCache(cache.path, "echo", max_age_s=-1)).collect()
    assert sent() == ["x", "x", "x", "y", "z"]


# ------------------------------------------------------------------ size


def messages(spark, rows):
    return spark.createDataFrame(rows, "c string, at long, role string, content string, tool_calls array<struct<id:string,name:string>>")


def results(*pairs):
    return "Tool execution results:" + "".join(f"<tool_result><tool_name>{n}</tool_name><result>{r}</result></tool_result>" for n, r in pairs)


def test_rows_are_paired_as_arrays_are(spark):
    rows = [
        ("a", 0, "user", "hi", None), ("a", 1, "assistant", "-", [("c1", "search"), ("c2", "fetch")]), ("a", 2, "user", results(("fetch", "F"), ("search", "S")), None),
        ("b", 0, "assistant", "-", [("c3", "x")]), ("b", 1, "user", results(("y", "Q")), None), ("c", 0, "user", results(("z", "R")), None),
        ("d", 0, "assistant", None, [("c4", "w")]), ("d", 1, "user", "Tool execution results: oops", None), ("e", 0, "assistant", "-", [("a", "t"), ("b", "t")]), ("e", 1, "user", results(("t", "1"), ("t", "2")), None),
        ("e", 2, "user", None, None), (None, 0, "assistant", "-", None),
    ]
    df = messages(spark, rows)
    got = calls.paired_rows(df, ["c"]).filter("role = 'tool'").orderBy("c", "at", "k").collect()
    assert [(r["c"], r["tool_call_id"], r["name"], r["content"]) for r in got if r["c"] != "c"] == [("a", "c2", "fetch", "F"), ("a", "c1", "search", "S"), ("b", "c3", "y", "Q"), ("d", "c4", "unknown_tool", "oops"), ("e", "a", "t", "1"), ("e", "b", "t", "2")]
    assert next(r["tool_call_id"] for r in got if r["c"] == "c").startswith("call_")
    assert calls.paired_rows(df, ["c"]).count() == len(rows) + 2 and calls.paired_rows(df.limit(0), ["c"]).count() == 0


def test_a_conversation_of_a_million_turns(spark):
    n = 1_000_000
    half = F.col("id") < n // 2
    text = F.concat(F.lit("Tool execution results:<tool_result><tool_name>t"), (F.col("id") % 3).cast("string"), F.lit("</tool_name><result>r</result></tool_result>"))
    call = F.array(F.struct(F.concat(F.lit("c"), F.col("id").cast("string")).alias("id"), F.concat(F.lit("t"), (F.col("id") % 3).cast("string")).alias("name")))
    df = spark.range(n).select(F.lit("one").alias("c"), F.col("id").alias("at"), F.when(half, "assistant").otherwise("user").alias("role"), F.when(half, "-").otherwise(text).alias("content"), F.when(half, call).alias("tool_calls"))
    out = calls.paired_rows(df, ["c"]).filter("role = 'tool'").agg(F.count("tool_call_id"), F.count_distinct("tool_call_id"), F.count_if(F.col("tool_call_id").startswith("c") & ~F.col("tool_call_id").startswith("call"))).first()
    assert tuple(out) == (n // 2, n // 2, n // 2)


def test_a_million_paths_in_one_framework(spark):
    n = 1_000_000
    shares = spark.range(n).select(F.lit("f").alias("framework"), F.format_string("p%07d", "id").alias("path_id"), F.lit(1.0 / n).alias("probability"))
    draws = spark.range(20_000).select(F.lit("f").alias("framework"), F.col("id").alias("draw_id"))
    out = taxonomy.draw_paths(shares, draws, "s").join(draws.select("draw_id", F.floor(taxonomy.bucket(F.lit("s"), F.lit("f"), F.col("draw_id")) * n).alias("want")), "draw_id")
    far = out.select(F.abs(F.substring("path_id", 2, 7).cast("long") - F.col("want")).alias("d")).agg(F.max("d"), F.count("d")).first()
    assert far[0] <= 1 and far[1] == 20_000  # but for the rounding of sums, the path at the drawn place
    picked = taxonomy.uniform_pick(shares.select("framework", F.col("path_id").alias("item")), draws, "s", "item2")
    assert picked.count() == 20_000


def test_draws_of_frameworks_with_no_or_one_path(spark):
    shares = spark.createDataFrame([("a", "p", 1.0), ("b", "q", 0.5), ("b", "r", 0.5), ("b", "none", 0.0)], "framework string, path_id string, probability double")
    draws = spark.createDataFrame([(f, i) for f in ("a", "b", "c") for i in range(40)], "framework string, draw_id long")
    got = {(r["framework"], r["path_id"]) for r in taxonomy.draw_paths(shares, draws, "1").collect()}
    assert got == {("a", "p"), ("b", "q"), ("b", "r")}
    assert taxonomy.draw_paths(shares, draws.limit(0), "1").count() == 0 and taxonomy.draw_paths(shares.limit(0), draws, "1").count() == 0


# ------------------------------------------------------------------ depth


def test_documents_of_any_depth():
    call = "<tool_use><tool_name>f</tool_name><parameter><x>1</x></parameter></tool_use>"
    deep = '[{"k": ' * 3000 + json.dumps(call) + "}]" * 3000
    out = rewrite_leaves(deep, "glm")
    assert "<tool_call>f" in out and "tool_use" not in out and out.count("[") == 3000
    assert rewrite_leaves(deep + "]", "glm") == deep + "]"  # what isn't JSON stays
    for text in ("[" * 100_000, "{" * 5000 + "}" * 5000, "[" * 5000 + "1,]" + "]" * 5000, '{"a":' * 5000 + "1" + "}" * 4999):
        with pytest.raises(ValueError):
            deepjson.loads(text)


def test_the_deep_reader_reads_as_the_library_does():
    for text in ('{"a": [1, 2.5, -3e2, true, null, "x\\n\\u00e9"], "b": {}, "c": [], "d": {"e": [{}, [[]]]}}', "[]", '"s"', "3", ' [ "a" , {"b" : "c"} ] ', '{"a": 1, "a": 2}'):
        assert deepjson._read(text) == json.loads(text)
    for text in ("", "[1 2]", "[,1]", "{1: 2}", '{"a" 1}', '{"a":}', "[1],", "1 2", "]", '{"a": 1,}', "nope", '"open'):
        with pytest.raises(ValueError):
            deepjson._read(text)


def test_taxonomies_of_depth_five_thousand(spark, tmp_path):
    rows = [("f", "n0", None, "N0", "", 0)] + [("f", f"n{i}", f"n{i - 1}", f"N{i}", "", 0) for i in range(1, 5000)] + [("f", "lost", "nowhere", "", "", 0), ("g", "x", None, "X", "y", 0), ("h", "a", "b", "", "", 0), ("h", "b", "a", "", "", 0)]
    nodes = spark.createDataFrame(rows, "framework string, id string, parent_id string, en string, zh string, sib_pos int")
    sinks.write_documents(files.taxonomy_documents(nodes), "document", "framework", str(tmp_path / "docs"))
    back = sorted((tuple(r) for r in files.taxonomies(spark, str(tmp_path / "docs" / "*")).collect()), key=repr)
    assert back == sorted((r for r in rows if r[1] not in ("lost", "a", "b")), key=repr)
    tree = files.nested_tree([(r[1], r[2], r[3], r[5]) for r in rows[:5000]])
    depth = 0
    while tree:
        tree, depth = tree[0].get("children", []), depth + 1
    assert depth == 5000
