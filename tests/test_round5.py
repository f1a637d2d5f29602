"""Memory of a task that doesn't grow with a group: rows in place of lists, spans read in runs, requests stored once."""

from __future__ import annotations

import json
import random
import tracemalloc

import pandas as pd
from pyspark.sql import functions as F

from spanloom import adapters, registry
from spanloom.llm import quality_rules
from spanloom.operators import calls
from spanloom.sources import files, traces
from spanloom.streaming import streams


def test_agents_tools_from_rows_as_from_lists(spark):
    """A row for each name gives what a list gives; repeats, misses and nulls are dropped."""
    rows = spark.createDataFrame([("a", "x"), ("a", "x"), ("a", "y"), ("b", "none"), ("b", None), ("b", "x")], "agent string, name string")
    tools = spark.createDataFrame([("x", 1), ("y", 2), ("z", 3)], "tool string, size int")
    lists = rows.groupBy("agent").agg(F.collect_list("name").alias("name"))
    expected = [("a", "x", 1), ("a", "y", 2), ("b", "x", 1)]
    for agents, parts in ((lists, None), (rows, None), (rows, 7)):
        found = calls.agent_tools(agents, tools, "agent", "name", "tool", parts)
        assert sorted(tuple(r) for r in found.select("agent", "tool", "size").collect()) == expected


def test_tool_definitions_gather_no_lists(spark, sf_dir):
    plan = registry.queries()["tool_definition_join"](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_set" not in plan and "explode" not in plan


def test_requests_that_are_columns_are_stored_once(spark, sf_dir, monkeypatch):
    """By its name a request is no second column of the stored rows; the answers are those of an expression."""
    kept = []
    monkeypatch.setattr(adapters, "stored", lambda df, what, store=adapters.stored: kept.append((what, df.columns)) or store(df, what))
    df = spark.createDataFrame([(1, "x"), (2, "y"), (3, "x"), (4, None)], "id int, `a text` string")
    service = lambda requests: [r + "!" for r in requests]
    expected = [(1, "x", "x!"), (2, "y", "y!"), (3, "x", "x!"), (4, None, None)]
    for request in (F.col("`a text`"), "a text"):
        assert sorted(tuple(r) for r in adapters.ask(df, request, service, "out").collect()) == expected
    assert [columns for what, columns in kept if what == "requests"][1] == ["id", "a text", "__key"]


def test_answers_are_joined_without_their_texts(spark, sf_dir):
    plan = registry.queries()["answers_across_runs"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    reads = [line for line in plan.splitlines() if "FileScan parquet" in line and "doc_id" in line]
    assert reads and not any("text#" in line.split("Batched")[0] for line in reads)


class _LongTrace:
    """A store of one trace: ``pages`` pages of 500 spans with few times, some of them missing."""

    def __init__(self, pages: int) -> None:
        self.pages = pages

    def observations(self, trace_id: str, page: int) -> list[dict]:
        rng = random.Random(page)
        times = [None, *(f"2024-01-01T00:00:{k:02d}" for k in range(60))]
        return [{"trace_id": trace_id, "span_id": f"{page}-{k}", "input": "x" * 200, "start_time_s": rng.choice(times)} for k in range(500)] if page < self.pages else []


def test_long_traces_are_sorted_in_runs(monkeypatch):
    """Order and line numbers are those of one stable sort, and memory is that of a run, not of the trace."""

    def peak(pages: int) -> int:
        tracemalloc.start()
        assert sum(1 for _ in traces._spans(_LongTrace(pages), "t", 1, 0)) == pages * 500
        found = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return found

    monkeypatch.setattr(traces, "RUN", 2_000, raising=False)
    names = traces.schemas.SPANS.names
    rows = [dict(zip(names, r, strict=True)) for r in traces._spans(_LongTrace(9), "t", 1, 0)]
    every = [r for p in range(9) for r in _LongTrace(9).observations("t", p)]
    every.sort(key=lambda r: (r["start_time_s"] is not None, r["start_time_s"] or ""))
    assert [(r["span_id"], r["line_no"]) for r in rows] == [(r["span_id"], i) for i, r in enumerate(every)]
    assert peak(60) < 2.5 * peak(12)


def test_rows_of_a_large_document_leave_in_parts():
    """Of a document with a node that has no id nothing leaves, as before."""
    kids = [{"id": f"n{k}", "en": "x"} for k in range(25_000)]
    texts = [json.dumps({"framework": "f", "tree": {"id": "r", "children": c}}) for c in (kids, [*kids, {"en": "no id"}])]
    parts = list(files.taxonomy_rows([pd.DataFrame({"value": [*texts, "{bad"]})]))
    assert max(map(len, parts)) <= 10_000
    every = pd.concat(parts)
    assert len(every) == 25_001 and every["sib_pos"].tolist() == [0, *range(25_000)] and every["parent_id"].tolist() == [None, *["r"] * 25_000]


def test_only_rows_that_are_joined_arrive(spark, sf_dir, monkeypatch):
    arrived = []
    monkeypatch.setattr(streams, "run_in_arrivals", lambda parts, build, name: arrived.extend(parts) or spark.createDataFrame([], "user_id int, child_id int, parent_id int"))
    registry.queries()["stream_parent_join"](spark, sf_dir)
    assert len(arrived) == 3 and {r["event_type"] for p in arrived for r in p.select("event_type").distinct().collect()} == {"view", "purchase"}


def test_all_trusted_documents_count_unless_a_bound_is_given(spark):
    labels = spark.range(9_000).selectExpr("id AS doc_id", "if(id % 100 = 0, 0, 1) AS quality")
    assert quality_rules.trusted_ids(labels).count() == 8_910 and quality_rules.trusted_ids(labels, most=8_000).count() == 8_000
