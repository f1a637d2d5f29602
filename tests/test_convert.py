"""Spans to training rows, end to end, in both variants."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from spanloom.plans import convert

CALL = "<tool_use><tool_name>search</tool_name><parameter><q>x</q></parameter></tool_use>"


def observed(spark):
    history = [{"role": "system", "content": "Hi\n<TOOL_DEFINITIONS_START>t<TOOL_DEFINITIONS_END>"}, {"role": "user", "content": "go"}, {"role": "assistant", "content": f"ok {CALL}"}, {"role": "user", "content": "Tool execution results:<tool_result><tool_name>search</tool_name><result> R </result></tool_result>"}]
    rows = [
        ("t", "P", "SPAN", "planner", None, None, None, "2025-01-01T00:00:00Z", 0), ("t", "M", "SPAN", "meta", None, None, None, "2025-01-01T00:00:00Z", 1),
        ("t", "g1", "GENERATION", "OpenAI-generation", "P", json.dumps(history[:2]), '{"role":"assistant","content":"old"}', "2025-01-01T00:00:01Z", 2),
        ("t", "g2", "GENERATION", "OpenAI-generation", "P", json.dumps(history), json.dumps([{"role": "assistant", "content": f"then {CALL[:-11]}"}]), "2025-01-01T00:00:02Z", 3),
        ("t", "g3", "GENERATION", "OpenAI-generation", "M", json.dumps(history), '{"role":"assistant","content":"x"}', "2025-01-01T00:00:03Z", 4),
    ]
    return spark.createDataFrame(rows, "trace_id string, span_id string, span_type string, span_name string, parent_id string, input string, output string, start_time_s string, line_no long")


def test_xml_variant(spark):
    rows = convert.training_rows(observed(spark)).collect()
    assert [(r.span_id, r.agent_name) for r in rows] == [("g2", "planner")]
    assert rows[0].messages[-1].content == f"then {CALL}" and rows[0].tools is None


def test_json_variant(spark):
    tools = spark.createDataFrame([("planner", '[{"type":"function"}]')], "agent_name string, tools string")
    rows = convert.training_rows(observed(spark), agent_tools=tools, variant="json")
    m = rows.first()["messages"]
    assert [x.role for x in m] == ["system", "user", "assistant", "tool", "assistant"]
    assert m[0].content == "Hi\n" and m[2].content == "ok" and m[3].content == "R" and m[3].tool_call_id == m[2].tool_calls[0].id
    line = json.loads(convert.training_lines(rows).first()["line"])
    assert line["tools"] == [{"type": "function"}] and line["finish_reason"] == "tool_calls"
    assert line["messages"][2]["tool_calls"][0]["function"]["arguments"] == '{"q": "x"}' and line["messages"][-1]["tool_calls"][0]["function"] == {"name": "search", "arguments": {"q": "x"}}


def test_converter_override_and_dialect(spark):
    convert.CONVERTERS["own"] = lambda df: df.select("trace_id").distinct().withColumn("messages", F.lit(None).cast("array<struct<role:string,content:string>>"))
    assert convert.convert(observed(spark), "own").count() == 1
    out = convert.convert(observed(spark), "other", dialect="qwen").first()
    assert out.messages[-1].content.startswith("then <tool_call>")
