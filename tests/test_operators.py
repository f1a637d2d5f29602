"""Operators on hand-written rows: ties, nulls, empty tables, out-of-order results."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from spanloom import adapters, schemas
from spanloom.functions import text as X
from spanloom.operators import calls, dialects, quality, spans, stats, synth, taxonomy, urls
from spanloom.sources import files, sinks, traces
from spanloom.streaming import streams

ROWS = [  # span_id, type, name, parent, start
    ("P1", "SPAN", "Researcher", None, "2025-01-01T00:00:00Z"), ("P2", "SPAN", "meta", None, "2025-01-01T00:00:00Z"),
    ("s1", "GENERATION", "OpenAI-generation", "P1", "2025-01-01T00:00:01Z"), ("s2", "GENERATION", "OpenAI-generation", "P1", "2025-01-01T00:00:03Z"),
    ("s3", "GENERATION", "OpenAI-generation", "P1", "2025-01-01T00:00:03Z"), ("s4", "GENERATION", "OpenAI-generation", "P2", None),
    ("s5", "GENERATION", "OpenAI-generation", "P2", "2025-01-01T00:00:02Z"), ("s6", "GENERATION", "OpenAI-generation", None, "2025-01-01T00:00:09Z"),
    ("s7", "GENERATION", "other-llm", "P1", "2025-01-01T00:00:10Z"), ("s8", "GENERATION", None, "P1", "2025-01-01T00:00:11Z"),
]


@pytest.fixture(scope="module")
def span_rows(spark):
    rows = [("t", *r, i) for i, r in enumerate(ROWS)]
    return spark.createDataFrame(rows, "trace_id string, span_id string, span_type string, span_name string, parent_id string, start_time_s string, line_no long")


def val(spark, col):
    return spark.range(1).select(col.alias("x")).first()["x"]


def test_last_generation(span_rows):
    out = spans.last_generation_per_parent(span_rows).orderBy("first_line").collect()
    assert [r.span_id for r in out] == ["s3", "s5", "s6"]
    assert spans.last_generation_per_parent(span_rows.limit(0)).count() == 0


def test_agent_names(spark, span_rows):
    last = spans.with_parent_name(spans.last_generation_per_parent(span_rows), span_rows)
    named = spans.resolve_agent(last, spark.createDataFrame([], "agent_name string"))
    assert {r.span_id: r.agent_name for r in named.collect()} == {"s3": "Researcher", "s5": "meta", "s6": None}
    assert {r.span_id for r in spans.drop_meta(named).collect()} == {"s3", "s6"}
    known = spans.resolve_agent(last, spark.createDataFrame([("researcher",)], "agent_name string"))
    assert {r.span_id: r.agent_name for r in known.collect()}["s3"] == "researcher"


def test_agent_by_ancestry(spark):
    rows = [("t", "a", "lead", None, 0), ("t", "b", "OpenAI-generation", "a", 1), ("t", "c", "OpenAI-generation", "b", 2), ("t", "x", "OpenAI-generation", "x", 3)]
    df = spark.createDataFrame(rows, "trace_id string, span_id string, span_name string, parent_id string, line_no long")
    assert {r.span_id: r.agent_name for r in spans.resolve_agent_by_ancestry(df).collect()} == {"b": "lead", "c": "lead"}


def test_duplicate_parent_last_wins(spark):
    rows = [("t", "p", "old", None, 0), ("t", "p", "new", None, 1), ("t", "c", "x", "p", 2)]
    df = spark.createDataFrame(rows, "trace_id string, span_id string, span_name string, parent_id string, line_no long")
    assert spans.with_parent_name(df.filter("span_id = 'c'"), df).first()["parent_name"] == "new"


@pytest.mark.parametrize(("output", "content"), [('{"role":"assistant","content":"a"}', "a"), ('[{"role":"assistant","content":"a"}]', "a"), ('"a"', None), (None, "gone")])
def test_output_shapes(spark, output, content):
    df = spark.createDataFrame([("t", '[{"role":"user","content":"q"}]', output, "2025-09-24T12:34:56.789Z")], "trace_id string, input string, output string, start_time_s string")
    rows = spans.chat_rows(df).collect()
    if content == "gone":
        assert not rows
    else:
        assert rows[0].messages[-1].content == content and rows[0].created_hour == 2025092412


@pytest.mark.parametrize(
    ("text", "out"),
    [
        ("plain", "plain"), ("<tool_use><tool_name>a</tool_name>", "<tool_use><tool_name>a</tool_name></tool_use>"),
        ("<use_parallel_tool_calls><parallel_tool><tool_name>a</tool_name>", "<use_parallel_tool_calls><parallel_tool><tool_name>a</tool_name></parallel_tool></use_parallel_tool_calls>"),
        ("<tool_use>a <tool_use>b", "<tool_use>a <tool_use>b</tool_use>"), ("<tool_use>a</tool_use>", "<tool_use>a</tool_use>"), (None, None),
    ],
)
def test_closing_tags(spark, text, out):
    assert val(spark, X.restore_closing_tags(F.lit(text).cast("string"))) == out



def pairs(spark, pending, content):
    m = [("assistant", "x", pending), ("user", content, None)]
    df = spark.createDataFrame([(m,)], "ms array<struct<role:string,content:string,tool_calls:array<struct<id:string,name:string>>>>")
    return [(r.tool_call_id, r.name, r.content) for r in df.select(F.explode(calls.pair_results(F.col("ms"))).alias("m")).select("m.*").collect() if r.role == "tool"]


def test_pairing(spark):
    one = "Tool execution results:<tool_result><tool_name>{}</tool_name><result>{}</result></tool_result>"
    two = one + "<tool_result><tool_name>{}</tool_name><result>{}</result></tool_result>"
    assert pairs(spark, [("c1", "search"), ("c2", "fetch")], two.format("fetch", "F", "search", "S")) == [("c2", "fetch", "F"), ("c1", "search", "S")]
    assert pairs(spark, [("c3", "x")], one.format("y", "Q")) == [("c3", "y", "Q")]
    fresh = pairs(spark, [], one.format("z", "R"))
    assert fresh[0][0].startswith("call_") and fresh[0][1:] == ("z", "R")
    assert pairs(spark, [("c4", "w")], "Tool execution results: oops") == [("c4", "unknown_tool", "oops")]
    assert pairs(spark, [("a", "t"), ("b", "t")], two.format("t", "1", "t", "2")) == [("a", "t", "1"), ("b", "t", "2")]


def test_render_agrees_with_parser(spark):
    from spanloom.functions import xmlcalls

    text = '<tool_use><tool_name>f</tool_name><parameter><a>x "y" \\ é</a><b>2</b></parameter></tool_use>'
    for d in xmlcalls.DIALECTS:
        call = F.get(calls.simple_calls(F.lit(text)), 0)
        assert val(spark, dialects.render_call(call["name"], call["params"], d)) == xmlcalls.rewrite_message(text, d)


def test_conversation_rewrite(spark):
    call = "<tool_use><tool_name>f</tool_name><parameter><a>1</a></parameter></tool_use>"
    df = spark.createDataFrame([(1, [("user", call), ("assistant", call)], json.dumps([call])), (2, None, None)], "id int, messages array<struct<role:string,content:string>>, tools string")
    out = {r.id: r for r in dialects.rewrite_conversations(df, "glm", tools_col="tools").collect()}
    assert out[1].messages[0].content == call and out[1].messages[1].content.startswith("<tool_call>f") and "tool_call" in out[1].tools
    assert out[2].messages is None and out[2].tools is None


def test_filter_valid(spark):
    good = json.dumps({"messages": [{"role": "assistant", "content": "ok"}]})
    bad = json.dumps({"messages": [{"role": "user", "content": "<tool_use>"}, {"role": "assistant", "content": "<tool_use>"}]})
    df = spark.createDataFrame([(good,), (bad,), ("{no",), ('{"messages": 1}',)], "line string")
    out = {r.line: r for r in quality.filter_valid(df).collect()}
    assert out[good].valid and not out[bad].valid and out[bad].errors[0].startswith("Msg1: ")
    assert not out["{no"].valid and not out['{"messages": 1}'].valid
    assert tuple(quality.filter_statistics(quality.filter_valid(df)).first()) == (4, 1, 3)


TREE = {"framework": "f", "tree": {"id": "root", "en": "R", "zh": "R", "children": [{"id": "a", "en": "A", "zh": "A", "children": [{"id": "a1", "en": "", "zh": ""}, {"id": "a2", "en": "", "zh": "", "children": [{"id": "a2x", "en": "", "zh": ""}]}]}, {"id": "b", "en": "B", "zh": "B", "children": [{"id": "b1", "en": "", "zh": ""}]}]}}


def test_taxonomy(spark):
    nodes = files.taxonomy(spark, json.dumps(TREE))
    found = taxonomy.paths(nodes)
    assert [r.path_id for r in found.orderBy("dfs_key").collect()] == ["root→a→a1", "root→a→a2→a2x", "root→b→b1"]
    s = taxonomy.statistics(nodes, found).first()
    assert (s.total_nodes, s.total_paths, s.max_depth, s.min_depth) == (7, 3, 4, 3) and abs(s.avg_depth - 10 / 3) < 1e-9
    grown = taxonomy.add_children(nodes, spark.createDataFrame([("f", "b2", "b", "x", "x"), ("f", "a", "b", "known", ""), ("f", "q", "nowhere", "", "")], "framework string, id string, parent_id string, en string, zh string"))
    assert grown.count() == 8 and grown.filter("id = 'b2'").first()["sib_pos"] == 1


def test_truncation(spark):
    cut = lambda n, k: val(spark, F.size(taxonomy.truncate(F.array(*[F.lit(str(i)) for i in range(n)]), F.lit(k))))
    assert {cut(3, k) for k in range(5)} == {3} and {cut(4, k) for k in range(12)} == {3, 4} and cut(2, 1) in (-1, None)


def test_sampling(spark):
    counts = spark.createDataFrame([("f", "x", 0), ("f", "y", 1), ("f", "z", 3)], "framework string, path_id string, n long")
    p = {r.path_id: r.probability for r in taxonomy.probabilities(counts.select("framework", "path_id"), counts).collect()}
    assert abs(p["x"] - 0.676336753) < 1e-8 and abs(p["z"] - 0.084542094) < 1e-8
    a = spark.createDataFrame([("f", "p", 2), ("f", "q", 1)], counts.schema)
    b = spark.createDataFrame([("f", "q", 3), ("f", "r", 1)], counts.schema)
    assert {r.path_id: r.n for r in taxonomy.merge_counts(a, b).collect()} == {"p": 2, "q": 4, "r": 1}


def test_distribution():
    assert synth.parse_distribution("easy:0.2,medium:0.5,hard:0.3")["hard"] == 0.3
    synth.parse_distribution("easy:0.2005,medium:0.5,hard:0.3")
    for bad in ("easy:1", "easy:0.21,medium:0.5,hard:0.3", "easy:2,medium:-1,hard:0", "easy"):
        with pytest.raises(ValueError):
            synth.parse_distribution(bad)


def test_responses(spark):
    q = val(spark, X.english_queries(F.lit("**QUERIES:**\n**EASY:** a\nb\n**HARD:** c\n")))
    assert [tuple(r) for r in q] == [("easy", "a\nb"), ("hard", "c")]
    assert [tuple(r) for r in val(spark, X.chinese_queries(F.lit("**简单:** 甲 **困难:** 乙")))] == [("easy", "甲"), ("hard", "乙")]
    assert val(spark, synth.pick_query(X.english_queries(F.lit("**EASY:** a\n**HARD:** c")), F.lit("medium")))["query"] == "a"
    assert [val(spark, X.suitable(F.lit(t))) for t in ("SUITABLE", "not_suitable", "Suitable, nothing wrong")] == [True, False, False]
    assert val(spark, X.new_tag(F.lit('x {"en":"E","zh":"Z","id":"k"} y'), F.lit("p")))["id"] == "p_k"
    r = val(spark, X.repair_response(F.lit('```json\n{"repairable": true, "suggested_urls": []}\n```')))
    assert not r["repairable"] and r["action"] == "remove"


def test_scalars(spark):
    assert [val(spark, X.trace_name(F.lit(t).cast("string"))) for t in (" a b/c ", "..", None)] == ["a_b_c", "unnamed_trace", "unnamed_trace"]
    assert [val(spark, X.slug(F.lit(t))) for t in ("My Data__v2!", "!!")] == ["my-data-v2", None]
    change = F.array(F.struct(F.lit("U1").alias("url"), F.lit("replace").alias("action"), F.lit("V").alias("new_url")), F.struct(F.lit("U2").alias("url"), F.lit("remove").alias("action"), F.lit("").alias("new_url")))
    assert val(spark, X.rewrite_urls(F.lit("see U1 and U2"), change)) == "see V and [URL removed]"
    assert val(spark, X.trace_id_in(F.lit("x LangfuseTraceID: ab-12 y"))) == "ab-12" and val(spark, X.trace_id_in(F.lit(""))) is None
    assert val(spark, X.shorten(F.lit("a  b " * 40))).endswith("...") and len(val(spark, X.shorten(F.lit("a  b " * 40)))) <= 80
    assert val(spark, X.data_url_bytes(F.lit("data:text/plain;base64,aGk="))) == b"hi"
    cleaned = val(spark, X.clean_system_prompt(F.lit("Hi\n## Available Tools\nx\n## Available Sub-Agents\ny\nWhen you use tools or sub-agents z\n\nIMPORTANT: k")))
    assert cleaned == "Hi\n\n\nIMPORTANT: k"


def test_files(spark, tmp_path):
    (tmp_path / "q.jsonl").write_text('{"query":"q1","framework":"f1"}\n\n{bad\n{"query":"q2"}\n{"query":"","framework":"f1"}\n')
    p = str(tmp_path / "q.jsonl")
    got = lambda **k: [r["query"] for r in files.queries(spark, p, **k).orderBy("line_no").collect()]
    assert got() == ["q1", "q2", ""] and got(frameworks=["f1"]) == ["q1", ""] and got(frameworks=["deer-flow"]) == ["q2"] and got(limit=1) == ["q1"]
    assert [r["_raw"] for r in files.dead_letters(files.json_lines(spark, p)).collect()] == ["{bad"]
    (tmp_path / "p.jsonl").write_text('{"persona":"a","x":1}\n{"persona":"","persona_chinese":"b"}\n')
    people = files.personas(spark, str(tmp_path / "p.jsonl")).orderBy("persona_idx").collect()
    assert json.loads(people[0].metadata) == {"x": "1"} and people[1].persona_chinese == "b"
    (tmp_path / "tree.json").write_text(json.dumps(TREE))
    assert files.taxonomies(spark, str(tmp_path / "tree.json")).count() == 7
    assert files.env_values("A=1\n# c\nB\nC = 'x'", {"A": "9", "Z": "0"}) == {"A": "9", "C": "x"}


def test_configs(spark, tmp_path):
    (tmp_path / "fw").mkdir()
    (tmp_path / "fw" / "c.json").write_text(json.dumps({"agents": [{"agent_name": "a", "sysprompt_path": "p", "tools": ["t"]}, {"agent_name": "a"}], "tools": [{"tool_name": "t", "description": "d", "config_path": "c"}], "llm_configs": [{"llm_name": "m", "max_tokens": 0, "temperature": 1, "timeout": 5}], "workflow": {"nodes": [{"id": "a", "type": "agent"}, {"id": "x", "type": "tool"}], "edges": [{"from": "a", "to": "x"}]}}))
    tables = files.framework_configs(spark, str(tmp_path / "fw"))
    assert calls.workflow_successors(tables["edges"], tables["nodes"]).count() == 0
    problems = {r.problem for r in files.config_violations(tables).collect()}
    assert problems == {"agent without a prompt", "max_tokens out of range", "agent_name is not unique"}


def test_trace_source(spark):
    df = traces.traces(spark, traces="6", page="2", start="2024-01-01T01:00:00", end="2024-01-01T03:00:00")
    assert {r.trace_id for r in df.collect()} == {"t0001", "t0002", "t0003"}
    one = df.filter("trace_id = 't0001'").orderBy("line_no").collect()
    assert [r.start_time_s for r in one] == sorted(r.start_time_s for r in one) and df.columns == schemas.SPANS.names


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a b", 1), ("a b", 2), (None, 3)], "trace_name string, n int")
    sinks.write_by_trace_name(df, str(tmp_path / "out"))
    assert {p.name for p in (tmp_path / "out").iterdir() if p.is_dir()} == {"trace_name_safe=a_b", "trace_name_safe=unnamed_trace"}
    sinks.write_json_lines(df, str(tmp_path / "j"))
    sinks.write_json_lines(df, str(tmp_path / "j"), "append")
    assert spark.read.json(str(tmp_path / "j")).count() == 6
    good, bad = sinks.split_dead_letters(df, F.col("trace_name") == "a b")
    assert (good.count(), bad.count()) == (2, 1)


def test_synthesis(spark):
    draws = spark.createDataFrame([(i, "geo", f"persona {i}", "sorting", ["root", "x"], "tools") for i in range(40)], "draw_id int, framework string, persona string, problem_type string, trace_context array<string>, capabilities string")
    out = synth.query_records(synth.synthesise(draws)).collect()
    assert len(out) == 40 and {r.difficulty for r in out} <= {"easy", "medium", "hard"}
    assert all((r.original_query is not None) == r.fuzzified for r in out) and any(r.fuzzified for r in out)
    mute = synth.SynthesisConfig(llm=silent())
    assert synth.query_records(synth.synthesise(draws, mute)).count() == 0
    assert synth.synthesise(draws, synth.SynthesisConfig(language="chinese")).filter("query is null").count() == 0


def silent():
    """Answers nothing; made here so that workers get it by value."""
    return lambda requests: ["" for _ in requests]


def broken():
    return lambda requests: ["200" if "://ok." in u else "404" for u in requests]


def test_url_repair(spark):
    df = spark.createDataFrame([(1, "see http://a.example/x and http://b.example/y."), (2, "none"), (3, None)], "id int, query string")
    out = {r.id: r for r in urls.repair_urls(df, "id", "query", broken(), adapters.StubLLM()).collect()}
    assert out[1]["query"].count("https://ok.example/") == 2 and tuple(out[1].url_stats) == (2, 0, 2, 0)
    assert out[2]["query"] == "none" and out[2].url_stats is None and out[3]["query"] is None
    gone = {r.id: r for r in urls.repair_urls(df, "id", "query", broken(), silent()).collect()}
    assert gone[1]["query"] == "see [URL removed] and [URL removed]."


def test_numbers_and_shares(spark):
    df = spark.createDataFrame([(i,) for i in range(50)], "v int").repartition(5)
    assert [(r.v, r.number) for r in stats.numbered(df, "v").orderBy("v").collect()] == [(i, i + 1) for i in range(50)]
    assert stats.run_summary(spark.createDataFrame([], "success boolean")).count() == 0


def test_closed_groups(spark, tmp_path):
    rows = spark.createDataFrame([("a", "2024-01-01 00:00:00", "x"), ("a", "2024-01-01 00:00:05", "y"), ("b", "2024-01-01 01:00:00", "z")], "k string, ts string, v string").withColumn("ts", F.to_timestamp("ts"))
    for i, part in enumerate((rows.filter("k = 'a'"), rows.filter("k = 'b'"), rows.filter("k = 'c'"))):
        part.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    s = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    out = streams.run_available(streams.closed_groups(s, "k", "ts", "v"), "closed", "append", str(tmp_path / "cp")).collect()
    assert [(r.k, r.last_value, r.n) for r in out] == [("a", "y", 2)]


def test_windowed_counts(spark, tmp_path):
    rows = spark.createDataFrame([("a", "2024-01-01 00:00:00"), ("a", "2024-01-01 00:30:00"), ("a", "2024-01-01 05:00:00")], "k string, ts string").withColumn("ts", F.to_timestamp("ts"))
    rows.coalesce(1).write.parquet(str(tmp_path / "in"))
    s = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    out = streams.run_available(streams.windowed_counts(s, "ts", "k"), "windows", "append", str(tmp_path / "cp")).collect()
    assert [r.n for r in out] == [2]
