"""Queries over every kind of call block, over broken blocks and over whole training rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import calls, dialects, quality
from . import convert
from .base import Registry, table

query = Registry()

#: One message of each kind of call, by turn; the same expression in both engines.
KINDS = """CASE turn % 5
WHEN 0 THEN 'x <tool_use><tool_name>a</tool_name><parameter><q>' || conv_id || '</q></parameter></tool_use>'
WHEN 1 THEN 'x <sub-agent><agent_name>r</agent_name><message>m' || conv_id || '</message></sub-agent>'
WHEN 2 THEN 'x <use_parallel_tool_calls><parallel_tool><tool_name>a</tool_name><parameter><q>1</q></parameter></parallel_tool><parallel_tool><tool_name>b</tool_name><parameter><q>' || conv_id || '</q></parameter></parallel_tool></use_parallel_tool_calls>'
WHEN 3 THEN 'x <use_parallel_sub_agents><parallel_tool><tool_name>a</tool_name><parameter><q>2</q></parameter></parallel_tool><parallel_agent><agent_name>r</agent_name><message>m' || conv_id || '</message></parallel_agent></use_parallel_sub_agents>'
ELSE 'x <use_batch_agent><agent_name>b</agent_name><input_data_source><file_name>f' || conv_id || '</file_name><format>jsonl</format></input_data_source><message>m</message></use_batch_agent>' END"""


def _messages(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", F.lit("assistant").alias("role"), F.expr(text).alias("content"))


_CALLS = """CASE turn % 5 WHEN 0 THEN ['a {"q": "' || conv_id || '"}'] WHEN 1 THEN ['r_sub_agent {"message": "m' || conv_id || '"}'] WHEN 2 THEN ['a {"q": "1"}', 'b {"q": "' || conv_id || '"}']
WHEN 3 THEN ['r_sub_agent {"message": "m' || conv_id || '"}', 'a {"q": "2"}'] ELSE ['b_sub_agent {"batch_mode": true, "input_file": "f' || conv_id || '", "format": "jsonl", "message_template": "m"}'] END"""


@query(f"""SELECT conv_id, turn, 'x' AS clean_content, generate_subscripts(c, 1) - 1 AS nth, unnest(c) AS call FROM (SELECT *, {_CALLS} AS c FROM conversations)""")
def call_kinds_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = calls.extract_calls(_messages(spark, sf_dir, KINDS), keys=("conv_id", "turn"))
    each = made.select("conv_id", "turn", "clean_content", F.posexplode("tool_calls").alias("nth", "c"))
    return each.select("conv_id", "turn", "clean_content", F.col("nth").cast("bigint").alias("nth"), F.concat_ws(" ", "c.name", "c.arguments").alias("call"))


#: Broken calls: a bare ampersand, markup in a value, a closer that a stop sequence ate, names in capitals beside a bare sign.
BROKEN = """CASE turn % 4
WHEN 0 THEN '<tool_use><tool_name>a</tool_name><parameter><q>' || conv_id || ' & 2</q></parameter></tool_use>'
WHEN 1 THEN '<tool_use><tool_name>a</tool_name><parameter><q>x<br>' || conv_id || '</q></parameter></tool_use>'
WHEN 2 THEN '<tool_use><tool_name>a</tool_name><parameter><q>' || conv_id || '</q></parameter>'
ELSE '<tool_use><TOOL_NAME>a</TOOL_NAME> < <parameter><q>' || conv_id || '</q></parameter></tool_use>' END"""


@query("""SELECT conv_id, turn, 'a' AS name, '{"q": "' || CASE turn % 4 WHEN 0 THEN conv_id || ' & 2' WHEN 1 THEN 'x<br>' || conv_id ELSE CAST(conv_id AS VARCHAR) END || '"}' AS arguments FROM conversations""")
def broken_calls_recovered(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = calls.extract_calls(_messages(spark, sf_dir, BROKEN), keys=("conv_id", "turn"))
    return made.select("conv_id", "turn", F.explode("tool_calls").alias("c")).select("conv_id", "turn", "c.name", "c.arguments")


#: Blocks with faults that the two modes judge differently.
FAULTS = """CASE turn % 8
WHEN 0 THEN '<sub-agent><agent_name>r</agent_name><message>m</message></sub-agent>'
WHEN 1 THEN '<sub-agent><agent_name>r</agent_name><history>h</history></sub-agent>'
WHEN 2 THEN '<use_parallel_tool_calls></use_parallel_tool_calls>'
WHEN 3 THEN '<use_parallel_sub_agents><parallel_agent><agent_name>r</agent_name><message>m</message></parallel_agent><parallel_agent></use_parallel_sub_agents>'
WHEN 4 THEN '<use_batch_agent><agent_name>r</agent_name><input_data_source><file_name>f</file_name><format>jsonl</format></input_data_source><message>m</message></use_batch_agent>'
WHEN 5 THEN '<use_batch_agent></use_batch_agent>'
WHEN 6 THEN '<tool_use><tool_name>agent:x</tool_name><parameter><q>1</q></parameter></tool_use>'
ELSE '<tool_use><tool_name>a</tool_name><parameter><q>1</p></parameter></tool_use>' END"""


def _faults(mode: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return quality.message_errors(_messages(spark, sf_dir, FAULTS), mode).select("conv_id", "turn", F.size("errors").cast("bigint").alias("n_errors"))

    return run


for _mode, _counts in (("full", "[0, 2, 1, 1, 0, 3, 0, 1]"), ("tools", "[0, 0, 1, 0, 1, 3, 1, 1]")):
    query(f"SELECT conv_id, turn, {_counts}[turn % 8 + 1]::BIGINT AS n_errors FROM conversations", f"validators_{_mode}")(_faults(_mode))


def _qwen(name: str, *params: tuple[str, str]) -> str:
    lines = [f"'<tool_call>' || chr(10) || '<function={name}>'", *[f"'<parameter={k}>' || {v} || '</parameter>'" for k, v in params], "'</function>' || chr(10) || '</tool_call>'"]
    return " || chr(10) || ".join(lines)


@query(f"""SELECT conv_id, turn, 'x ' || CASE turn % 5 WHEN 0 THEN {_qwen("a", ("q", "conv_id"))} WHEN 1 THEN {_qwen("sub-agent", ("agent_name", "'r'"), ("message", "'m' || conv_id"))}
END AS content FROM conversations WHERE turn % 5 < 2
UNION ALL SELECT conv_id, turn, 'x <use_parallel_tool_calls>' || {_qwen("a", ("q", "'1'"))} || {_qwen("b", ("q", "conv_id"))} || '</use_parallel_tool_calls>' FROM conversations WHERE turn % 5 = 2
UNION ALL SELECT conv_id, turn, 'x <use_parallel_sub_agents>' || {_qwen("a", ("q", "'2'"))} || {_qwen("sub-agent", ("agent_name", "'r'"), ("message", "'m' || conv_id"))} || '</use_parallel_sub_agents>' FROM conversations WHERE turn % 5 = 3
UNION ALL SELECT conv_id, turn, 'x ' || {_qwen("batch-agent", ("agent_name", "'b'"), ("message", "'m'"), ("input_data_source", "'f' || conv_id || '|jsonl'"))} FROM conversations WHERE turn % 5 = 4""")
def dialect_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dialects.rewrite_messages(_messages(spark, sf_dir, KINDS), "qwen").select("conv_id", "turn", "content")


def conversation_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each conversation as a trace of two spans: an agent (``meta`` for one in seven) and its generation, whose answer calls a tool in every other one."""
    c = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", F.coalesce("text", F.lit("")).alias("content")))).alias("ms"))
    said = F.transform(F.slice("ms", 1, F.size("ms") - 1), lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content")))
    answer = F.when(F.col("conv_id") % 2 == 0, "done <tool_use><tool_name>a</tool_name><parameter><q>1</q></parameter></tool_use>").otherwise("done")
    base = c.select(F.col("conv_id").cast("string").alias("trace_id"), "conv_id", said.alias("said"), answer.alias("answer"))
    none = F.lit(None).cast("string")
    agent = base.select("trace_id", F.lit("p").alias("span_id"), none.alias("parent_id"), F.lit("SPAN").alias("span_type"), F.when(F.col("conv_id") % 7 == 0, "meta").otherwise("lead").alias("span_name"), none.alias("start_time_s"), F.lit(0).alias("line_no"), none.alias("input"), none.alias("output"))
    spoken = base.select("trace_id", F.lit("g").alias("span_id"), F.lit("p").alias("parent_id"), F.lit("GENERATION").alias("span_type"), F.lit("OpenAI-generation").alias("span_name"), F.lit("2024-01-01T00:00:00Z").alias("start_time_s"), F.lit(1).alias("line_no"), F.to_json("said").alias("input"), F.to_json(F.struct(F.lit("assistant").alias("role"), F.col("answer").alias("content"))).alias("output"))
    return agent.unionByName(spoken)


def _training(variant: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = convert.training_rows(conversation_spans(spark, sf_dir), variant=variant)
        last = F.element_at("messages", -1)
        return rows.select("trace_id", "agent_name", F.size("messages").cast("bigint").alias("n_messages"), F.array_join(F.transform("messages", lambda m: m["role"]), ",").alias("roles"), "finish_reason", last["content"].alias("answer"), F.coalesce(F.get(last["tool_calls"], 0)["name"], F.lit("")).alias("call"))

    return run


_TRAINING_SQL = """WITH c AS (SELECT conv_id, turn, role, max(turn) OVER (PARTITION BY conv_id) AS m, count(*) OVER (PARTITION BY conv_id) AS n FROM conversations)
SELECT CAST(conv_id AS VARCHAR) AS trace_id, 'lead' AS agent_name, n AS n_messages, string_agg(CASE WHEN turn = m THEN 'assistant' ELSE role END, ',' ORDER BY turn) AS roles,
{finish} AS finish_reason, {answer} AS answer, {call} AS call FROM c WHERE n > 1 AND conv_id % 7 <> 0 GROUP BY conv_id, n"""
query(_TRAINING_SQL.format(finish="CASE WHEN conv_id % 2 = 0 THEN 'tool_calls' ELSE 'stop' END", answer="'done'", call="CASE WHEN conv_id % 2 = 0 THEN 'a' ELSE '' END"), "training_rows_json")(_training("json"))
query(_TRAINING_SQL.format(finish="'stop'", answer="'done' || CASE WHEN conv_id % 2 = 0 THEN ' <tool_use><tool_name>a</tool_name><parameter><q>1</q></parameter></tool_use>' ELSE '' END", call="''"), "training_rows_xml")(_training("xml"))


@query("""WITH c AS (SELECT conv_id, turn, role, max(turn) OVER (PARTITION BY conv_id) AS m, count(*) OVER (PARTITION BY conv_id) AS n FROM conversations)
SELECT CAST(conv_id AS VARCHAR) AS trace_id, n AS n_messages, CASE WHEN conv_id % 2 = 0 THEN '{"q":"1"}' ELSE '' END AS arguments FROM c WHERE turn = m AND n > 1 AND conv_id % 7 <> 0""")
def training_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = convert.training_lines(convert.training_rows(conversation_spans(spark, sf_dir), variant="json"))
    read = lambda p: F.get_json_object("line", p)
    n = F.size(F.from_json(read("$.messages"), "array<string>")).cast("bigint")
    called = F.from_json(read("$.messages"), "array<struct<tool_calls:array<struct<function:struct<arguments:string>>>>>")
    return lines.select(read("$.trace_id").alias("trace_id"), n.alias("n_messages"), F.coalesce(F.get(F.element_at(called, -1)["tool_calls"], 0)["function"]["arguments"], F.lit("")).alias("arguments"))
