"""Explicit schemas of the engine's tables; nothing is inferred from data."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {"string": T.StringType(), "int": T.IntegerType(), "bigint": T.LongType(), "double": T.DoubleType(), "boolean": T.BooleanType(), "timestamp": T.TimestampType(), "array<string>": T.ArrayType(T.StringType())}


def _of(fields: str, **nested: T.DataType) -> T.StructType:
    """A schema from ``name type`` pairs, read without a session; ``nested`` types follow the plain ones."""
    plain = [T.StructField(*(n := f.split())[:1], _TYPES[n[1]]) for f in fields.split(", ")]
    return T.StructType(plain + [T.StructField(k, v) for k, v in nested.items()])


CALL = _of("id string, type string, name string, arguments string")
MESSAGE = _of("role string, content string, name string, tool_call_id string", tool_calls=T.ArrayType(CALL))

#: input, output, usage and metadata keep their JSON text: their shapes differ from row to row.
SPANS = _of("trace_id string, span_id string, span_type string, span_name string, model string, input string, output string, start_time_s string, end_time_s string, usage string, metadata string, parent_id string, level string, src_file string, line_no bigint, _raw string")
MESSAGES = _of("trace_id string, span_id string, msg_idx int, role string, content string, name string, tool_call_id string", tool_calls=T.ArrayType(CALL))
CONVERSATIONS = _of("trace_id string, span_id string, agent_name string, tools string", messages=T.ArrayType(MESSAGE))
TAXONOMY_NODES = _of("framework string, id string, parent_id string, en string, zh string, sib_pos int")
TAXONOMY_PATHS = _of("framework string, path_id string, node_ids array<string>, labels_en array<string>, labels_zh array<string>, depth int")
SAMPLING_COUNTS = _of("framework string, path_id string, n bigint")
PERSONAS = _of("persona_idx bigint, persona string, persona_chinese string, metadata string")
AGENTS = _of("framework string, agent_name string, description string, tools array<string>, mcp_servers array<string>, sysprompt_path string, llm_config string")
TOOLS = _of("framework string, tool_name string, description string, config_path string, binding string, input_schema string")
LLM_CONFIGS = _of("framework string, llm_name string, provider string, model string, max_tokens int, temperature double, timeout int")
WORKFLOW_NODES = _of("framework string, id string, type string")
WORKFLOW_EDGES = _of("framework string, src string, dst string")
QUERIES = _of("query string, difficulty string, problem_type string, trace_context array<string>, framework string, requires_local_files boolean, used_web_search boolean, fuzzified boolean, original_query string, metadata string")
RUNS = _of("query_index bigint, framework string, success boolean, stop string, reason string, trace_id string, completed_at timestamp")
TRACES_DONE = _of("trace_id string, status string")


def json_schemas() -> dict[str, str]:
    """Every schema as its JSON text, by name."""
    return {k.lower(): v.json() for k, v in globals().items() if isinstance(v, T.StructType)}
