"""From spans to training rows: the engine's analytical core as one plan.

``variant="xml"`` leaves calls in the text (closing tags restored, spans
without an output dropped); ``variant="json"`` turns them into tool calls, pairs
results with them, cleans system prompts and attaches the agent's tools.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import clean_system_prompt
from ..operators import calls, dialects, spans

_CALL = "struct<id:string,type:string,name:string,arguments:string>"

#: Converters of single frameworks; any other framework takes :func:`training_rows`.
CONVERTERS: dict[str, Callable[[DataFrame], DataFrame]] = {}


def training_rows(observed: DataFrame, agents: DataFrame | None = None, agent_tools: DataFrame | None = None, provider: str = "openai", variant: str = "xml") -> DataFrame:
    """(trace_id, span_id, agent_name, messages, finish_reason, tools) of the last generation of each parent, other agents than ``meta``.

    ``agents`` (agent_name) resolves names; ``agent_tools`` (agent_name, tools: a
    JSON list) is attached in the json variant.
    """
    last = spans.with_parent_name(spans.last_generation_per_parent(observed, provider), observed)
    if agents is None:
        named = last.withColumn("agent_name", F.col("parent_name"))
    else:
        named = spans.resolve_agent(last, agents, provider)
    rows = spans.chat_rows(spans.drop_meta(named), repair=variant == "xml")
    keys = ["trace_id", "span_id", "agent_name"]
    if variant == "xml":
        shaped = F.transform("messages", lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content"), F.lit(None).cast("string").alias("name"), F.lit(None).cast("string").alias("tool_call_id"), F.lit(None).cast(f"array<{_CALL}>").alias("tool_calls")))
        return rows.select(*keys, shaped.alias("messages"), F.lit("stop").alias("finish_reason"), F.lit(None).cast("string").alias("tools"))
    if variant != "json":
        raise ValueError(f"variant: {variant}")
    flat = rows.select(*keys, F.posexplode("messages").alias("msg_idx", "m")).select(*keys, "msg_idx", F.col("m.role").alias("role"), F.col("m.content").alias("content"))
    speech = calls.extract_calls(flat.filter("role = 'assistant'"))
    rest = flat.filter("role is distinct from 'assistant'")
    cleaned = rest.withColumn("clean_content", F.when(F.col("role") == "system", clean_system_prompt(F.col("content"))).otherwise(F.col("content"))).withColumn("tool_calls", F.lit(None).cast(f"array<{_CALL}>"))
    back = speech.unionByName(cleaned).groupBy("trace_id", "span_id").agg(F.first("agent_name").alias("agent_name"), F.sort_array(F.collect_list(F.struct("msg_idx", "role", F.col("clean_content").alias("content"), "tool_calls"))).alias("ms"))
    done = back.select(*keys, calls.pair_results(F.col("ms"), _CALL).alias("messages"), spans.finish_reason(F.element_at("ms", -1)["tool_calls"]).alias("finish_reason"))
    if agent_tools is None:
        return done.withColumn("tools", F.lit("[]"))
    return done.join(agent_tools.select("agent_name", "tools"), "agent_name", "left").select(*keys, "messages", "finish_reason", F.coalesce("tools", F.lit("[]")).alias("tools"))


def training_lines(rows: DataFrame) -> DataFrame:
    """``line``: each row as a JSON object, nulls kept; the last message's call arguments are objects (``{}`` if they can't be read)."""
    full = {"ignoreNullFields": "false"}

    def called(m, parse: bool):
        def one(c):
            args = F.coalesce(F.try_parse_json(c["arguments"]), F.parse_json(F.lit("{}"))) if parse else c["arguments"]
            return F.struct(c["id"].alias("id"), c["type"].alias("type"), F.struct(c["name"].alias("name"), args.alias("arguments")).alias("function"))

        return F.to_json(F.struct(m["role"].alias("role"), m["content"].alias("content"), m["name"].alias("name"), m["tool_call_id"].alias("tool_call_id"), F.transform(m["tool_calls"], one).alias("tool_calls")), full)

    earlier = F.transform(F.slice("messages", 1, F.greatest(F.size("messages") - 1, F.lit(0))), lambda m: called(m, False))
    texts = F.concat(earlier, F.when(F.size("messages") > 0, F.array(called(F.element_at("messages", -1), True))).otherwise(F.expr("cast(array() as array<string>)")))
    others = [c for c in rows.columns if c not in ("messages", "tools")]
    tail = F.substring(F.to_json(F.struct(*others), full), 2, 2147483647)
    tools = F.when(F.col("tools").isNotNull(), F.concat(F.lit('"tools":'), F.col("tools"), F.lit(","))).otherwise("") if "tools" in rows.columns else F.lit("")
    return rows.select(F.concat(F.lit('{"messages":['), F.array_join(texts, ","), F.lit("],"), tools, tail).alias("line"))


def convert(observed: DataFrame, framework: str, dialect: str | None = None, **how) -> DataFrame:
    """Training rows of one framework, by its own converter if it has one, and in a dialect if one is named."""
    rows = CONVERTERS[framework](observed) if framework in CONVERTERS else training_rows(observed, **how)
    return dialects.rewrite_conversations(rows, dialect) if dialect else rows
