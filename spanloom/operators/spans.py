"""Spans: generations, last generation per parent, parent and agent names, chat rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import created_hour, restore_closing_tags
from ..storage import stored

#: Span name of a provider's generation, by provider.
PROVIDERS = {"openai": "OpenAI-generation", "anthropic": "anthropic.chat"}
EPOCH = "1970-01-01T00:00:00Z"


def is_generation(provider: str = "openai") -> Column:
    """A null name is no generation."""
    return (F.col("span_type") == "GENERATION") & F.coalesce(F.contains("span_name", F.lit(PROVIDERS[provider])), F.lit(False))


def last_generation_per_parent(spans: DataFrame, provider: str = "openai") -> DataFrame:
    """Of each parent's generations the one with the latest start (as text; none counts as 1970), of equals the last line.

    A generation without a parent stands for itself.  The row keeps the place
    of its group's first line in ``first_line``.  Only keys are compared and
    shuffled for that, with a map-side combine; the winners' rows are joined back.
    """
    key = F.when(F.coalesce("parent_id", F.lit("")) != "", F.col("parent_id")).otherwise(F.col("span_id"))
    found = spans.filter(is_generation(provider)).withColumn("__key", key)
    best = F.max(F.struct(F.coalesce("start_time_s", F.lit(EPOCH)).alias("t"), F.col("line_no").alias("line"), F.col("span_id").alias("id")))
    won = found.groupBy("trace_id", "__key").agg(best.alias("w"), F.min("line_no").alias("first_line"))
    won = won.select("trace_id", "__key", F.col("w.line").alias("line_no"), F.col("w.id").alias("span_id"), "first_line")
    out = found.join(won, ["trace_id", "__key", "line_no", "span_id"]).drop("__key")
    return out.select(*spans.columns, "first_line")


def with_parent_name(spans: DataFrame, index: DataFrame) -> DataFrame:
    """``parent_name`` of each span: the name of the last row of ``index`` with its parent's id; empty for a nameless parent, null without a parent row."""
    names = index.groupBy("trace_id", F.col("span_id").alias("parent_id")).agg(F.max_by(F.coalesce("span_name", F.lit("")), "line_no").alias("parent_name"))
    return spans.join(names, ["trace_id", "parent_id"], "left")


def resolve_agent(spans: DataFrame, agents: DataFrame, provider: str = "openai") -> DataFrame:
    """``agent_name`` from ``parent_name``: a known agent by exact, then by case-insensitive name (its own spelling), else the raw name.

    The provider's name and the empty name are no agent (null).
    """
    known = agents.groupBy(F.lower("agent_name").alias("__low")).agg(F.collect_set("agent_name").alias("__set"), F.min("agent_name").alias("__any"))
    joined = spans.join(known, F.lower("parent_name") == F.col("__low"), "left")
    raw = F.when(~F.col("parent_name").isin("", PROVIDERS[provider]), F.col("parent_name"))
    name = F.when(F.array_contains("__set", F.col("parent_name")), F.col("parent_name")).otherwise(F.coalesce("__any", raw))
    return joined.withColumn("agent_name", name).drop("__low", "__set", "__any")


def resolve_agent_by_ancestry(spans: DataFrame, provider: str = "openai", most: int = 20) -> DataFrame:
    """(trace_id, span_id, agent_name): the nearest ancestor's name that isn't the provider's, up to ``most`` steps (loops end there).

    Pointer jumping: a span that has not met a name yet looks where the span it
    points to points, so ``most`` steps take a logarithm of joins, each stored.
    """
    index = spans.groupBy("trace_id", "span_id").agg(F.max_by(F.struct("span_name", "parent_id"), "line_no").alias("s"))
    index = stored(index.select("trace_id", "span_id", F.coalesce("s.span_name", F.lit("")).alias("span_name"), "s.parent_id"), "span-index")
    above = index.select("trace_id", F.col("span_id").alias("parent_id"), F.col("span_name").alias("name"), F.col("parent_id").alias("at"))
    own = F.when(~F.col("name").isin("", PROVIDERS[provider]), F.col("name"))
    jumps = stored(index.join(above, ["trace_id", "parent_id"]).select("trace_id", "span_id", own.alias("name"), F.col("parent_id").alias("at"), F.lit(1).alias("steps")), "jumps")
    for _ in range(max(1, most).bit_length()):
        further = jumps.select("trace_id", F.col("span_id").alias("at"), F.col("name").alias("name2"), F.col("at").alias("at2"), F.col("steps").alias("steps2"))
        moved = jumps.filter("name is null").join(further, ["trace_id", "at"]).select("trace_id", "span_id", F.col("name2").alias("name"), F.col("at2").alias("at"), (F.col("steps") + F.col("steps2")).alias("steps"))
        jumps = stored(jumps.filter("name is not null").unionByName(moved), "jumps")
    return jumps.filter((F.col("name").isNotNull()) & (F.col("steps") <= most)).select("trace_id", "span_id", F.col("name").alias("agent_name"))


def drop_meta(df: DataFrame, meta: str = "meta") -> DataFrame:
    """Rows of other agents; a null agent passes."""
    return df.filter(~F.col("agent_name").eqNullSafe(F.lit(meta)))


def output_message(output: Column) -> Column:
    """The message in an ``output`` document: an object, or a list's first element; null for anything else."""
    doc = F.try_parse_json(output)
    kind = F.schema_of_variant(doc)
    return F.when(kind.startswith("OBJECT"), doc).when(kind.startswith("ARRAY"), F.try_variant_get(doc, "$[0]", "variant"))


def chat_rows(spans: DataFrame, repair: bool = True) -> DataFrame:
    """Spans with ``input`` messages and a non-null ``output`` as rows of messages, the response last.

    ``messages`` is array<struct<role,content>>; with ``repair``, closing tags
    of assistants' content are restored.  Spans with no input or no output give
    no row; the time of the generation is in ``created_hour``.
    """
    shape = "array<struct<role:string,content:string>>"
    answer = output_message(F.col("output"))
    pair = F.struct(F.coalesce(F.try_variant_get(answer, "$.role", "string"), F.lit("assistant")).alias("role"), F.try_variant_get(answer, "$.content", "string").alias("content"))
    read = spans.withColumn("__in", F.from_json("input", shape)).filter((F.size("__in") > 0) & F.col("output").isNotNull()).withColumn("__out", pair)
    fix = lambda m: F.struct(m["role"].alias("role"), F.when(m["role"] == "assistant", restore_closing_tags(m["content"])).otherwise(m["content"]).alias("content"))
    messages = F.concat("__in", F.array("__out"))
    return read.withColumn("messages", F.transform(messages, fix) if repair else messages).withColumn("created_hour", created_hour(F.col("start_time_s"))).drop("__in", "__out")


def flatten_messages(messages: DataFrame, keys: list[str], order: str) -> DataFrame:
    """One row per conversation: ``messages`` in order, ``n_messages`` and the last message's role."""
    rows = messages.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(order, "role", F.col("text").alias("content")))).alias("__m"))
    return rows.select(*keys, F.transform("__m", lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content"))).alias("messages"), F.size("__m").cast("long").alias("n_messages"), F.element_at("__m", -1)["role"].alias("last_role"))


def finish_reason(calls: Column) -> Column:
    return F.when(F.coalesce(F.size(calls), F.lit(0)) > 0, "tool_calls").otherwise("stop")
