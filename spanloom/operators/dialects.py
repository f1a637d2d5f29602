"""Tool calls in model-specific text forms."""

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import xmlcalls
from ..functions.xmlcalls import DIALECTS


def _lines(head: Column, params: Column, each, tail: Column) -> Column:
    return F.concat_ws("\n", head, F.transform(params, each), tail)


def render_call(name: Column, params: Column, dialect: str) -> Column:
    """A call as text, by expressions alone; ``params`` is array<struct<k,v>> in order."""
    c = F.concat
    if dialect == "qwen":
        return _lines(c(F.lit("<tool_call>\n<function="), name, F.lit(">")), params, lambda p: c(F.lit("<parameter="), p["k"], F.lit(">"), p["v"], F.lit("</parameter>")), F.lit("</function>\n</tool_call>"))
    if dialect == "minimax":
        return _lines(c(F.lit("<invoke name="), name, F.lit(">")), params, lambda p: c(F.lit("<parameter name="), p["k"], F.lit(">"), p["v"], F.lit("</parameter>")), F.lit("</invoke>"))
    if dialect == "glm":
        return _lines(c(F.lit("<tool_call>"), name), params, lambda p: c(F.lit("<arg_key>"), p["k"], F.lit("</arg_key>\n<arg_value>"), p["v"], F.lit("</arg_value>")), F.lit("</tool_call>"))
    if dialect == "openrouter":
        return _lines(c(F.lit("<"), name, F.lit(">")), params, lambda p: c(F.lit("<"), p["k"], F.lit(">"), p["v"], F.lit("</"), p["k"], F.lit(">")), c(F.lit("</"), name, F.lit(">")))
    if dialect == "deepseek":
        quoted = lambda x: F.substring(F.to_json(F.array(x)), 2, 2147483647)  # noqa: E731  a JSON string and a bracket
        item = lambda p: c(F.regexp_replace(quoted(p["k"]), r"\]\z", ""), F.lit(": "), F.regexp_replace(quoted(p["v"]), r"\]\z", ""))
        body = c(F.lit("{"), F.array_join(F.transform(params, item), ", "), F.lit("}"))
        return c(F.lit("<｜tool▁calls▁begin｜><｜tool▁call▁begin｜>"), name, F.lit("<｜tool▁sep｜>"), body, F.lit("<｜tool▁call▁end｜><｜tool▁calls▁end｜>"))
    raise ValueError(f"dialect: {dialect}; there are {DIALECTS}")


def rewriter(dialect: str):
    """Arrow-batched UDF from a message's text to the same text in ``dialect``."""
    if dialect not in DIALECTS:
        raise ValueError(f"dialect: {dialect}; there are {DIALECTS}")

    @F.pandas_udf("string")
    def rewrite(text: pd.Series) -> pd.Series:
        return text.map(lambda t: xmlcalls.rewrite_message(t, dialect), na_action="ignore")

    return rewrite


def leaf_rewriter(dialect: str):
    """The same for all strings of a JSON document."""

    @F.pandas_udf("string")
    def rewrite(doc: pd.Series) -> pd.Series:
        return doc.map(lambda t: xmlcalls.rewrite_leaves(t, dialect), na_action="ignore")

    return rewrite


def rewrite_messages(messages: DataFrame, dialect: str, text_col: str = "content", role_col: str = "role") -> DataFrame:
    """``messages`` with the text of system and assistant messages in ``dialect``; only texts with ``<`` go through the parser."""
    gate = F.coalesce(F.col(role_col).isin("system", "assistant") & F.contains(text_col, F.lit("<")), F.lit(False))
    rest = messages.filter(~gate)
    return rest.unionByName(messages.filter(gate).withColumn(text_col, rewriter(dialect)(F.col(text_col))))


def rewrite_conversations(rows: DataFrame, dialect: str, messages_col: str = "messages", tools_col: str | None = None) -> DataFrame:
    """Rows of conversations in ``dialect``: messages of system and assistants, and (if named) all strings of the tools' JSON.

    A conversation's texts go through the parser as one array and come back in
    their places; all other fields of its messages stay.
    """
    if dialect not in DIALECTS:
        raise ValueError(f"dialect: {dialect}; there are {DIALECTS}")

    @F.pandas_udf("array<string>")
    def rewrite(texts: pd.Series) -> pd.Series:
        return texts.map(lambda ts: [xmlcalls.rewrite_message(t, dialect) for t in ts], na_action="ignore")

    said = F.transform(messages_col, lambda m: F.when(m["role"].isin("system", "assistant"), m["content"]))
    done = rows.withColumn("__said", rewrite(said))
    put = F.zip_with(messages_col, "__said", lambda m, t: m.withField("content", F.coalesce(t, m["content"])))
    out = done.withColumn(messages_col, put).drop("__said")
    return out.withColumn(tools_col, leaf_rewriter(dialect)(F.col(tools_col))) if tools_col else out
