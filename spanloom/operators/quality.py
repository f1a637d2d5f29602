"""Validity of the XML in assistant messages."""

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import xmlcalls

TAGS = {"full": ["tool_use", "sub-agent", "use_parallel_tool_calls", "use_parallel_sub_agents", "use_batch_agent"], "tools": ["tool_use", "use_parallel_tool_calls", "use_batch_agent"]}


def error_finder(mode: str = "full", strict: bool = True):
    """Arrow-batched UDF from a text to its list of errors."""

    @F.pandas_udf("array<string>")
    def find(text: pd.Series) -> pd.Series:
        return pd.Series([xmlcalls.message_errors(t, mode, strict) for t in text], dtype=object)

    return find


# Fixed values as Java's classes: what a tag's name begins with and goes on with, white space, and the elements that need no closer.
_NAME = r"[A-Za-z\x{4e00}-\x{9fff}][\p{L}\p{N}_\x{4e00}-\x{9fff}:-]*+"
_SPACE = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_VOID = ["br", "img", "hr", "input", "meta", "link"]
_TAG = rf"</?{_NAME}(?:/?>|{_SPACE}[^>]*+>)"


def _until_last(text: Column, mark: str) -> Column:
    """The text up to its last ``mark``, which a search for the mark from any place before then finds; empty without one."""
    return F.left(text, F.length(text) - F.length(F.substring_index(text, mark, -1)))


def tag_balance(rows: DataFrame, key: str, text: str, strict: bool = True) -> DataFrame:
    """(key, n_errors, errors): the tags without their partner in each row's text, as :func:`xmlcalls.tag_errors` finds them.

    A closer uses up the last opener that waits, whatever its name.  So with the
    running depth (openers less closers so far) each closer's partner is the tag
    before it of the same depth, and an opener is closed by the tag after it:
    two windows over a text's tags, which one shuffle by the key deals out.  A
    closer that nothing waits for is the first tag of its depth.

    ``key`` tells the rows apart (rows of one key would be read as one text); a
    null or empty text has no errors.  Tags of a text pass through a window that
    keeps sums only, so a long text asks for time, not for memory.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    commented = _until_last(whole, "-->")
    plain = F.concat(F.regexp_replace(commented, "(?s)<!--.*?-->", ""), F.substring(whole, F.length(commented) + 1, F.length(whole)))
    read = rows.select(key, plain.alias("__plain")).select(key, _until_last(F.col("__plain"), ">").alias("__plain"))
    token = F.col("__token")
    parts = read.select(key, F.posexplode_outer(F.regexp_extract_all("__plain", F.lit(f"{_TAG}|[^<]++|<"), 0)).alias("__n", "__token"))
    name = F.regexp_extract(token, f"^</?({_NAME})(?:/?>|{_SPACE})", 1)
    closer = token.startswith("</")
    # what opens or closes nothing: no tag at all, <name/>, an element without a closer
    alone = (name == "") | token.rlike(f"^</?{_NAME}/>$") | (F.lower(name).isin(_VOID) & ~closer)
    if not strict:
        alone = alone | token.endswith("/>")
    step = F.when(F.coalesce(alone, F.lit(True)), 0).when(closer, -1).otherwise(1)
    small = parts.select(key, "__n", F.length(token).alias("__len"), step.alias("__step"), F.when(step != 0, name).alias("__name"))
    so_far = W.partitionBy(key).orderBy("__n").rowsBetween(W.unboundedPreceding, 0)
    placed = small.withColumn("__at", F.sum("__len").over(so_far) - F.col("__len")).withColumn("__sum", F.sum("__step").over(so_far))
    level = F.when(F.col("__step") != 0, F.col("__sum") + F.when(F.col("__step") < 0, 1).otherwise(0))
    level_order = W.partitionBy(key, "__level").orderBy("__n")
    met = placed.withColumn("__level", level).withColumn("__before", F.lag(F.struct("__name", "__at")).over(level_order)).withColumn("__after", F.lead("__n").over(level_order))
    tag = lambda n, at, slash="": F.concat(F.lit(f"<{slash}"), n, F.lit("> at "), at)
    own = F.col("__step")
    problem = (
        F.when((own < 0) & F.col("__before").isNull(), F.concat(tag(F.col("__name"), F.col("__at"), "/"), F.lit(" closes nothing")))
        .when((own < 0) & (F.col("__before.__name") != F.col("__name")), F.concat(tag(F.col("__before.__name"), F.col("__before.__at")), F.lit(" meets "), tag(F.col("__name"), F.col("__at"), "/")))
        .when((own > 0) & F.col("__after").isNull(), F.concat(tag(F.col("__name"), F.col("__at")), F.lit(" is not closed")))
    )
    found = F.when(problem.isNotNull(), F.struct((own > 0).alias("open"), F.col("__n").alias("n"), problem.alias("problem")))
    errors = F.transform(F.array_sort(F.collect_list(found)), lambda e: e["problem"])
    return met.groupBy(key).agg(F.count(problem).alias("n_errors"), errors.alias("errors"))


def message_errors(messages: DataFrame, mode: str = "full", strict: bool = True, text_col: str = "content", role_col: str = "role") -> DataFrame:
    """``messages`` plus ``errors``; only assistants' texts that hold an opener of the mode go through the parser."""
    risky = F.coalesce((F.col(role_col) == "assistant") & F.col(text_col).rlike("<(" + "|".join(TAGS[mode]) + ")>"), F.lit(False))
    clean = messages.filter(~risky).withColumn("errors", F.expr("cast(array() as array<string>)"))
    return clean.unionByName(messages.filter(risky).withColumn("errors", error_finder(mode, strict)(F.col(text_col))))


def record_checker(mode: str = "full", strict: bool = True, most: int = 2):
    """Arrow-batched UDF from a record's messages (array<struct<role,content>>) to its errors, at most ``most`` a message, each with the message's number."""

    @F.pandas_udf("array<string>")
    def check(records: pd.Series) -> pd.Series:
        def one(messages) -> list[str]:
            said = [(i, m["content"]) for i, m in enumerate(messages if messages is not None else []) if m is not None and m["role"] == "assistant" and m["content"]]
            return [f"Msg{i}: {e}" for i, text in said if "<" in text for e in xmlcalls.message_errors(text, mode, strict)[:most]]

        return pd.Series([one(r) for r in records], dtype=object)

    return check


def filter_valid(records: DataFrame, line_col: str = "line", mode: str = "full", strict: bool = True) -> DataFrame:
    """JSON records (one a line) plus ``valid`` and ``errors`` (two a message, with the message's number).

    Lines that aren't JSON, and records without a list of messages, are invalid.
    A record is read and checked in its own row: one scan, no join, no shuffle.
    """
    doc = F.try_parse_json(line_col)
    listed = F.coalesce(F.schema_of_variant(F.try_variant_get(doc, "$.messages", "variant")).startswith("ARRAY"), F.lit(False))
    messages = F.from_json(F.get_json_object(line_col, "$.messages"), "array<struct<role:string,content:string>>")
    read = records.withColumn("__listed", listed).withColumn("__errors", record_checker(mode, strict)(messages))
    errors = F.when(~F.col("__listed"), F.array(F.lit("no list of messages"))).otherwise(F.col("__errors"))
    return read.withColumn("errors", errors).withColumn("valid", F.size("errors") == 0).drop("__listed", "__errors")


def filter_statistics(checked: DataFrame) -> DataFrame:
    return checked.agg(F.count(F.lit(1)).alias("total"), F.count_if("valid").alias("valid"), F.count_if(~F.col("valid")).alias("invalid"))
