"""Exact duplicates by progressive refinement, with DataFrame functions only.

Lengths are grouped first, then hashes of a prefix within a shared length, then
hashes of the whole content.  Only rows whose length and prefix hash both occur
again reach the last step, and only for them the whole content is read again
and hashed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize


def normalised(text: Column) -> Column:
    """Each run of white space (ASCII) as one space; null as empty.  Only runs that aren't one space already are replaced."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+", " ")


def content_hash(text: Column) -> Column:
    """SHA-256 of the normalised text in UTF-8, as lowercase hex."""
    return F.sha2(normalised(text), 256)


def _key(df: DataFrame, id_col: str, text_col: str) -> list[Column]:
    """A row is known by its id and a hash of its text: rows may share an id."""
    return [F.col(f"`{id_col}`").alias("__id"), F.xxhash64(f"`{text_col}`").alias("__k")]


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prefix: int = 64) -> DataFrame:
    """(__id, __k, times, keep_id, keep_k, group_size): the rows whose text occurs more than once, each id and text once.

    Texts are equal when :func:`normalised` makes them identical; equality is
    that of length, of a 64-bit prefix hash and of SHA-256.  ``keep_id`` and
    ``keep_k`` name the row that stays: the smallest id (null only if all ids are
    null), then the smallest hash of the raw text.  ``group_size`` is the number
    of the group's rows, repeated rows included, ``times`` the number of rows
    that are this one.  Null equals empty.
    """
    seen = docs.select(*_key(docs, id_col, text_col), normalised(F.col(f"`{text_col}`")).alias("t"))
    marks = materialize(seen.select("__id", "__k", F.length("t").alias("n"), F.xxhash64(F.substring("t", 1, prefix)).alias("p")), "marks")
    lengths = marks.groupBy("n").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("n")
    # tables of keys are written before they are joined: both sides are then plain shuffles, whose hot partitions Spark splits
    heads = materialize(marks.groupBy("n", "p").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").join(lengths, "n", "left_semi").select("n", "p"), "heads")
    survivors = marks.join(heads, ["n", "p"]).select(F.col("__id").alias("__sid"), F.col("__k").alias("__sk")).distinct()
    content = docs.select(*_key(docs, id_col, text_col), F.col(f"`{text_col}`").alias("t"))
    on = F.col("__id").eqNullSafe(F.col("__sid")) & (F.col("__k") == F.col("__sk"))
    hashed = materialize(content.join(survivors, on, "left_semi").select("__id", "__k", F.unhex(content_hash(F.col("t"))).alias("h")), "hashes")
    keep = F.min(F.struct(F.col("__id").isNull().alias("none"), F.col("__id").alias("id"), F.col("__k").alias("k"))).alias("keep")
    groups = materialize(hashed.groupBy("h").agg(keep, F.count(F.lit(1)).alias("group_size")).filter("group_size > 1"), "groups")
    rows = hashed.groupBy("__id", "__k", "h").agg(F.count(F.lit(1)).alias("times"))
    return rows.join(groups, "h").select("__id", "__k", "times", F.col("keep.id").alias("keep_id"), F.col("keep.k").alias("keep_k"), "group_size")


def _found(docs: DataFrame, id_col: str, text_col: str, prefix: int) -> tuple[DataFrame, bool]:
    """:func:`exact_groups` under names of its own, plus ``__stays``; and whether a row that stays occurs more than once."""
    found = exact_groups(docs, id_col, text_col, prefix).select(
        F.col("__id").alias("__gid"), F.col("__k").alias("__gk"), F.col("keep_id").alias("__keep"), F.col("group_size").alias("__size"), F.col("times").alias("__times"),
        (F.col("__id").eqNullSafe(F.col("keep_id")) & (F.col("__k") == F.col("keep_k"))).alias("__stays"),
    )
    found = materialize(found, "exact")
    return found, not found.filter("__stays and __times > 1").isEmpty()


def exact_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prefix: int = 64) -> DataFrame:
    """One row per input row, dropped ones too: the id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    ``kept`` is true for exactly one row of each group: the one with the smallest
    id, of several texts under that id the one with the smallest hash, of rows
    that are equal in id and text any one.
    """
    found, again = _found(docs, id_col, text_col, prefix)
    rows = docs.select(*_key(docs, id_col, text_col), content_hash(F.col(f"`{text_col}`")).alias("text_sha256"))
    joined = rows.join(found, F.col("__id").eqNullSafe(F.col("__gid")) & (F.col("__k") == F.col("__gk")), "left")
    keep, one = F.when(F.col("__size").isNull(), F.col("__id")).otherwise(F.col("__keep")), F.lit(1).cast("long")
    stays = F.coalesce("__stays", F.lit(True))
    out = joined.select(F.col("__id").alias(id_col), keep.alias("keep_id"), F.coalesce("__size", one).alias("group_size"), stays.alias("kept"), "text_sha256", "__k", F.coalesce("__times", one).alias("times"))
    names = [F.col(f"`{c}`") for c in (id_col, "keep_id", "group_size", "kept", "text_sha256")]
    if not again:
        return out.select(*names)
    # rows equal in id and text get numbers, which are written, and the smallest stays
    out = materialize(out.withColumn("__row", F.monotonically_increasing_id()), "report")
    same = out.filter("kept and times > 1")
    least = same.groupBy(F.col(f"`{id_col}`"), "__k").agg(F.min("__row").alias("__row")).select("__row", F.lit(True).alias("__least"))
    one_of = same.join(least, "__row", "left").withColumn("kept", F.coalesce("__least", F.lit(False))).select(*names)
    return out.filter("not (kept and times > 1)").select(*names).unionByName(one_of)


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prefix: int = 64) -> DataFrame:
    """``docs`` with one row of each group of equal texts, as :func:`exact_report` says; all columns are kept.

    Null ids count as larger than any other id: such a row goes if its text has a
    row with an id.  Of rows equal in id and text any one stays, whatever its other
    columns are.
    """
    found, again = _found(docs, id_col, text_col, prefix)
    on = docs[f"`{id_col}`"].eqNullSafe(found["__gid"]) & (F.xxhash64(docs[f"`{text_col}`"]) == found["__gk"])
    names = [F.col(f"`{c}`") for c in docs.columns]
    if not again:
        return docs.join(found.filter("not __stays"), on, "left_anti").select(*names)
    single = docs.join(found.filter("not (__stays and __times = 1)"), on, "left_anti").select(*names)
    several = docs.join(found.filter("__stays and __times > 1"), on).groupBy("__gid", "__gk").agg(F.first(F.struct(*names)).alias("__row"))
    return single.unionByName(several.select("__row.*"))
