"""Removal of repeated line runs, by distributed prefix doubling over line ids.

Every document is a sequence of line ids.  Level 0 ranks single lines, level k
ranks blocks of 2^k consecutive lines: the rank of a block is that of the pair
of ranks of its halves, so a level's ranks are a suffix array's (the inverse
one), compared to a depth of 2^k lines.  Two suffixes share their first d lines
- lie in one longest-common-prefix interval of depth d - exactly if the two
overlapping 2^k blocks that cover those d lines have equal ranks.

A run of lines is repeated if an earlier place (smaller id, then smaller line
number) has the same lines and the run holds ``min_words`` words.  Every such
run is a union of minimal windows (the shortest that start, or that end, at
one of its lines and hold ``min_words`` words), so windows need no greater depth
than ``min_words`` lines, and the number of levels is bounded.  Blocks that occur
once are dropped at each level: their longer blocks can't repeat either.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import append_columns, materialize, release

#: A row is known by whether it has an id, its id and a hash of its text; none of them is null, so that joins keep every row.
KEY = ["__known", "__id", "__h"]


def _key(docs: DataFrame, id_col: str, text_col: str) -> list[Column]:
    ident = F.col(f"`{id_col}`")
    instead = F.lit("0").try_cast(docs.schema[id_col].dataType.simpleString())
    return [ident.isNotNull().alias("__known"), F.coalesce(ident, instead).alias("__id"), F.xxhash64(f"`{text_col}`").alias("__h")]


def _ranked(pairs: DataFrame, keys: list[str]) -> DataFrame:
    """Repeated key tuples with an order-preserving number: sorted by range, then numbered by place."""
    repeated = pairs.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(*keys)
    ordered = repeated.repartitionByRange(*keys).sortWithinPartitions(*keys)
    return ordered.withColumn("rank", F.monotonically_increasing_id())


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = 50) -> DataFrame:
    """(:data:`KEY`, spans): per document the parts (pos, len, in lines that have a word) of minimal windows that lie outside of their earliest copy."""
    # each line's 128-bit digest stands for its text
    keyed = docs.select(*_key(docs, id_col, text_col), F.col(f"`{text_col}`").alias("t"))

    def make():
        import xxhash

        def run(texts: list[str]) -> list[list]:
            out = []
            for t in texts:
                lines = [w for w in t.encode("utf-8", "surrogatepass").split(b"\n") if w.strip()]
                out.append([{"line": xxhash.xxh3_128_digest(w), "words": len(w.split())} for w in lines])
            return [out]

        return run

    seqs = append_columns(keyed, "t", [("lines", "array<struct<line:binary,words:int>>")], make).drop("t")
    places = materialize(seqs.select(*KEY, F.posexplode("lines").alias("pos", "x")).select(*KEY, "pos", "x.line", "x.words"), "lines")
    names = materialize(_ranked(places.select("line"), ["line"]), "names")
    seq = materialize(places.join(names, "line").select(*KEY, "pos", "words", "rank").distinct(), "level0")
    release(places)
    release(names)
    windows = materialize(_windows(seq, min_words), "windows")
    deepest = windows.agg(F.max("len")).first()[0] or 0
    levels = [seq.select(*KEY, "pos", F.lit(0).alias("k"), "rank")]
    level = seq.select(*KEY, "pos", "rank")
    for k in range(1, max(1, deepest).bit_length()):
        half = 1 << (k - 1)
        # the second half's rank stands at pos + half: one keyed join, whatever is missing between
        pairs = materialize(level.withColumnRenamed("rank", "a").join(level.select(*KEY, (F.col("pos") - half).alias("pos"), F.col("rank").alias("b")), [*KEY, "pos"]), f"pairs{k}")
        names = materialize(_ranked(pairs.select("a", "b"), ["a", "b"]), f"names{k}")
        level = materialize(pairs.join(names, ["a", "b"]).select(*KEY, "pos", "rank"), f"level{k}")
        release(pairs)
        release(names)
        levels.append(level.select(*KEY, "pos", F.lit(k).alias("k"), "rank"))
    table = levels[0]
    for x in levels[1:]:
        table = table.unionByName(x)
    k_of = F.lit(0)
    for k in range(1, max(1, deepest).bit_length()):
        k_of = F.when(F.col("len") >= (1 << k), F.lit(k)).otherwise(k_of)
    wanted = windows.withColumn("k", k_of).withColumn("end", F.expr("cast(pos + len - shiftleft(1, k) as int)"))
    first = table.withColumnRenamed("rank", "a")
    second = table.select(*KEY, F.col("pos").alias("end"), "k", F.col("rank").alias("b"))
    interval = ["len", "a", "b"]
    named = materialize(wanted.join(first, [*KEY, "pos", "k"]).join(second, [*KEY, "end", "k"]).select(*KEY, "pos", *interval), "intervals")
    # written before it is joined: the join is then between plain shuffles, whose hot partitions Spark splits
    earliest = materialize(named.groupBy(*interval).agg(F.min(F.struct(*KEY, "pos")).alias("first")), "earliest")
    later = named.join(earliest, interval).filter(~F.struct(*KEY, "pos").eqNullSafe(F.col("first")))
    # a copy that overlaps the earliest one loses only what lies beyond it
    inside = F.struct(*KEY).eqNullSafe(F.struct(*[F.col(f"first.{k}") for k in KEY]))
    begin = F.when(inside, F.greatest("pos", F.col("first.pos") + F.col("len"))).otherwise(F.col("pos")).cast("int")
    return later.groupBy(*KEY).agg(F.collect_set(F.struct(begin.alias("pos"), (F.col("pos") + F.col("len") - begin).cast("int").alias("len"))).alias("spans"))


def _windows(seq: DataFrame, min_words: int) -> DataFrame:
    """The distinct minimal windows of ``min_words`` words that start or end at a line, within stretches of repeated lines."""
    by_doc = W.partitionBy(*KEY).orderBy("pos")
    stretch = seq.withColumn("g", F.col("pos") - F.row_number().over(by_doc))
    total = stretch.groupBy(*KEY, "g").agg(F.sort_array(F.collect_list(F.struct("pos", "words"))).alias("xs"))

    def cut(batches):
        for batch in batches:
            ids, out = [], ([], [])
            for row, xs in enumerate(batch.column(batch.schema.get_field_index("xs")).to_pylist()):
                found, start, held = set(), 0, 0
                words, base = [x["words"] for x in xs], xs[0]["pos"]
                for end, w in enumerate(words):  # shortest window that ends here
                    held += w
                    while held - words[start] >= min_words:
                        held -= words[start]
                        start += 1
                    if held >= min_words:
                        found.add((base + start, end - start + 1))
                end, held = 0, 0
                for start, w in enumerate(words):  # shortest window that starts here
                    while end < len(words) and held < min_words:
                        held += words[end]
                        end += 1
                    if held < min_words:
                        break
                    found.add((base + start, end - start))
                    held -= w
                ids += [row] * len(found)
                for p, n in sorted(found):
                    out[0].append(p)
                    out[1].append(n)
            take = pa.array(ids, pa.int64())
            yield pa.RecordBatch.from_arrays([*[batch.column(batch.schema.get_field_index(c)).take(take) for c in KEY], pa.array(out[0], pa.int32()), pa.array(out[1], pa.int32())], names=[*KEY, "pos", "len"])

    kind = seq.schema["__id"].dataType.simpleString()
    return total.select(*KEY, "xs").mapInArrow(cut, f"__known boolean, __id {kind}, __h bigint, pos int, len int")


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = 50, count_col: str | None = None) -> DataFrame:
    """``docs`` with every later copy of a repeated line run cut from the text; adds ``lines_removed``.

    A run of at least ``min_words`` words is cut wherever an earlier copy (smaller
    id, then line) is; a copy that overlaps the earliest one, as in a line repeated
    many times, is cut only beyond it.  Every line that is cut has an equal one at an
    earlier place that stays.  Lines without a word
    take no part: runs continue across them and they stay where they are.
    ``count_col`` (if given) is set to the new text's length.

    Null and empty texts stay as they are (0 lines removed).  Rows whose id and
    text are both equal count as one document and all keep the same text; null
    ids come first in the order.  A text that repeats another as a whole is left empty.  All
    input columns are kept.
    """
    names = [c for c in docs.columns if c != "lines_removed"]
    found = "__spans"
    while found in names:
        found += "_"
    spans = repeated_spans(docs, id_col, text_col, min_words)
    own = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), *_key(docs, id_col, text_col))
    joined = own.join(spans, KEY, "left")
    return _cut(joined.select("row.*", F.col("spans").alias(found)), names, found, text_col, count_col)


def _cut(joined: DataFrame, names: list[str], found_col: str, text_col: str, count_col: str | None) -> DataFrame:
    from pyspark.sql import types as T

    schema = T.StructType([*[joined.schema[c] for c in names], T.StructField("lines_removed", T.IntegerType())])

    def run(batches):
        for batch in batches:
            spans = batch.column(batch.schema.get_field_index(found_col))
            texts = batch.column(batch.schema.get_field_index(text_col))
            out, removed, lengths = [], [], []
            for i in range(len(batch)):
                t, found = texts[i].as_py(), spans[i].as_py()
                gone = 0
                if t is not None and found:
                    drop, kept, at = set(), [], 0
                    for x in found:
                        drop.update(range(x["pos"], x["pos"] + x["len"]))
                    for line in t.split("\n"):
                        if line.strip(" \t\n\x0b\x0c\r"):
                            if at not in drop:
                                kept.append(line)
                            at += 1
                        else:
                            kept.append(line)
                    t, gone = "\n".join(kept), len(drop)
                out.append(t)
                removed.append(gone)
                lengths.append(None if t is None else len(t))
            columns = {c: batch.column(batch.schema.get_field_index(c)) for c in names}
            columns[text_col] = pa.array(out, type=texts.type)
            if count_col:
                columns[count_col] = pa.array(lengths, type=columns[count_col].type)
            yield pa.RecordBatch.from_arrays([*columns.values(), pa.array(removed, pa.int32())], names=[*names, "lines_removed"])

    return joined.mapInArrow(run, schema)
