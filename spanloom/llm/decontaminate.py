"""Benchmark decontamination with DataFrame functions only.

The benchmark's normalised word windows, with their hashes, are the small side;
each document's windows are hashed where the document is read; those that pass a
bitmap of the benchmark's hashes are matched against them and verified word by word.  The small side is broadcast only while it has
at most ``max_broadcast`` windows of ``max_bytes`` in all (both are measured
first); above that the hashes are joined by shuffle, without any text, and only
the windows that met are read again and verified.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The same for texts whose letters A-Z have not been lowered.
WORD_CASED = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: A word with what stands before it.
CHUNK = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*" + WORD_CASED
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def words_of(text: Column) -> Column:
    """The words of a text with A-Z lowered; none for null."""
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), _UPPER, _UPPER.lower()), F.lit(WORD), F.lit(0))


def benchmark_windows(benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text", window: int = 13) -> DataFrame:
    """Distinct windows: (hash, n, gram, items).  An item of fewer words than ``window``, but not none, is one window."""
    words = benchmark.select(F.col(f"`{item_col}`").cast("string").alias("item"), words_of(F.col(f"`{text_col}`")).alias("w")).filter(F.size("w") > 0)
    n = F.least(F.size("w"), F.lit(window))
    grams = words.select("item", F.explode(F.transform(F.sequence(F.lit(1), F.size("w") - n + 1), lambda i: F.slice(F.col("w"), i, n))).alias("gram"))
    return grams.groupBy("gram").agg(F.collect_set("item").alias("items")).select(F.xxhash64("gram").alias("hash"), F.size("gram").alias("n"), "gram", "items")


def matches(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", bench_text: str = "text", window: int = 13, max_broadcast: int = 500_000, max_bytes: int = 256 << 20) -> DataFrame:
    """Per row of ``docs``: ``__id``, ``__h`` (hash of the text), ``n_words``, ``n_hit``, ``hits`` (disjoint word ranges [from, to)), ``items``.

    Whole texts are read once.  Null or empty texts have no words and no hits.
    Rows equal in id and text appear as often as they are in the input.
    """
    grams = benchmark_windows(benchmark, item_col, bench_text, window)
    held = F.lit(64) + F.aggregate(F.concat("gram", "items"), F.lit(0).cast("long"), lambda a, x: a + F.octet_length(x) + 24)
    sizes = {r["n"]: (r["c"], r["b"]) for r in grams.groupBy("n").agg(F.count(F.lit(1)).alias("c"), F.sum(held).alias("b")).collect()}  # at most `window` rows
    few = sum(c for c, _ in sizes.values()) <= max_broadcast and sum(b for _, b in sizes.values()) <= max_bytes
    read = docs.select(F.col(f"`{id_col}`").alias("__id"), F.xxhash64(f"`{text_col}`").alias("__h"), F.explode(F.array(words_of(F.col(f"`{text_col}`")))).alias("w"))

    def starts(w: Column) -> Column:
        nothing = F.expr("cast(array() as array<struct<at:int,n:int,hash:bigint>>)")

        def of(n: int) -> Column:
            row = lambda i: F.struct((i - 1).cast("int").alias("at"), F.lit(n).alias("n"), F.xxhash64(F.slice(w, i, n)).alias("hash"))
            return F.when(F.size(w) >= n, F.transform(F.sequence(F.lit(1), F.size(w) - n + 1), row)).otherwise(nothing)

        lead = F.array(F.struct(F.lit(-1).alias("at"), F.size(w).alias("n"), F.lit(None).cast("bigint").alias("hash")))
        return F.concat(lead, *[of(n) for n in sorted(sizes)])

    small = grams.select(F.col("hash").alias("g_hash"), F.col("n").alias("g_n"), "gram", "items")
    on = (F.col("x.hash") == F.col("g_hash")) & (F.col("x.n") == F.col("g_n"))
    if few:
        maybe = _sieve(grams, sum(c for c, _ in sizes.values()))
        w, nothing = F.col("w"), F.expr("cast(array() as array<struct<at:int,n:int,hash:bigint,of:array<string>>>)")

        def likely(n: int) -> Column:
            """The windows of ``n`` words that pass the sieve, with their words: a row carries no more of its document than that."""
            # a hash is a lambda's variable before it is looked up: expressions inside lambdas are computed wherever they stand
            hashes = F.transform(F.sequence(F.lit(1), F.size(w) - n + 1), lambda i: F.xxhash64(F.slice(w, i, n)))
            places = F.filter(F.transform(hashes, lambda h, i: F.when(maybe(h), i)), lambda i: i.isNotNull())
            row = lambda of: F.transform(places, lambda i: F.struct(i.alias("at"), F.lit(n).alias("n"), F.xxhash64(of(i)).alias("hash"), of(i).alias("of")))
            return F.when(F.size(w) >= n, row(lambda i: F.slice(w, i + 1, n))).otherwise(nothing)

        # a first row per document (at -1) carries its number of words through the join
        lead = F.array(F.struct(F.lit(-1).alias("at"), F.size(w).alias("n"), F.lit(None).cast("bigint").alias("hash"), F.lit(None).cast("array<string>").alias("of")))
        placed = read.select("__id", "__h", F.explode(F.concat(lead, *[likely(n) for n in sorted(sizes)])).alias("x"))
        # the words themselves are compared after the join, so that only the hash is its key
        found = placed.join(F.broadcast(small), on, "left").filter((F.col("x.at") == -1) | (F.col("x.of") == F.col("gram")))
    else:
        found = _met_by_shuffle(read, starts, small, on)
    first = F.col("x.at") < 0
    grouped = found.groupBy("__id", "__h").agg(
        F.count(F.when(first, 1)).alias("rows"),
        F.max(F.when(first, F.col("x.n"))).alias("n_words"),
        F.collect_set(F.when(~first, F.struct(F.col("x.at").alias("from"), (F.col("x.at") + F.col("x.n")).alias("to")))).alias("ranges"),
        F.collect_set(F.when(~first, F.col("items"))).alias("item_sets"),
    )
    none = F.expr("cast(array() as array<struct<from:int,to:int>>)")

    def join_up(done: Column, r: Column) -> Column:
        last = F.element_at(done, -1)
        grown = F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(last["from"].alias("from"), F.greatest(last["to"], r["to"]).alias("to"))))
        return F.when((F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["to"] >= r["from"]), grown).otherwise(F.concat(done, F.array(r)))

    out = grouped.select("__id", "__h", "rows", F.col("n_words").cast("long").alias("n_words"), F.aggregate(F.sort_array("ranges"), none, join_up).alias("hits"), F.sort_array(F.array_distinct(F.flatten("item_sets"))).alias("items"))
    hit = F.aggregate("hits", F.lit(0).cast("long"), lambda a, r: a + (r["to"] - r["from"]))
    each = F.explode(F.sequence(F.lit(1), F.col("rows").cast("int")))
    return out.select("__id", "__h", "n_words", hit.alias("n_hit"), "hits", "items", each.alias("__copy")).drop("__copy")


def _sieve(grams: DataFrame, windows: int) -> Callable[[Column], Column]:
    """A test of hashes that all of the benchmark's pass, and one in sixty others: two bits each in a bitmap of 16 bits a window.

    The bitmap is made by Spark and comes to the driver as one number per 64
    bits; its size is bounded as that of the broadcast windows is.
    """
    bits = 1 << max(10, (16 * windows - 1).bit_length())
    places = lambda h: (h.bitwiseAND(F.lit(bits - 1)), F.shiftrightunsigned(h, 32).bitwiseAND(F.lit(bits - 1)))
    each = grams.select(F.explode(F.array(*places(F.col("hash")))).alias("at"))
    cells = each.groupBy(F.shiftright("at", 6).alias("cell")).agg(F.bit_or(F.expr("shiftleft(1L, cast(at & 63 as int))")).alias("bits"))
    found = {r["cell"]: r["bits"] for r in cells.collect()}
    bitmap = F.split(F.lit(",".join(str(found.get(i, 0)) for i in range(bits // 64))), ",").cast("array<bigint>")  # folded to one array when the plan is made
    one = lambda at: F.getbit(F.get(bitmap, F.shiftright(at, 6).cast("int")), at.bitwiseAND(F.lit(63)).cast("int")) == 1

    def maybe(h: Column) -> Column:
        a, b = places(h)
        return one(a) & one(b)

    return maybe


#: Ways into which the places of one window are dealt: a passage of many documents is no hot key.
SALTS = 16


def _met_by_shuffle(read: DataFrame, starts: Callable[[Column], Column], small: DataFrame, on: Column) -> DataFrame:
    """The rows of the broadcast join, made without shuffling a document's words for each of its windows.

    Hashes and places alone meet the benchmark's hashes; per document, the places
    that met go back to its words, and only these windows' words meet the
    benchmark's.  A document's places are bounded by its own length.
    """
    salt = F.pmod(F.xxhash64("__id", "__h", "x.at"), F.lit(SALTS)).cast("int")
    salted = small.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    places = read.select("__id", "__h", F.explode(starts(F.col("w"))).alias("x"))
    keys = salted.select("g_hash", "g_n", "salt").distinct()
    met = places.filter("x.at >= 0").withColumn("salt", salt).join(keys, on & (F.col("x.hash") == F.col("g_hash")) & (salt == keys["salt"]), "left_semi")
    per_row = met.groupBy("__id", "__h").agg(F.collect_set("x").alias("xs")).select(F.col("__id").alias("__mid"), F.col("__h").alias("__mh"), "xs")
    same_row = F.col("__id").eqNullSafe(F.col("__mid")) & (F.col("__h") == F.col("__mh"))
    words = read.dropDuplicates(["__id", "__h"]).join(per_row, same_row).select("__id", "__h", F.explode(F.transform("xs", lambda x: F.struct(x.alias("x"), F.slice("w", x["at"] + 1, x["n"]).alias("of")))).alias("y"))
    words = words.select("__id", "__h", F.col("y.x").alias("x"), F.col("y.of").alias("of")).withColumn("salt", salt)
    hits = words.join(salted, on & (words["salt"] == salted["salt"])).filter(F.col("of") == F.col("gram")).select("__id", "__h", "x", "gram", "items")
    rows = read.select("__id", "__h", F.struct(F.lit(-1).alias("at"), F.size("w").alias("n"), F.lit(None).cast("bigint").alias("hash")).alias("x"))
    return rows.select("*", *[F.lit(None).cast(small.schema[c].dataType).alias(c) for c in ("gram", "items")]).unionByName(hits)


def contaminated(n_hit: str = "n_hit", n_words: str = "n_words", one_in: int = 20) -> Column:
    """At least one word in ``one_in`` stands in a benchmark window."""
    return (F.col(n_hit) > 0) & (F.col(n_hit) * one_in >= F.col(n_words))


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", remove: str = "documents", count_col: str | None = None, one_in: int = 20, **how) -> DataFrame:
    """``docs`` without benchmark passages; all input columns are kept.

    ``remove="documents"`` drops the documents that :func:`contaminated` marks;
    ``"spans"`` cuts every hit word, with what stands before it, from all
    documents; ``"both"`` drops the marked documents and cuts the hits from the
    others.  ``count_col`` (if given) gets the new text's length.  Null and empty texts, and
    an empty benchmark, leave a row as it is; a null id is an id like any other.
    """
    if remove not in ("documents", "spans", "both"):
        raise ValueError(f"remove: {remove}")
    found = matches(docs, benchmark, id_col, text_col, **how).filter("n_hit > 0").withColumn("__bad", contaminated(one_in=one_in))
    found = found.select(F.col("__id").alias("__mid"), F.col("__h").alias("__mh"), "hits", "__bad").dropDuplicates(["__mid", "__mh"])
    on = docs[f"`{id_col}`"].eqNullSafe(found["__mid"]) & (F.xxhash64(docs[f"`{text_col}`"]) == found["__mh"])
    columns = [docs[f"`{c}`"] for c in docs.columns]
    if remove == "documents":
        return docs.join(found.filter("__bad"), on, "left_anti").select(*columns)
    joined = docs.join(found, on, "left")
    if remove == "both":
        joined = joined.filter(found["__bad"].isNull() | ~found["__bad"])
    text = docs[f"`{text_col}`"]
    chunks = F.regexp_extract_all(text, F.lit(CHUNK), F.lit(0))
    clear = lambda i: ~F.exists(found["hits"], lambda r: (i >= r["from"]) & (i < r["to"]))
    tail = F.regexp_extract(text, r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*\z", 0)
    cut = F.when(found["hits"].isNull(), text).otherwise(F.concat(F.array_join(F.filter(chunks, lambda x, i: clear(i)), ""), tail))
    swapped = {text_col: cut}
    if count_col:
        swapped[count_col] = F.length(cut).cast(docs.schema[count_col].dataType)
    return joined.select(*[swapped[c].alias(c) if c in swapped else docs[f"`{c}`"] for c in docs.columns])
