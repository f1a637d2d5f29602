"""Best-fit packing by minimum bin slack.

Documents are tokenised where they are read.  The bins depend on the lengths
only, of which there are at most ``capacity``: their histogram (one count per
length) is all that the driver sees.  For each bin the largest length left
is taken and a bitset subset-sum over the available lengths finds the
combination that fills the rest most; that pattern is applied to as many bins as
the counts allow, and its lengths are removed.  Pieces then find their place by
their number within their length, with joins only.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import materialize

END = b"\0\0\0\0"
#: Rows encoded at a time, in slices of about this many bytes; the larger a slice, the fewer chunks that Python looks up, and the more memory.
ROWS, BYTES = 512, 1 << 20
#: Chunks whose ids are put in place at a time; bounds the index arrays when a text is long.
GATHER = 1 << 14


# The byte-level tokenizer's pattern of pre-tokens and its printable stand-ins for the 256 bytes.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]


def byte_letters() -> dict[int, str]:
    """Byte -> the letter that stands for it: itself if printable, else the next letter from 256 on."""
    others = iter(range(256, 512))
    return {b: chr(b if b in PRINTABLE else next(others)) for b in range(256)}


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit bytes, through two bounded caches.

    The pre-tokeniser never joins a space with what precedes it, so a text whose
    only white space is single spaces and line feeds can be encoded chunk by
    chunk (a chunk starts at the text's start or at a space, which belongs to it); any other text, and one that holds
    an added token, is encoded as a whole.  Chunks are told apart in Arrow, so Python sees each distinct one of a call once.
    A chunk that the first cache lacks is cut into pre-tokens; one that
    the second lacks goes through the tokenizer's own merge model.
    """

    def __init__(self, path: str, most: int = 400_000, most_words: int = 400_000):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.letters = byte_letters()
        self.chunks: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}
        self.most, self.most_words = most, most_words
        # other white space than single spaces and line feeds; a scan for each is far cheaper than a pattern
        # and an added token, which stands for one id wherever it occurs
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.odd = ("  ", *added, *(c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n"))
        self.pre_tokens = regex.compile(PRE_TOKEN).findall

    def _word(self, word: str) -> bytes:
        found = self.words.get(word)
        if found is None:
            if word.isascii() and word.isprintable():  # only the space has a stand-in
                spelled = word.replace(" ", self.letters[32])
            else:
                spelled = word.encode("utf-8").decode("latin-1").translate(self.letters)
            found = b"".join([t.id.to_bytes(4, "little") for t in self.model.tokenize(spelled)])
            if len(self.words) < self.most_words:
                self.words[word] = found
        return found

    def _chunk(self, chunk: str) -> bytes:
        """A chunk with the space before it, if it has one."""
        bare = chunk.removeprefix(" ")
        if bare.isalpha():
            found = self._word(chunk)
        elif bare[-1:] in (".", ",", "!", ";") and bare[:-1].isalpha():
            found = self._word(chunk[:-1]) + self._word(chunk[-1])
        else:
            found = b"".join(map(self._word, self.pre_tokens(chunk)))
        if len(self.chunks) < self.most:
            self.chunks[chunk] = found
        return found

    def _texts(self, texts: list[str]) -> list[bytes]:
        """Texts without odd white space or added tokens."""
        whole = pa.array(texts, pa.large_string())
        _, offsets, data = whole.buffers()
        ends = np.frombuffer(offsets, np.int64, len(texts) + 1)
        if not ends[-1]:
            return [b""] * len(texts)
        starts = np.frombuffer(data, np.uint8, ends[-1]) == ord(" ")
        starts[ends[:-1][ends[:-1] < ends[-1]]] = True
        at = np.append(np.flatnonzero(starts), ends[-1])
        del starts
        coded = pa.LargeStringArray.from_buffers(len(at) - 1, pa.py_buffer(at), data).dictionary_encode()
        which = coded.indices.to_numpy()
        get, make = self.chunks.get, self._chunk
        # through numpy, as `to_pylist` makes a scalar of each first
        found = [make(c) if (x := get(c)) is None else x for c in coded.dictionary.to_numpy(zero_copy_only=False)]
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        ids, first = np.frombuffer(b"".join(found), "<u4"), np.cumsum(sizes) - sizes
        # a text's ids end where those of its last chunk end
        upto = np.concatenate([[0], np.cumsum(sizes[which])])
        cuts = upto[np.searchsorted(at[:-1], ends)]
        out = np.empty(upto[-1], "<u4")
        for lo in range(0, len(which), GATHER):
            w = which[lo : lo + GATHER]
            a, b = upto[lo], upto[lo + len(w)]
            out[a:b] = ids[np.repeat(first[w] - upto[lo : lo + len(w)], sizes[w]) + np.arange(a, b)]
        return [out[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]

    def encode(self, texts: list[str]) -> list[bytes]:
        odd = [any(w in text for w in self.odd) for text in texts]
        plain = iter(self._texts([t for t, o in zip(texts, odd, strict=True) if not o]))
        return [np.array(self.tokenizer.encode(t, add_special_tokens=False).ids, dtype="<u4").tobytes() if o else next(plain) for t, o in zip(texts, odd, strict=True)]


def pieces_of(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: whole if it fits, else full pieces after a first that may be shorter."""
    if n <= capacity:
        return [(0, n)]
    head = n % capacity or capacity
    return [(0, head), *[(s, capacity) for s in range(head, n, capacity)]]


def fullest(counts: dict[int, int], room: int) -> list[int]:
    """Lengths from ``counts`` whose sum is the largest that is at most ``room`` (bitset subset-sum; larger lengths first)."""
    reach, steps, full = 1, [], (1 << (room + 1)) - 1
    for length in sorted(counts, reverse=True):
        if length > room:
            continue
        most, k = min(counts[length], room // length), 1
        while most > 0:  # multiplicities as powers of two
            take = min(k, most)
            steps.append((length, take, reach))
            reach |= (reach << (length * take)) & full
            most -= take
            k <<= 1
        if reach >> room & 1:
            break
    best, out = reach.bit_length() - 1, []
    for length, take, before in reversed(steps):
        if not before >> best & 1:
            out += [length] * take
            best -= length * take
    return out


def plan_bins(histogram: dict[int, int], capacity: int) -> list[tuple[list[int], int]]:
    """(lengths of a bin, number of such bins): minimum bin slack over a histogram of lengths."""
    left, plan = {k: n for k, n in histogram.items() if n > 0 and k > 0}, []
    while left:
        top = max(left)
        left[top] -= 1
        rest = {k: n for k, n in left.items() if n > 0}
        bin_ = [top, *fullest(rest, capacity - top)]
        left[top] += 1
        uses = {k: bin_.count(k) for k in set(bin_)}
        times = min(left[k] // u for k, u in uses.items())
        for k, u in uses.items():
            left[k] -= u * times
            if not left[k]:
                del left[k]
        plan.append((bin_, times))
    return plan


def slots_of(plan: list[tuple[list[int], int]]) -> list[tuple]:
    """(length, first, last, uses, bin, offset): pieces first..last-1 of a length fill ``uses`` places of each bin from ``bin`` on."""
    used: dict[int, int] = {}
    out, bins = [], 0
    for lengths, times in plan:
        offset = 0
        for k in sorted(set(lengths), reverse=True):
            u = lengths.count(k)
            at = used.get(k, 0)
            out.append((k, at, at + u * times, u, bins, offset))
            used[k] = at + u * times
            offset += k * u
        bins += times
    return out


def tokenised_pieces(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = 2048, cache: int = 400_000) -> DataFrame:
    """(__id, piece, start, length, ids_crc32, part, nth): nth is the place among the pieces of that length in that part."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, encoder, seen = TaskContext.get().partitionId(), Encoder(tokenizer_path, cache, cache), [0] * (capacity + 1)
        for batch in batches:
            texts = batch.column(1)
            step = max(1, min(ROWS, BYTES // max(1, texts.nbytes // max(1, len(texts)))))
            for at in range(0, len(batch), step):
                row, rows = [], []
                for i, ids in enumerate(encoder.encode([x or "" for x in texts.slice(at, step).to_pylist()])):
                    ids += END
                    for piece, (start, length) in enumerate(pieces_of(len(ids) // 4, capacity)):
                        row.append(at + i)
                        rows.append((piece, start, length, zlib.crc32(ids[4 * start : 4 * (start + length)]), part, seen[length]))
                        seen[length] += 1
                cols = list(zip(*rows, strict=True)) if rows else [()] * 6
                types = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row, pa.int64())), *[pa.array(c, t) for c, t in zip(cols, types, strict=True)]], names=["__id", "piece", "start", "length", "ids_crc32", "part", "nth"])

    read = docs.select(F.col(f"`{id_col}`").alias("__id"), F.col(f"`{text_col}`").alias("__text"))
    return read.mapInArrow(run, f"__id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, part int, nth bigint")


def pack_documents(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = 2048, cache: int = 400_000) -> DataFrame:
    """One row per piece: the id, ``piece``, ``start``, ``length``, ``ids_crc32``, ``sequence_id``, ``offset``.

    A document is its token ids and a final 0.  Longer ones than ``capacity`` are
    cut into full pieces, of which only the first may be shorter.  Places in a
    sequence are gapless from 0.  Null and empty texts are the one id 0.
    Repeated rows and null ids are packed like any other; an empty table gives
    no rows.  Other input columns are not read.  ``cache``: how many chunks and
    words each worker remembers; it changes no result.
    """
    spark = docs.sparkSession
    pieces = materialize(tokenised_pieces(docs, tokenizer_path, id_col, text_col, capacity, cache), "pieces")
    parts = materialize(pieces.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n")), "part-lengths")
    histogram = {r["length"]: r["n"] for r in parts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most `capacity` rows
    slots = slots_of(plan_bins(histogram, capacity))
    before = W.partitionBy("length").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    bases = parts.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    table = spark.createDataFrame(slots, "length bigint, first bigint, last bigint, uses bigint, bin bigint, at bigint")
    # per part and length, the slots that its pieces meet: few rows, then one keyed join with the pieces
    spans = parts.join(bases, ["length", "part"]).join(F.broadcast(table), "length").filter("first < base + n and last > base")
    spans = spans.groupBy("length", "part").agg(F.first("base").alias("base"), F.sort_array(F.collect_list(F.struct("first", "last", "uses", "bin", "at"))).alias("slots"))
    placed = pieces.join(spans, ["length", "part"]).withColumn("rank", F.col("base") + F.col("nth"))
    slot = F.element_at(F.filter("slots", lambda s: (F.col("rank") >= s["first"]) & (F.col("rank") < s["last"])), 1)
    placed = placed.withColumn("s", slot).withColumn("k", F.col("rank") - F.col("s.first"))
    return placed.select(
        F.col("__id").alias(id_col), "piece", "start", "length", "ids_crc32",
        F.expr("s.bin + k div s.uses").alias("sequence_id"),
        F.expr("s.at + pmod(k, s.uses) * length").alias("offset"),
    )
