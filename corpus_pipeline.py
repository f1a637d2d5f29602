"""The training-corpus pipeline: language ID, line dedup, near-dedup, decontamination, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows that its predecessor
kept; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom.llm.common import held_out, load, shared_dir
from spanloom.llm.decontaminate import decontaminate
from spanloom.llm.language_id import fit_language_model, identify_language
from spanloom.llm.line_dedup import dedup_lines
from spanloom.llm.packing import pack_documents
from spanloom.llm.queries import CAPACITY, tokenizer_path
from spanloom.llm.simhash import keep_one_per_component

#: Similarity of near copies, and the fingerprints that find the pairs to compare.
#: A pair of shingle sets with Jaccard similarity 0.8 differs in 0.1515 of the bits
#: on average, 39 of 256 (standard deviation 5.7), and in 48 (6.2) for the smallest
#: sets that can have it, 4 and 5 shingles; the radius is 3.8 deviations above the
#: latter and 5.7 above the former.  Every candidate is decided by its two sets.
SIMILARITY = 0.8
#: What a worker of the packing stage remembers: less than in packing alone, as it shares the executor with the other stages' workers.
CACHE = 100_000
SIMHASH_WORDS, SIMHASH_RADIUS, SHINGLE = 4, 72, 5
#: Bytes of rows that go to a Python worker at a time.  Spark's 64 MB hold a whole partition of texts, several times over on both sides,
#: and what workers and native buffers have once held stays with the executor through all later stages.
BATCH, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 4 << 20


def in_small_batches(stage: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """The stage, in a session with small Arrow batches; a bound that the session has already stays.

    Spark reads the bound when the stage's result is computed, which is after the
    stage returned it, so the session keeps it.  It changes no result.
    """

    @functools.wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        if spark.conf.get(BATCH, None) is None:
            spark.conf.set(BATCH, BATCH_BYTES)
        return stage(spark, docs, sf_dir)

    return run


def _with_row(docs: DataFrame, step: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``step`` over id, text and length, then the columns of ``docs`` in their order.

    The other columns go through the operator in a struct, so that no column it
    adds can take the place of one that the table has.
    """
    worked = ("doc_id", "text", "n_chars")
    others = [F.col(f"`{c}`") for c in docs.columns if c not in worked] or [F.lit(0).alias("none")]
    made = step(docs.select(*worked, F.struct(*others).alias("__row")))
    return made.select(*[F.col(c) if c in worked else F.col("__row")[c].alias(c) for c in docs.columns])


@in_small_batches
def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language; those that the identifier rejects go.

    Texts that are null or have no letter go.  Each row is judged for itself, by its whole
    text, so repeated rows share their fate; an empty table stays empty.
    """
    model = fit_language_model(docs.filter(~held_out("doc_id")))
    return _with_row(docs, lambda rows: identify_language(rows, model).filter("lang_accepted"))


@in_small_batches
def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of line runs of 50 words or more are cut; a document of which nothing is left goes.

    Null and empty texts stay as they are; rows equal in id and text keep equal texts.
    """

    def cut(rows: DataFrame) -> DataFrame:
        return dedup_lines(rows, min_words=50, count_col="n_chars").filter("lines_removed = 0 or text rlike '[^\\\\x20\\\\x09-\\\\x0D]'")

    return _with_row(docs, cut)


@in_small_batches
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five-word shingles, similarity 0.8) the document with the smallest id stays.

    Of repeated rows one stays.  See the operator for texts without words.
    """
    return keep_one_per_component(docs, similarity=SIMILARITY, radius=SIMHASH_RADIUS, shingle=SHINGLE, words=SIMHASH_WORDS)


@in_small_batches
def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated documents go; from the others the benchmark's windows are cut.

    Null and empty texts have no windows and stay; repeated rows share their fate.
    """
    return decontaminate(docs, load(spark, sf_dir, "benchmark"), remove="both", count_col="n_chars")


@in_small_batches
def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' tokens in full sequences; a null text is an empty one, of one closing token."""
    return pack_documents(docs, tokenizer_path(), capacity=CAPACITY, cache=CACHE)


STAGES = [("language ID", language), ("line dedup", lines), ("SimHash near-dedup", near_duplicates), ("benchmark decontamination", benchmark), ("best-fit packing", packing)]

#: Language ID, SimHash and tokenisation have no SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read again."""
    docs, base = load(spark, sf_dir, "documents"), f"{shared_dir(spark).rstrip('/')}/spanloom/pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES[:-1]):
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{k}")
        docs = spark.read.parquet(f"{base}/{k}")
    return STAGES[-1][1](spark, docs, sf_dir)


