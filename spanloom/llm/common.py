"""Helpers shared by the training-data operators.

Conventions that every operator here keeps:

* Inputs are selected by column name; every other input column is ignored or
  carried through untouched.  An input column whose name equals an output
  column is replaced by the output.
* A null text counts as empty unless the operator says otherwise.
* An empty table gives an empty result with the full schema.
* Tables that are read more than once are written to the shared folder of
  ``spark.checkpoint.dir`` (see :func:`materialize`): a lost executor then costs
  a re-read, never a recomputation, and no executor-local copy is needed.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows turned into Python objects at a time; bounds the worker's memory when texts are long.
SLICE_ROWS = 256
#: A slice is cut further so that its texts hold about this many bytes.
SLICE_BYTES = 8 << 20


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir`` where the session has it.

    Only where neither that nor a checkpoint directory is set, and driver and
    executors are one process (local tests), is a temporary folder made.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="spanloom-")
        spark.sparkContext.setCheckpointDir(found)
        found = spark.sparkContext.getCheckpointDir()
    return found


def _path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _path(spark, path)
    fs.delete(p, True)


def materialize(df: DataFrame, what: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back: lineage ends there."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/spanloom/{what}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    atexit.register(_quietly_remove, spark, path)
    out = spark.read.schema(df.schema).parquet(path)
    out._spanloom_path = path
    return out


def release(df: DataFrame) -> None:
    """Delete a materialised table that no later plan reads."""
    remove(df.sparkSession, df._spanloom_path)


def _quietly_remove(spark: SparkSession, path: str) -> None:
    try:
        if spark.sparkContext._jsc is not None:
            remove(spark, path)
    except Exception:  # the session is gone; nothing depends on this folder any more
        pass


def fold_of(id_col: str) -> Column:
    """``crc32`` of the id as text, modulo 3; fold 1 is held out.  A null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), F.lit(3))


def held_out(id_col: str) -> Column:
    return fold_of(id_col) == 1


def unit_hash(*cols: str | Column) -> Column:
    """A number in [0, 1) that depends on the columns only; used to draw bounded samples."""
    return F.pmod(F.xxhash64(*cols), F.lit(1 << 40)) / F.lit(float(1 << 40))


def slices(texts: pa.ChunkedArray | pa.Array) -> Iterator[list[str]]:
    """Texts as Python strings, a bounded slice at a time; null becomes empty."""
    size = max(1, texts.nbytes // max(1, len(texts)))
    step = max(1, min(SLICE_ROWS, SLICE_BYTES // size))
    for at in range(0, len(texts), step):
        yield [x or "" for x in texts.slice(at, step).to_pylist()]


def append_columns(df: DataFrame, text_col: str, fields: list[tuple[str, str]], make: Callable[[], Callable[[list[str]], Iterable[list]]], nulls: bool = False) -> DataFrame:
    """``df`` with the columns ``fields`` (name, DDL type) computed from ``text_col`` batch by batch.

    ``make()`` runs once in each worker and returns the function from a list of
    texts to a list of columns.  Other columns pass as Arrow data, unread.
    With ``nulls``, nulls reach the function as None.
    """
    names = [n for n, _ in fields]
    kept = [c for c in df.columns if c not in names]
    added = T.StructType([T.StructField(n, T._parse_datatype_string(t)) for n, t in fields])
    schema = T.StructType([df.schema[c] for c in kept] + added.fields)
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = [to_arrow_schema(T.StructType([f])).field(0).type for f in added.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = make()
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text_col))
            step = max(1, min(SLICE_ROWS, SLICE_BYTES // max(1, texts.nbytes // max(1, len(texts)))))
            for at in range(0, len(batch), step):
                part = batch.slice(at, step)
                values = texts.slice(at, step).to_pylist()
                columns = fn(values if nulls else [x or "" for x in values])
                yield pa.RecordBatch.from_arrays(
                    [part.column(part.schema.get_field_index(c)) for c in kept] + [pa.array(v, type=t) for v, t in zip(columns, arrow, strict=True)], names=kept + names
                )

    # text_col must reach the worker even when an output replaces it
    return df.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*kept, text_col])]).mapInArrow(run, schema)
