"""Structured Streaming forms of the operators that make sense on a live stream of spans."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..sources.sinks import new_counts
from ..sources.snapshots import Snapshots
from ..storage import shared_folder


def last_per_key(stream: DataFrame, key: str, order: str, kept: list[str]) -> DataFrame:
    """(update mode) of each key the row with the largest ``order`` so far; a struct maximum, combined before the shuffle."""
    return stream.groupBy(key).agg(F.max(F.struct(order, *kept)).alias("__m")).select(key, F.col(f"__m.{order}"), *[F.col(f"__m.{c}") for c in kept])


def without_repeats(stream: DataFrame, keys: list[str], time_col: str, late: str = "10 seconds") -> DataFrame:
    """(append mode) each key once while its watermark allows; state is dropped after it."""
    return stream.withWatermark(time_col, late).dropDuplicatesWithinWatermark(keys)


def windowed_counts(stream: DataFrame, time_col: str, group: str, width: str = "1 hour", late: str = "10 seconds") -> DataFrame:
    """(append mode) rows per window and group, given out once the watermark passes the window."""
    w = F.window(time_col, width)
    return stream.withWatermark(time_col, late).groupBy(w, group).agg(F.count(F.lit(1)).alias("n")).select(F.col("window.start").alias("start"), group, "n")


def counters(stream: DataFrame, *keys: str) -> DataFrame:
    """(update mode) running counts."""
    return stream.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def closed_groups(stream: DataFrame, key: str, time_col: str, value: str, idle_s: int = 10, late: str = "10 seconds") -> DataFrame:
    """(append mode) per key the last value, given out once no row came for ``idle_s`` seconds of event time.

    ``key`` and ``value`` are strings; state per key is one time and one value.
    """

    def step(k: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            at, last, n = state.get
            state.remove()
            yield pd.DataFrame({key: [k[0]], "last_value": [last], "n": [n]})
            return
        at, last, n = state.get if state.exists else (0, None, 0)
        for pdf in batches:
            times = pdf[time_col].astype("int64") // (1_000_000 if pdf[time_col].dtype == "datetime64[ns]" else 1_000)
            best = times.idxmax()
            if int(times[best]) >= at:
                at, last = int(times[best]), pdf[value][best]
            n += len(pdf)
        state.update((at, last, n))
        state.setTimeoutTimestamp(max(at + idle_s * 1000, state.getCurrentWatermarkMs() + 1))
        yield from ()

    marked = stream.withWatermark(time_col, late).select(key, time_col, value)
    return marked.groupBy(key).applyInPandasWithState(step, f"{key} string, last_value string, n bigint", "at bigint, last string, n bigint", "append", GroupStateTimeout.EventTimeTimeout)


def run_available(stream: DataFrame, name: str, mode: str, checkpoint: str | None = None, path: str | None = None) -> DataFrame:
    """All that is there now, as a table of files in the shared folder: no row of it passes the driver.

    Each micro-batch overwrites the folder of its own number, so one that is run
    again after a failure changes nothing.  In append mode the batches' folders
    together are the table, in complete mode the last one is.  With the
    ``checkpoint`` and ``path`` of an earlier run it goes on where that ended.
    """
    spark = stream.sparkSession
    path = path or shared_folder(spark, f"stream-{name}")
    schema = stream.schema.add("__batch", "long")

    def put(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/__batch={number}")

    put(spark.createDataFrame([], stream.schema), -1)
    w = stream.writeStream.foreachBatch(put).queryName(name).outputMode(mode).trigger(availableNow=True)
    w.option("checkpointLocation", checkpoint or shared_folder(spark, "stream-checkpoint")).start().awaitTermination()
    found = spark.read.schema(schema).parquet(path)
    if mode == "complete":
        found = found.filter(F.col("__batch") == found.agg(F.max("__batch")).first()[0])
    return found.drop("__batch")


def run_in_arrivals(parts: list[DataFrame], build: Callable[[DataFrame], DataFrame], name: str, mode: str = "append") -> DataFrame:
    """The stream that ``build`` makes, run once after each part of its input has arrived, always from the same checkpoint.

    Every run reads the files of its own part only, and goes on with the state
    and the watermark that the one before left.
    """
    spark = parts[0].sparkSession
    folder, checkpoint, path = (shared_folder(spark, f"stream-{k}") for k in ("arrivals", "checkpoint", name))
    out = None
    with rocksdb(spark):
        for part in parts:
            part.write.mode("append").parquet(folder)
            out = run_available(build(spark.readStream.schema(part.schema).parquet(folder)), name, mode, checkpoint, path)
    return out


@contextmanager
def rocksdb(spark: SparkSession) -> Iterator[None]:
    """State in RocksDB: it is kept off the heap and on disk, so its size is not that of an executor's memory."""
    key, value = "spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before) if before else spark.conf.unset(key)


class _Generations(StatefulProcessor):
    """Per key the groups that aren't final: first and last time (ms), the last row's value, rows so far; one timer, for the first that ends.

    A row that comes late may still join two groups or stretch one, so a row beyond the
    pause ends nothing by itself: a group is final once the watermark has passed its end.
    """

    def __init__(self, key: str, time_col: str, value: str, idle_ms: int) -> None:
        self.key, self.time_col, self.value, self.idle = key, time_col, value, idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getListState("open", "first bigint, last bigint, value string, n bigint")

    def _merged(self, groups: list[tuple]) -> list[tuple]:
        """Groups by time; those without a pause between them are one."""
        out: list[tuple] = []
        for g in sorted(groups):
            if out and g[0] <= out[-1][1] + self.idle:
                o = out[-1]
                out[-1] = (o[0], *max(o[1:3], g[1:3]), o[3] + g[3])
            else:
                out.append(g)
        return out

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        groups = [tuple(g) for g in self.open.get()]
        timer = groups[0][1] + self.idle if groups else None
        for pdf in rows:
            times = pdf[self.time_col].astype("datetime64[ms]").astype("int64").tolist()
            groups = self._merged(groups + [(ms, ms, value, 1) for ms, value in zip(times, pdf[self.value].tolist(), strict=True)])
        self._keep(groups, timer)
        yield from ()

    def _keep(self, groups: list[tuple], timer: int | None) -> None:
        """The key's groups from now on, and the timer of the first in place of ``timer``."""
        if groups:
            self.open.put(groups)
        else:
            self.open.clear()
        first = groups[0][1] + self.idle if groups else None
        if timer is not None and timer != first:
            self.handle.deleteTimer(timer)
        if first is not None and timer != first:
            self.handle.registerTimer(first)

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        """All groups that the watermark has passed; they are in order of their ends, too."""
        passed = max(timerValues.getCurrentWatermarkInMs(), expiredTimerInfo.getExpiryTimeInMs())
        groups = [tuple(g) for g in self.open.get()]
        final = [g for g in groups if g[1] + self.idle <= passed]
        self._keep(groups[len(final) :], None)
        if final:
            yield pd.DataFrame([(key[0], *g) for g in final], columns=[self.key, "first_ms", "last_ms", "last_value", "n"])

    def close(self) -> None:
        pass


def closed_generations(stream: DataFrame, key: str, time_col: str, value: str, idle_ms: int, late: str) -> DataFrame:
    """(append mode) a row for each group of a key that is final: no row came within ``idle_ms`` after its last, in event time.

    A group ends by a timer, once the watermark has passed it; its state is cleared
    then, and a key that comes back opens a new group.  Until then rows that come late still
    count, and two groups become one if a row between them comes.  ``key`` and ``value`` are
    strings.  A row that is older than the watermark is dropped before it gets here.
    """
    marked = stream.withWatermark(time_col, late).select(key, time_col, value)
    shape = f"{key} string, first_ms bigint, last_ms bigint, last_value string, n bigint"
    return marked.groupBy(key).transformWithStateInPandas(_Generations(key, time_col, value, idle_ms), shape, "append", "EventTime")


def with_parent_in_time(children: DataFrame, parents: DataFrame, key: str, within: str, late: str) -> DataFrame:
    """(append mode) each child (key, child_id, child_ts) with the parents (key, parent_id, parent_ts) of its key up to ``within`` before it, or with none.

    Both sides have a watermark and the condition bounds their distance, so state is
    dropped once nothing can meet it any more; a child without a parent is given
    out at that point.  Rows older than the watermark are dropped.
    """
    c = children.withWatermark("child_ts", late).alias("c")
    p = parents.withWatermark("parent_ts", late).alias("p")
    near = F.expr(f"c.{key} = p.{key} and p.parent_ts >= c.child_ts - interval {within} and p.parent_ts <= c.child_ts")
    return c.join(p, near, "leftOuter").select(F.col(f"c.{key}").alias(key), "child_id", "child_ts", "parent_id", "parent_ts")


class MergedCounts:
    """A ``foreachBatch`` sink of counters: version N is version N-1 and batch N's counts.

    A batch that comes again builds the same version from the same predecessor, so
    it changes nothing; a version counts once it is committed in ``snapshots``.
    """

    def __init__(self, snapshots: Snapshots, *keys: str) -> None:
        self.snapshots, self.keys = snapshots, list(keys)

    def __call__(self, batch: DataFrame, number: int) -> None:
        delta = batch.groupBy(*self.keys).agg(F.count(F.lit(1)).alias("n"))
        before = self.snapshots.read(batch.sparkSession, below=number)
        self.snapshots.commit(delta if before is None else new_counts(before, delta), version=number)


def merge_counts_once(parts: list[DataFrame], *keys: str) -> tuple[DataFrame, list[int]]:
    """Counters over parts of a stream that arrive one after the other, and how many rows each run read."""
    spark = parts[0].sparkSession
    folder, checkpoint, base = (shared_folder(spark, f"stream-{k}") for k in ("arrivals", "checkpoint", "counters"))
    kept, read = Snapshots(base), []
    for part in parts:
        part.write.mode("append").parquet(folder)
        stream = spark.readStream.schema(part.schema).parquet(folder)
        run = stream.writeStream.foreachBatch(MergedCounts(kept, *keys)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        run.awaitTermination()
        read.append(sum(p["numInputRows"] for p in run.recentProgress))
    return kept.read(spark), read


def append_files(stream: DataFrame, path: str, checkpoint: str):
    """Append-as-you-go JSON files with exactly-once commits."""
    return stream.writeStream.format("json").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
