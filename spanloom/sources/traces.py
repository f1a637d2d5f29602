"""Paged trace stores as a Python data source: one partition per trace, time ranges pushed down."""

from __future__ import annotations

import hashlib
import heapq
import json
import operator
import pickle
import tempfile
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import datetime, timedelta
from typing import BinaryIO

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual

from .. import schemas
from ..adapters import retry
from ..operators.taxonomy import prefix
from .sinks import write_json_lines


@dataclass(frozen=True)
class StubStore:
    """A deterministic trace store: ``traces`` traces, one an hour from the first of January 2024, a few spans each, ``page`` a page."""

    traces: int = 10
    page: int = 3

    def trace_ids(self, start: str | None, end: str | None) -> list[str]:
        times = [(f"t{i:04d}", datetime(2024, 1, 1) + timedelta(hours=i)) for i in range(self.traces)]
        return [t for t, at in times if (not start or at >= datetime.fromisoformat(start)) and (not end or at <= datetime.fromisoformat(end))]

    def observations(self, trace_id: str, page: int) -> list[dict]:
        n = 4 + int(hashlib.md5(trace_id.encode()).hexdigest()[:2], 16) % 5
        at = datetime(2024, 1, 1) + timedelta(hours=int(trace_id[1:]))
        rows = [{"trace_id": trace_id, "span_id": f"{trace_id}-s{k}", "span_type": "GENERATION" if k else "SPAN", "span_name": "OpenAI-generation" if k else "planner", "model": "stub", "input": "[]", "output": "{}", "start_time_s": (at + timedelta(seconds=n - k)).isoformat(), "parent_id": f"{trace_id}-s0" if k else None, "level": "0"} for k in range(n)]
        return rows[page * self.page : (page + 1) * self.page]


@dataclass(frozen=True)
class PageFolder:
    """A store of pages as files: ``trace=<id>/page=<n>/*.json``, one span a line; ids of traces sort by time.

    The place of a service's paged answers, on any file system that pyarrow opens.
    """

    path: str

    def _files(self, under: str) -> list:
        """The file system, and the paths of what Spark's writers have put there."""
        from pyarrow import fs

        system, base = fs.FileSystem.from_uri(self.path)
        found = system.get_file_info(fs.FileSelector(f"{base.rstrip('/')}{under}", allow_not_found=True))
        return [system, sorted(f.path for f in found if not f.base_name.startswith((".", "_")))]

    def trace_ids(self, start: str | None, end: str | None) -> list[str]:
        """Ids of traces whose own time, which their id begins with, touches the range."""
        ids = [f.rsplit("=", 1)[1] for f in self._files("")[1]]
        return [t for t in ids if (not start or t >= start[: len(t)]) and (not end or t <= end[: len(t)])]

    def observations(self, trace_id: str, page: int) -> list[dict]:
        system, files = self._files(f"/trace={trace_id}/page={page}")
        rows = []
        for f in files:
            with system.open_input_stream(f) as stream:
                rows += [json.loads(line) | {"trace_id": trace_id} for line in stream.read().splitlines()]
        return rows


@dataclass
class _Trace(InputPartition):
    trace_id: str


#: Spans of a trace that are sorted in memory; longer traces are sorted in runs on the task's own disk, which are then merged.
RUN = 20_000


def _when(row: tuple) -> tuple:
    """Order of a trace's spans: by time, those without one first."""
    at = row[schemas.SPANS.names.index("start_time_s")]
    return at is not None, at or ""


def _put_aside(rows: list[tuple]) -> BinaryIO:
    """The rows in a file that is gone once it is closed, in short blocks."""
    file = tempfile.TemporaryFile()
    for k in range(0, len(rows), 500):
        pickle.dump(rows[k : k + 500], file)
    file.seek(0)
    return file


def _taken_up(file: BinaryIO) -> Iterator[tuple]:
    with file:
        while True:
            try:
                block = pickle.load(file)
            except EOFError:
                return
            yield from block


def _spans(store: StubStore | PageFolder, trace_id: str, attempts: int, wait_s: float) -> Iterator[tuple]:
    """A trace's spans ordered by time, from all of its pages; a page that fails is asked for again.

    Memory holds :data:`RUN` spans, and a block of each run while runs are merged, however long the trace is.
    """
    fetch = retry(lambda pages: [store.observations(trace_id, p) for p in pages], attempts, wait_s)
    rows, runs, page = [], [], 0
    while batch := fetch([page])[0]:
        rows += (tuple("" if n == "_raw" else r.get(n) for n in schemas.SPANS.names) for r in batch)
        page += 1
        if len(rows) >= RUN:
            runs.append(_put_aside(sorted(rows, key=_when)))
            rows = []
    rows.sort(key=_when)  # stable, as the merge is: equal times stay in the order of their pages
    at = schemas.SPANS.names.index("line_no")
    for i, r in enumerate(heapq.merge(*map(_taken_up, runs), rows, key=_when)):
        yield (*r[:at], i, *r[at + 1 :])


class _Reader(DataSourceReader):
    def __init__(self, store: StubStore | PageFolder, start: str | None, end: str | None, attempts: int, wait_s: float) -> None:
        self.store, self.start, self.end, self.how = store, start, end, (attempts, wait_s)
        self.pushed: list[Filter] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Ranges of ``start_time_s`` choose the traces that are asked for, and the rows; Spark sees to all other filters."""
        for f in filters:
            if type(f) in _COMPARE and f.attribute == ("start_time_s",) and isinstance(f.value, str):
                self.pushed.append(f)
            else:
                yield f

    def partitions(self) -> list[_Trace]:
        low = max([self.start or "", *(f.value for f in self.pushed if type(f) in (GreaterThan, GreaterThanOrEqual, EqualTo))])
        high = min([self.end or "\uffff", *(f.value for f in self.pushed if type(f) in (LessThan, LessThanOrEqual, EqualTo))])
        return [_Trace(t) for t in self.store.trace_ids(low or None, None if high == "\uffff" else high)]

    def read(self, partition: _Trace) -> Iterator[tuple]:
        at = schemas.SPANS.names.index("start_time_s")
        for row in _spans(self.store, partition.trace_id, *self.how):
            if all(row[at] is not None and _COMPARE[type(f)](row[at], f.value) for f in self.pushed):
                yield row


_COMPARE = {GreaterThan: operator.gt, GreaterThanOrEqual: operator.ge, LessThan: operator.lt, LessThanOrEqual: operator.le, EqualTo: operator.eq}


class _Pull(DataSourceStreamReader):
    """Traces as a stream: the offset is the last trace that was read; the newest ``unsettled`` ones may still grow and wait."""

    def __init__(self, store: StubStore | PageFolder, unsettled: int, attempts: int, wait_s: float) -> None:
        self.store, self.unsettled, self.how = store, unsettled, (attempts, wait_s)

    def initialOffset(self) -> dict:
        return {"after": ""}

    def latestOffset(self) -> dict:
        ids = self.store.trace_ids(None, None)
        settled = ids[: len(ids) - self.unsettled] if self.unsettled else ids
        return {"after": settled[-1] if settled else ""}

    def partitions(self, start: dict, end: dict) -> list[_Trace]:
        return [_Trace(t) for t in self.store.trace_ids(None, None) if start["after"] < t <= end["after"]]

    def read(self, partition: _Trace) -> Iterator[tuple]:
        yield from _spans(self.store, partition.trace_id, *self.how)

    def commit(self, end: dict) -> None:
        """Nothing is kept for offsets that are done: the store has all pages."""


class TraceSource(DataSource):
    """``spark.read.format("spanloom_traces")`` or ``readStream``: a :class:`PageFolder` at the option ``path``, else the stub store.

    Options: ``traces`` and ``page`` of the stub, ``start`` and ``end`` (ISO times),
    ``attempts`` and ``wait`` (seconds) of a page's requests, ``unsettled`` of a stream.
    """

    @classmethod
    def name(cls) -> str:
        return "spanloom_traces"

    def schema(self):
        return schemas.SPANS

    def store(self) -> StubStore | PageFolder:
        if "path" in self.options:
            return PageFolder(self.options["path"])
        return StubStore(int(self.options.get("traces", "10")), int(self.options.get("page", "3")))

    def _how(self) -> tuple[int, float]:
        return int(self.options.get("attempts", "3")), float(self.options.get("wait", "5"))

    def reader(self, schema) -> _Reader:
        return _Reader(self.store(), self.options.get("start"), self.options.get("end"), *self._how())

    def streamReader(self, schema) -> _Pull:
        return _Pull(self.store(), int(self.options.get("unsettled", "0")), *self._how())


def write_pages(spans: DataFrame, path: str, trace: str, page: int = 500) -> None:
    """``spans`` as a :class:`PageFolder`: ``trace`` names the column with the trace's id, a page holds ``page`` spans, the last one the rest.  Further traces can be added later."""
    placed = prefix(spans.withColumnRenamed(trace, "trace"), "trace", "span_id").withColumn("page", F.floor(F.col("place") / page)).drop("place")
    placed.repartition("trace", "page").write.mode("append").partitionBy("trace", "page").options(ignoreNullFields="false").json(path)


def traces(spark: SparkSession, source: type[TraceSource] = TraceSource, **options: str) -> DataFrame:
    """Spans of a paged store between ``start`` and ``end``; subclass :class:`TraceSource` to read another store.

    Filters on ``start_time_s`` are pushed into the source, which the session is told to allow.
    """
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(source)
    return spark.read.format(source.name()).options(**options).load()


def save_traces(spark: SparkSession, out: str, source: type[TraceSource] = TraceSource, **options: str) -> None:
    """The spans of a paged store as JSON lines that :func:`sources.files.spans` reads, appended to what is at ``out``.

    Each trace is written by the task that pulls it; no trace passes through the driver.
    """
    found = traces(spark, source, **options).drop("_raw", "src_file", "line_no")
    write_json_lines(found.withColumnsRenamed({"start_time_s": "startTime", "end_time_s": "endTime", "parent_id": "parentObservationId"}), out, "append")


def trace_stream(spark: SparkSession, source: type[TraceSource] = TraceSource, **options: str) -> DataFrame:
    """The same store as a stream of traces."""
    spark.dataSource.register(source)
    return spark.readStream.format(source.name()).options(**options).load()
