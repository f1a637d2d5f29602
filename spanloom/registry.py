"""Query key -> callable and oracle SQL of the engine's own operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .plans import baseline, blocks, files, streams, synthesis, traces

_ALL = (traces.query, blocks.query, synthesis.query, files.query, streams.query, baseline.query)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: f for r in _ALL for k, f in r.queries.items()}


def oracle_sql() -> dict[str, str]:
    return {k: s for r in _ALL for k, s in r.sql.items()}
