"""External services behind small protocols, with deterministic offline stubs.

A service is any picklable callable from a list of inputs to a list of outputs;
:func:`as_udf` makes it an Arrow-batched column function.
"""

import hashlib
import json
import time
from collections.abc import Callable
from dataclasses import dataclass
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .storage import stored


class TextService(Protocol):
    """A completion, search or probe service: one answer for each request, in order."""

    def __call__(self, requests: list[str]) -> list[str]: ...


def as_udf(service: TextService, returns: str = "string") -> Callable:
    """Column function that calls ``service`` once per Arrow batch; null requests get null."""

    @F.pandas_udf(returns)
    def call(requests: pd.Series) -> pd.Series:
        asked = requests.dropna()
        answers = pd.Series(service(asked.tolist()), index=asked.index, dtype=object)
        return answers.reindex(requests.index).where(requests.notna(), None)

    return call


@dataclass(frozen=True)
class AnswerCache:
    """Answers kept across runs, under a hash of service and request; ``max_age_s`` after they were given they are asked for again.

    A run appends its new answers to the table at ``path``; nothing is rewritten.  Of
    several answers to one request (two runs at once, or one grown old) the newest counts.
    """

    path: str
    service: str
    max_age_s: float | None = None

    def rows(self, spark: SparkSession) -> DataFrame:
        """Every answer of the service that a run has added."""
        make = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        shape = "__key string, service string, answer string, given double"
        there = make(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(make(self.path))
        found = spark.read.schema(shape).parquet(self.path) if there else spark.createDataFrame([], shape)
        return found.filter(F.col("service") == self.service)

    def known(self, spark: SparkSession) -> DataFrame:
        """(__key, answer) of the answers that are young enough."""
        rows = self.rows(spark)
        if self.max_age_s is not None:
            rows = rows.filter(F.col("given") >= time.time() - self.max_age_s)
        return rows.groupBy("__key").agg(F.max_by("answer", F.struct("given", "answer")).alias("answer"))

    def add(self, answers: DataFrame) -> None:
        """Append (__key, answer)."""
        answers.select("__key", F.lit(self.service).alias("service"), "answer", F.lit(time.time()).alias("given")).write.mode("append").parquet(self.path)


def ask(df: DataFrame, request: Column | str, service: TextService, out: str, cache: AnswerCache | None = None) -> DataFrame:
    """``df`` plus ``out``: the service's answer to each row's request; a null request gets null.

    Each distinct request goes out once: answers are stored with a hash of their
    request before they are joined, so neither a second use of the result nor a
    lost executor repeats a call.  With a ``cache`` only requests that it doesn't
    know go out, and their answers are added to it.  Where the request is a column
    of ``df``, give its name: it is then stored with the rows only, not a second time.
    """
    spark = df.sparkSession
    rows, name = (df, request) if isinstance(request, str) else (df.withColumn("__request", request), "__request")
    asked = stored(rows.withColumn("__key", F.md5(F.col(f"`{name}`"))), "requests")
    once = asked.filter("__key is not null").select("__key", F.col(f"`{name}`").alias("__request")).dropDuplicates(["__key"])
    known = stored(cache.known(spark), "known-answers") if cache else None
    new = once.join(known, "__key", "left_anti") if known is not None else once
    answers = stored(new.select("__key", as_udf(service)(F.col("__request")).alias("answer")), "answers")
    if known is not None:
        if not answers.isEmpty():
            cache.add(answers)
        answers = answers.unionByName(known)
    return asked.drop(out, "__request").join(answers.withColumnRenamed("answer", out), "__key", "left").drop("__key")


def _pick(text: str, n: int) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:8], 16) % n


@dataclass(frozen=True)
class StubLLM:
    """Answers by a hash of the prompt, in the form that the prompt's first word asks for."""

    def __call__(self, requests: list[str]) -> list[str]:
        return [self._one(r) for r in requests]

    @staticmethod
    def _one(prompt: str) -> str:
        kind, tag = prompt.split("\n", 1)[0].strip("# :").lower(), hashlib.md5(prompt.encode()).hexdigest()[:6]
        if "suitab" in kind:
            return "NOT_SUITABLE" if _pick(prompt, 4) == 0 else "SUITABLE"
        if "fuzz" in kind:
            return json.dumps({"fuzzy_query": f"something about {tag}", "reason": "stub"})
        if "plan" in kind:
            return json.dumps({"files": [{"name": f"table-{tag}.csv", "url": f"https://files.example/{tag}.csv", "description": "stub"}, {"name": "x", "url": "http://no.example/x"}]})
        if "with files" in kind:
            return json.dumps({"query": f"use the files of {tag}"})
        if "file" in kind:
            return json.dumps({"requires_files": _pick(prompt, 3) == 0, "reason": "stub", "required_items": [f"table-{tag}"]})
        if "repair" in kind:
            return json.dumps({"repairable": True, "suggested_urls": [f"https://ok.example/{tag}"], "action": "repair", "reasoning": "stub"})
        if "tag" in kind:
            return json.dumps({"id": tag, "en": f"Tag {tag}", "zh": f"标签 {tag}"})
        if "中文" in prompt:
            return f"**简单:** 问题 {tag} 一\n**中等:** 问题 {tag} 二\n**困难:** 问题 {tag} 三"
        return f"**EASY:** question {tag} one\n**MEDIUM:** question {tag} two\n**HARD:** question {tag} three"


@dataclass(frozen=True)
class StubDownload:
    """``downloaded`` for four fifths of the URLs and all data URLs, else why not."""

    def __call__(self, requests: list[str]) -> list[str]:
        return ["downloaded" if u.startswith("data:") or _pick(u, 5) else "failed: 404" for u in requests]


@dataclass(frozen=True)
class StubSearch:
    """Five made-up results as a JSON array of title, snippet, url, source, date."""

    def __call__(self, requests: list[str]) -> list[str]:
        return [json.dumps([{"title": f"{r[:40]} {i}", "snippet": f"about {r[:40]}", "url": f"https://site{i}.example/{_pick(r, 1000)}", "source": f"site{i}", "date": "2024-01-01"} for i in range(5)]) for r in requests]


@dataclass(frozen=True)
class StubbornLLM:
    """Answers repairs by a hash of the prompt: a quarter is refused, a quarter gets a URL that works, the others one that doesn't."""

    def __call__(self, requests: list[str]) -> list[str]:
        def one(prompt: str) -> str:
            kind, tag = _pick(prompt, 4), hashlib.md5(prompt.encode()).hexdigest()[:6]
            url = f"https://ok.example/{tag}" if kind == 1 else f"http://gone.example/{tag}"
            return json.dumps({"repairable": kind > 0, "suggested_urls": [url] if kind else [], "reasoning": "stub"})

        return [one(r) for r in requests]


@dataclass(frozen=True)
class StubProbe:
    """Status of a URL: 200 for hosts under ``ok.`` and for two thirds of the others, else 404; never 200 for one that holds ``gone``."""

    gone: str = ""

    def __call__(self, requests: list[str]) -> list[str]:
        return ["200" if "://ok." in u or (_pick(u, 3) and not (self.gone and self.gone in u)) else "404" for u in requests]


def retry(service: TextService, attempts: int = 3, wait_s: float = 5.0) -> TextService:
    """``service`` tried again after an error, ``attempts`` times in all; the last error is raised."""

    def call(requests: list[str]) -> list[str]:
        for k in range(attempts):
            try:
                return service(requests)
            except Exception:
                if k == attempts - 1:
                    raise
                time.sleep(wait_s)
        return []

    return call
