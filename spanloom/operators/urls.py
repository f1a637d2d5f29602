"""URLs in queries: probing, bounded repair, rewriting."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..adapters import TextService, ask
from ..functions.text import repair_response, rewrite_urls, urls_in
from ..storage import stored

ROUNDS = 3


def probe_twice(service: TextService) -> TextService:
    """A URL counts as accessible (``200``) if one of two tries says so; an error of the service is a failed try."""

    def call(requests: list[str]) -> list[str]:
        out = ["" for _ in requests]
        for _ in range(2):
            todo = [i for i, x in enumerate(out) if x != "200"]
            if todo:
                try:
                    found = service([requests[i] for i in todo])
                except Exception as e:  # one bad answer must not fail the whole batch's rows
                    found = [f"error: {e}"] * len(todo)
                for i, x in zip(todo, found, strict=True):
                    out[i] = x
        return out

    return call


def repair_urls(df: DataFrame, key: str, query_col: str, probe: TextService, llm: TextService, rounds: int = ROUNDS) -> DataFrame:
    """``query_col`` with broken URLs replaced or removed, and ``url_stats``.

    Every URL is probed (status 200 is accessible, two tries).  For a broken one
    the model suggests others, round by round with the last failure in the prompt;
    the first accessible suggestion wins, and a refusal ends its rounds.  Queries
    without a URL pass by unchanged with null ``url_stats``.  Each distinct URL of
    a round is probed once and each distinct prompt sent once; rounds without an
    open URL aren't run.
    """
    check, rows = probe_twice(probe), stored(df, "queries")
    flat = rows.select(key, F.posexplode(urls_in(F.coalesce(F.col(query_col), F.lit("")))).alias("at", "url"))
    first = ask(flat, "url", check, "status").withColumn("ok", F.col("status") == "200")
    state = stored(first.select(key, "at", "url", "ok", F.lit(None).cast("string").alias("new_url"), (~F.col("ok")).alias("open"), F.lit("not accessible").alias("note")), "url-state")
    for k in range(rounds):
        todo = state.filter("open")
        if todo.isEmpty():
            break
        answered = ask(todo, F.concat(F.lit(f"# repair {k}\n"), F.col("url"), F.lit("\n"), F.col("note")), llm, "answer").withColumn("r", repair_response(F.col("answer")))
        offered = answered.select(key, "at", F.col("r.repairable").alias("more"), F.posexplode_outer("r.suggested_urls").alias("i", "candidate"))
        tried = ask(offered, "candidate", check, "status")
        best = tried.groupBy(key, "at").agg(F.first("more").alias("more"), F.min_by("candidate", F.when(F.col("status") == "200", F.col("i"))).alias("winner"), F.max_by("candidate", "i").alias("last"))
        joined = state.join(best, [key, "at"], "left")
        state = stored(joined.select(key, "at", "url", "ok", F.coalesce("new_url", F.when(F.col("more"), F.col("winner"))).alias("new_url"), (F.col("open") & F.coalesce("more", F.lit(False)) & F.col("winner").isNull()).alias("open"), F.coalesce(F.concat(F.lit("failed: "), "last"), F.col("note")).alias("note")), "url-state")
    change = F.struct("at", "url", F.when(F.col("new_url").isNotNull(), "replace").otherwise("remove").alias("action"), F.coalesce("new_url", F.lit("")).alias("new_url"))
    per = url_statistics(state, key).join(state.groupBy(key).agg(F.sort_array(F.collect_list(F.when(~F.col("ok"), change))).alias("__changes")), key)
    per = per.select(key, "__changes", F.struct("total_extracted", "accessible", "repaired", "removed").alias("url_stats"))
    return rows.join(per, key, "left").withColumn(query_col, F.when(F.size("__changes") > 0, rewrite_urls(F.col(query_col), F.col("__changes"))).otherwise(F.col(query_col))).drop("__changes")


def url_statistics(urls: DataFrame, *keys: str) -> DataFrame:
    """Per key: URLs in all, accessible, repaired and removed ones, of rows (ok, new_url)."""
    return urls.groupBy(*keys).agg(F.count(F.lit(1)).alias("total_extracted"), F.count_if("ok").alias("accessible"), F.count_if(F.col("new_url").isNotNull()).alias("repaired"), F.count_if(~F.col("ok") & F.col("new_url").isNull()).alias("removed"))
