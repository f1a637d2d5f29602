"""Query synthesis as column stages: prompts, an injected language model, parsed answers, finished query records.

Each stage takes and returns a DataFrame; a stage that fails for a row adds to
the row's ``errors`` instead of failing the job.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..adapters import StubDownload, StubLLM, StubProbe, StubSearch, TextService, ask
from ..functions import text as X
from ..storage import stored
from .urls import repair_urls

#: Prompt templates by stage and language; ``{name}`` is replaced by the column of that name.
TEMPLATES = {
    ("suitability", "english"): "# suitability\nPersona: {persona}\nFramework: {framework}\nAnswer SUITABLE or NOT_SUITABLE.",
    ("rewrite", "english"): "# rewrite\nRewrite this persona so that it fits {framework}: {persona}",
    ("queries", "english"): "# queries\nPersona: {persona}\nProblem type: {problem_type}\nTools: {capabilities}\n{search_context}\nWrite one EASY, one MEDIUM and one HARD query.",
    ("queries", "chinese"): "# queries\n请用中文。人物：{persona}\n问题类型：{problem_type}\n工具：{capabilities}\n{search_context}\n写出简单、中等、困难各一个问题。",
    ("fuzzify", "english"): "# fuzzify\nMake this query less exact, as JSON with fuzzy_query: {query}",
    ("files", "english"): "# files\nDoes this query need local files? JSON with requires_files, reason, required_items: {query}",
    ("suitability", "chinese"): "# suitability\n请用中文。人物：{persona}\n框架：{framework}\n回答 SUITABLE 或 NOT_SUITABLE。",
    ("rewrite", "chinese"): "# rewrite\n请用中文改写这个人物，使其适合 {framework}：{persona}",
    ("fuzzify", "chinese"): "# fuzzify\n请用中文把问题写得更模糊，JSON，含 fuzzy_query：{query}",
    ("files", "chinese"): "# files\n这个问题需要本地文件吗？JSON，含 requires_files、reason、required_items：{query}",
    ("repair", "english"): "# repair {round}\n{url}\n{note}",
    ("repair", "chinese"): "# repair {round}\n请用中文。{url}\n{note}",
    ("plan", "english"): "# plan\nWhich public files does this query need? JSON with files (name, url, description): {query}\nItems: {items}",
    ("plan", "chinese"): "# plan\n这个问题需要哪些公开文件？JSON，含 files（name、url、description）：{query}\n项目：{items}",
    ("augment", "english"): "# with files\nRewrite this query so that it uses these files, as JSON with query: {query}\nFiles: {files}",
    ("augment", "chinese"): "# with files\n请改写这个问题，使其使用这些文件，JSON，含 query：{query}\n文件：{files}",
    ("urls", "english"): "# urls\nRewrite this query with these changes of its links, as JSON with query: {query}\nChanges: {changes}",
    ("urls", "chinese"): "# urls\n请按这些链接改动改写问题，JSON，含 query：{query}\n改动：{changes}",
    ("tag", "chinese"): "# tag\n请在 {parent_id} 下建议一个新标签；同级：{siblings}。JSON，含 id、en、zh。",
    ("tag", "english"): "# tag\nSuggest a new tag under {parent_id}; siblings: {siblings}. JSON with id, en, zh.",
}
DETAIL = {"low": "Keep it short.", "medium": "Give some detail.", "high": "Give full detail."}


def prompt(kind: str, language: str = "english", detail: str | None = None, **columns: Column) -> Column:
    """The template with its places filled; a null column fills its place with nothing."""
    template = TEMPLATES.get((kind, language)) or TEMPLATES[kind, "english"]
    text = reduce(lambda t, kv: F.replace(t, F.lit("{" + kv[0] + "}"), F.coalesce(kv[1].cast("string"), F.lit(""))), columns.items(), F.lit(template))
    return F.concat(text, F.lit("\n" + DETAIL[detail])) if detail else text


def capabilities(description: Column, agents: Column, tools: Column, servers: Column) -> Column:
    """A framework's description, sub-agents, tools and servers as lines; empty parts are left out."""
    part = lambda head, xs: F.when(F.size(F.coalesce(xs, F.expr("cast(array() as array<string>)"))) > 0, F.concat(F.lit(head), F.array_join(xs, ", ")))
    return F.concat_ws("\n", description, part("Sub-agents: ", agents), part("Tools: ", tools), part("Servers: ", servers))


def search_block(results: Column, most_queries: int = 3, most_results: int = 5) -> Column:
    """array<struct<query, results array<struct<title,snippet,url,source,date>>>> as numbered lines, cut to the first few."""
    one = lambda r, i: F.concat((i + 1).cast("string"), F.lit(". "), r["title"], F.lit(" - "), r["snippet"], F.lit(" ("), r["url"], F.lit(")"))
    block = lambda q: F.concat_ws("\n", F.concat(F.lit("Search: "), q["query"]), F.array_join(F.transform(F.slice(q["results"], 1, most_results), one), "\n"))
    return F.array_join(F.transform(F.slice(results, 1, most_queries), block), "\n\n")


@dataclass(frozen=True)
class SynthesisConfig:
    """``distribution``: shares of easy, medium and hard; probabilities are clamped to [0, 1]."""

    distribution: dict[str, float] = field(default_factory=lambda: {"easy": 0.2, "medium": 0.5, "hard": 0.3})
    fuzzify: float = 0.3
    web_search: float = 0.3
    language: str = "english"
    seed: str = "0"
    fuzzify_errors_fatal: bool = True
    llm: TextService = field(default_factory=StubLLM)
    search: TextService = field(default_factory=StubSearch)
    probe: TextService = field(default_factory=StubProbe)
    download: TextService = field(default_factory=StubDownload)
    download_base: str = "downloads"


def parse_distribution(text: str) -> dict[str, float]:
    """``easy:0.2,medium:0.5,hard:0.3``: exactly these keys, each within [0, 1], together 1 (give or take 0.001)."""
    out = {}
    for part in text.split(","):
        key, found, value = part.partition(":")
        if not found:
            raise ValueError(f"no share in {part!r}")
        out[key.strip()] = float(value)
    missing, extra = {"easy", "medium", "hard"} - set(out), set(out) - {"easy", "medium", "hard"}
    if missing or extra:
        raise ValueError(f"missing {sorted(missing)}, extra {sorted(extra)}")
    if any(not 0 <= v <= 1 for v in out.values()) or abs(sum(out.values()) - 1) > 0.001:
        raise ValueError(f"not a distribution: {out}")
    return out


def drawn_difficulty(distribution: dict[str, float], u: Column) -> Column:
    """The class whose interval holds ``u``; the last one takes what rounding leaves."""
    upto, expr, names = 0.0, None, list(distribution)
    for k in names[:-1]:
        upto += distribution[k]
        expr = F.when(u < upto, k) if expr is None else expr.when(u < upto, k)
    return F.lit(names[-1]) if expr is None else expr.otherwise(names[-1])


def pick_query(queries: Column, difficulty: Column) -> Column:
    """The query (struct) of the drawn class - of equals the last - else the first one; null without any."""
    match = F.filter(queries, lambda q: q["difficulty"] == difficulty)
    return F.when(F.size(match) > 0, F.element_at(match, -1)).otherwise(F.get(queries, 0))


def gate(p: float, seed: str, purpose: str, key: Column) -> Column:
    """Whether a row passes with probability ``p``."""
    return X.bucket(F.lit(seed), F.lit(purpose), key) < X.clamp(F.lit(float(p)))


def with_persona(df: DataFrame, cfg: SynthesisConfig) -> DataFrame:
    """Personas judged against the framework; unsuitable ones are rewritten."""
    parts = {"persona": F.col("persona"), "framework": F.col("framework")}
    judged = ask(df, prompt("suitability", cfg.language, **parts), cfg.llm, "__judged")
    marked = judged.withColumn("persona_was_rewritten", ~X.suitable(F.col("__judged"))).drop("__judged")
    written = ask(marked, F.when(F.col("persona_was_rewritten"), prompt("rewrite", cfg.language, **parts)), cfg.llm, "__persona")
    return written.withColumn("persona", F.coalesce("__persona", "persona")).drop("__persona")


def with_search(df: DataFrame, cfg: SynthesisConfig) -> DataFrame:
    """``search_context`` for the rows that the gate lets pass: two searches, short and without repeats."""
    schema = "array<struct<title:string,snippet:string,url:string,source:string,date:string>>"
    on = df.withColumn("used_web_search", gate(cfg.web_search, cfg.seed, "search", F.col("draw_id")))
    terms = F.array_distinct(F.array(X.shorten(F.concat_ws(" ", "problem_type", "persona")), X.shorten(F.col("problem_type"))))
    asked = on.filter("used_web_search").withColumn("__q", terms)
    flat = ask(asked.select("draw_id", F.posexplode("__q").alias("i", "query")), "query", cfg.search, "answer").withColumn("results", F.from_json("answer", schema))
    found = flat.groupBy("draw_id").agg(F.sort_array(F.collect_list(F.struct("i", "query", F.to_json("results").alias("r")))).alias("s"))
    block = search_block(F.transform("s", lambda x: F.struct(x["query"].alias("query"), F.from_json(x["r"], schema).alias("results"))))
    return on.join(found, "draw_id", "left").withColumn("search_context", F.coalesce(block, F.lit(""))).drop("s")


def with_query(df: DataFrame, cfg: SynthesisConfig) -> DataFrame:
    """``query`` and ``difficulty`` from the model's answer; a row without any parsed query gets an error."""
    wanted = prompt("queries", cfg.language, persona=F.col("persona"), problem_type=F.col("problem_type"), capabilities=F.col("capabilities"), search_context=F.col("search_context"))
    answered = ask(df, wanted, cfg.llm, "__answer")
    parse = X.chinese_queries if cfg.language == "chinese" else X.english_queries
    picked = pick_query(parse(F.col("__answer")), drawn_difficulty(cfg.distribution, X.bucket(F.lit(cfg.seed), F.lit("difficulty"), F.col("draw_id"))))
    done = answered.withColumn("__q", picked).withColumn("query", F.col("__q.query")).withColumn("difficulty", F.col("__q.difficulty"))
    return done.withColumn("errors", F.when(F.col("query").isNull(), F.array_append("errors", F.lit("empty_query"))).otherwise(F.col("errors"))).drop("__answer", "__q")


def with_files(df: DataFrame, cfg: SynthesisConfig) -> DataFrame:
    """Whether the query needs local files, and which."""
    r = X.requirement_response(F.col("__files"))
    return ask(df, F.when(F.col("query").isNotNull(), prompt("files", cfg.language, query=F.col("query"))), cfg.llm, "__files").withColumn("requires_local_files", r["requires_files"]).withColumn("file_requirement_reason", F.when(r["requires_files"], r["reason"])).withColumn("file_required_items", F.when(r["requires_files"], r["required_items"])).drop("__files")


def with_downloads(df: DataFrame, cfg: SynthesisConfig) -> DataFrame:
    """``files`` (name, url, path, status) of the queries that need some: planned by the model, each distinct URL fetched once."""
    wanted = F.when(F.col("requires_local_files"), prompt("plan", cfg.language, query=F.col("query"), items=F.array_join("file_required_items", ", ")))
    planned = ask(df, wanted, cfg.llm, "__plan").withColumn("__files", X.file_plan(F.col("__plan"))).drop("__plan")
    each = planned.select("draw_id", X.download_folder(cfg.download_base, F.col("framework"), F.col("query"), F.col("draw_id")).alias("folder"), F.posexplode("__files").alias("i", "f"))
    got = ask(each.select("draw_id", "folder", "i", "f.name", "f.url"), "url", cfg.download, "status")
    per = got.groupBy("draw_id").agg(F.sort_array(F.collect_list(F.struct("i", "name", "url", F.concat_ws("/", "folder", "name").alias("path"), "status"))).alias("__got"))
    none = F.expr("cast(array() as array<struct<name:string,url:string,path:string,status:string>>)")
    files = F.coalesce(F.transform("__got", lambda x: F.struct(x["name"].alias("name"), x["url"].alias("url"), x["path"].alias("path"), x["status"].alias("status"))), none)
    return planned.drop("__files").join(per, "draw_id", "left").withColumn("files", files).drop("__got")


def usable_files(files: Column) -> Column:
    """The files that were downloaded."""
    return F.filter(files, lambda f: f["status"] == "downloaded")


def with_file_rewrite(df: DataFrame, cfg: SynthesisConfig) -> DataFrame:
    """Queries with usable files rewritten to use them; without an answer the query stays and the row gets an error."""
    names = F.array_join(F.transform(usable_files(F.col("files")), lambda f: f["path"]), ", ")
    on = df.withColumn("__on", F.size(usable_files(F.col("files"))) > 0)
    answered = ask(on, F.when(F.col("__on"), prompt("augment", cfg.language, query=F.col("query"), files=names)), cfg.llm, "__answer").withColumn("__new", X.augmented_query(F.col("__answer")))
    errors = F.when(F.col("__on") & F.col("__new").isNull(), F.array_append("errors", F.lit("files: no query"))).otherwise(F.col("errors"))
    return answered.withColumn("errors", errors).withColumn("query", F.coalesce("__new", "query")).drop("__on", "__answer", "__new")


def error_rows(done: DataFrame) -> DataFrame:
    """(draw_id, success, stop, errors) of the rows that failed; ``stop`` is the first error."""
    return done.filter(F.size("errors") > 0).select("draw_id", F.lit(False).alias("success"), F.get("errors", 0).alias("stop"), "errors")


def until_failure(draws: DataFrame, cfg: SynthesisConfig, stages: list[Callable]) -> tuple[DataFrame, list[tuple[str, float]]]:
    """Stages one after another: a row with an error takes no part in later ones.  Also each stage's name and seconds."""
    import time

    rows, failed, times = draws.withColumn("errors", F.expr("cast(array() as array<string>)")), None, []
    for stage in stages:
        start = time.time()
        rows = stored(stage(rows, cfg), "stage")
        times.append((stage.__name__, time.time() - start))
        bad = rows.filter(F.size("errors") > 0)
        failed = bad if failed is None else failed.unionByName(bad, allowMissingColumns=True)
        rows = rows.filter(F.size("errors") == 0)
    return rows if failed is None else rows.unionByName(failed, allowMissingColumns=True), times


def with_fuzzy(df: DataFrame, cfg: SynthesisConfig) -> DataFrame:
    """The query made less exact where the gate lets pass; the exact one stays in ``original_query``."""
    on = df.withColumn("__on", gate(cfg.fuzzify, cfg.seed, "fuzzify", F.col("draw_id")) & F.col("query").isNotNull())
    answered = ask(on, F.when(F.col("__on"), prompt("fuzzify", cfg.language, query=F.col("query"))), cfg.llm, "__answer").withColumn("__r", X.fuzzify_response(F.col("__answer")))
    ok = F.col("__r").isNotNull()
    failed = F.when(F.col("__on") & ~ok & F.lit(cfg.fuzzify_errors_fatal), F.array_append("errors", F.lit("fuzzifier: no fuzzy_query"))).otherwise(F.col("errors"))
    done = answered.withColumn("fuzzified", ok).withColumn("original_query", F.when(ok, F.col("query"))).withColumn("query", F.coalesce("__r.fuzzy_query", "query")).withColumn("errors", failed)
    return done.drop("__r", "__answer", "__on")


def with_urls(df: DataFrame, cfg: SynthesisConfig) -> DataFrame:
    return repair_urls(df, "draw_id", "query", cfg.probe, cfg.llm)


STAGES: list[Callable[[DataFrame, SynthesisConfig], DataFrame]] = [with_persona, with_search, with_query, with_urls, with_files, with_downloads, with_file_rewrite, with_fuzzy]


def synthesise(draws: DataFrame, cfg: SynthesisConfig | None = None, stages: list[Callable] | None = None) -> DataFrame:
    """Draws (draw_id, framework, persona, problem_type, trace_context, capabilities) through all stages.

    Each stage's rows are stored: a stage reads what the one before it wrote and
    never runs it again.
    """
    cfg = cfg or SynthesisConfig()
    start = draws.withColumn("errors", F.expr("cast(array() as array<string>)"))
    return reduce(lambda df, stage: stored(stage(df, cfg), "stage"), stages or STAGES, start)


def query_records(done: DataFrame) -> DataFrame:
    """Finished rows without errors as query records; metadata is JSON without the exact query of a fuzzified one."""
    md = F.to_json(F.struct("persona_was_rewritten", "file_requirement_reason", "file_required_items", "url_stats", F.lit("synth").alias("source")))
    return done.filter(F.size("errors") == 0).select("query", "difficulty", "problem_type", "trace_context", "framework", "requires_local_files", "used_web_search", "fuzzified", "original_query", md.alias("metadata"))


def merged(left: Column, right: Column) -> Column:
    """Two maps as one; the right one wins."""
    return F.map_concat(F.map_filter(left, lambda k, v: ~F.coalesce(F.array_contains(F.map_keys(right), k), F.lit(False))), right)
