"""Scalar functions as Catalyst expressions: closing tags, XML parameters, JSON payloads, names, prompts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The call tags, in the order in which missing closers are restored.
CALL_TAGS = ["tool_use", "sub-agent", "parallel_tool", "parallel_agent", "use_parallel_tool_calls", "use_parallel_sub_agents", "use_batch_agent"]
#: Prefix of a user message that carries tool results.
RESULT_PREFIX = "Tool execution results:"


def occurrences(text: Column, part: str) -> Column:
    """How often ``part`` stands in ``text``, without overlap."""
    return ((F.length(text) - F.length(F.replace(text, F.lit(part), F.lit("")))) / F.lit(len(part))).cast("int")


def strip(text: Column) -> Column:
    """White space of any script trimmed at both ends."""
    return F.regexp_replace(text, r"(?U)\A\s+|\s+\z", "")


def restore_closing_tags(text: Column) -> Column:
    """One closer appended for each call tag with more openers than closers, unless the text ends with that closer."""

    def one(x: Column, tag: str) -> Column:
        opened, closed = f"<{tag}>", f"</{tag}>"
        ends = F.endswith(F.regexp_replace(x, r"(?U)\s+\z", ""), F.lit(closed))
        return F.when(F.contains(x, F.lit(opened)) & ~ends & (occurrences(x, opened) > occurrences(x, closed)), F.concat(x, F.lit(closed))).otherwise(x)

    # each step sees the last one's result under a name of its own: the expression grows with the tags, not with their product
    return reduce(lambda x, tag: F.get(F.transform(F.array(x), lambda v: one(v, tag)), 0), CALL_TAGS, text)


def xml_params(body: Column) -> Column:
    """array<struct<k,v>> of the elements in ``body``; plain text is one parameter ``content``; later duplicates win, in the first's place."""
    names = F.regexp_extract_all(body, F.lit(r"(?s)<([^>]+)>(.*?)</\1>"), F.lit(1))
    values = F.regexp_extract_all(body, F.lit(r"(?s)<([^>]+)>(.*?)</\1>"), F.lit(2))
    pairs = F.zip_with(names, values, lambda k, v: F.struct(strip(k).alias("k"), strip(v).alias("v")))
    keys = F.array_distinct(F.transform(pairs, lambda p: p["k"]))
    last = F.transform(keys, lambda k: F.struct(k.alias("k"), F.element_at(F.filter(pairs, lambda p: p["k"] == k), -1)["v"].alias("v")))
    none = F.expr("cast(array() as array<struct<k:string,v:string>>)")
    plain = F.when(strip(body) == "", none).otherwise(F.array(F.struct(F.lit("content").alias("k"), strip(body).alias("v"))))
    return F.when(F.contains(body, F.lit("<")) & F.contains(body, F.lit(">")), last).otherwise(plain)


def call_id(*parts: Column) -> Column:
    """A call id that depends on the place of the call only."""
    return F.concat(F.lit("call_"), F.md5(F.concat_ws(":", *[p.cast("string") for p in parts])))


def tool_results(content: Column) -> Column:
    """array<struct<name,content>> of a message of tool results; unstructured text is one result of ``unknown_tool``."""
    pattern = F.lit(r"(?s)<tool_result>\s*<tool_name>([^<]+)</tool_name>\s*<result>(.*?)</result>\s*</tool_result>")
    found = F.zip_with(F.regexp_extract_all(content, pattern, F.lit(1)), F.regexp_extract_all(content, pattern, F.lit(2)), lambda n, r: F.struct(strip(n).alias("name"), strip(r).alias("content")))
    rest = strip(F.replace(content, F.lit(RESULT_PREFIX), F.lit("")))
    return F.when(F.size(found) > 0, found).otherwise(F.array(F.struct(F.lit("unknown_tool").alias("name"), rest.alias("content"))))


def clean_system_prompt(text: Column) -> Column:
    """The prompt without its tool, sub-agent and usage sections; of each family the first pattern that matches is cut everywhere."""
    # The section markers of each family.
    families = [
        (r"(?s)<TOOL_DEFINITIONS_START>.*?<TOOL_DEFINITIONS_END>", r"(?s)## Available Tools\s*\n.*?(?=## Available Sub-Agents|## Available Sub-agents|\n?\z)"),
        (r"(?s)<SUB_AGENTS_DEFINITIONS_START>.*?<SUB_AGENTS_DEFINITIONS_END>", r"(?s)## Available Sub-Agents.*?(?=\nWhen you use tools|\nFor parallel execution|\nFor batch processing|\n?\z)"),
        (r"(?s)<TOOL_USAGE_INSTRUCTIONS_START>.*?<TOOL_USAGE_INSTRUCTIONS_END>", r"(?s)\nWhen you use tools or sub-agents.*?(?=\n\n[A-Z]|\n\nIMPORTANT:|\n?\z)"),
    ]
    for marked, headed in families:
        text = F.when(text.rlike(marked), F.regexp_replace(text, marked, "")).otherwise(F.regexp_replace(text, headed, ""))
    return text


def created_hour(start: Column) -> Column:
    """YYYYMMDDHH of an ISO time as a number; the fixed default 1727136000 where there is none."""
    digits = F.substring(F.regexp_replace(start, "[TZ:-]", ""), 1, 10)
    return F.coalesce(digits.try_cast("bigint"), F.lit(1727136000).cast("bigint"))


def english_queries(response: Column) -> Column:
    """array<struct<difficulty,query>> of ``**EASY:** ...`` sections; other headings end a section but are no query."""
    return _sections(response, r"(?s)\*\*(\w+):\*\*\s*(.*?)(?=\*\*\w+:\*\*|\z)", {"EASY": "easy", "MEDIUM": "medium", "HARD": "hard"}, upper=True)


def chinese_queries(response: Column) -> Column:
    """The same of ``**简单:**``, ``**中等:**`` and ``**困难:**`` sections."""
    return _sections(response, r"(?s)\*\*(简单|中等|困难)[:：]\*\*\s*(.*?)(?=\*\*(?:简单|中等|困难)[:：]\*\*|\z)", {"简单": "easy", "中等": "medium", "困难": "hard"}, upper=False)


def _sections(response: Column, pattern: str, names: dict[str, str], upper: bool) -> Column:
    heads, bodies = (F.regexp_extract_all(response, F.lit(pattern), F.lit(k)) for k in (1, 2))

    def named(h: Column) -> Column:
        h = F.upper(h) if upper else h
        return F.coalesce(*[F.when(h == k, F.lit(v)) for k, v in names.items()])

    pairs = F.zip_with(heads, bodies, lambda h, b: F.struct(named(h).alias("difficulty"), strip(b).alias("query")))
    return F.filter(pairs, lambda p: p["difficulty"].isNotNull() & (p["query"] != ""))


def json_payload(text: Column) -> Column:
    """From the first ``{`` to the last ``}``; empty if there is none."""
    return F.regexp_extract(text, r"(?s)\{.*\}", 0)


def strip_fences(text: Column) -> Column:
    """The body of the first fenced block (```json before plain ```), else the text; trimmed."""
    typed = F.split_part(F.split_part(text, F.lit("```json"), F.lit(2)), F.lit("```"), F.lit(1))
    plain = F.split_part(text, F.lit("```"), F.lit(2))
    return strip(F.when(F.contains(text, F.lit("```json")), typed).when(F.contains(text, F.lit("```")), plain).otherwise(text))


def new_tag(response: Column, parent_id: Column) -> Column:
    """struct<id,en,zh> of the first flat JSON object with all three keys, the id prefixed by the parent's; else null."""
    found = F.from_json(F.regexp_extract(response, r"\{[^}]+\}", 0), "id string, en string, zh string")
    whole = found["id"].isNotNull() & found["en"].isNotNull() & found["zh"].isNotNull()
    return F.when(whole, F.struct(F.concat_ws("_", parent_id, found["id"]).alias("id"), found["en"].alias("en"), found["zh"].alias("zh")))


def repair_response(response: Column) -> Column:
    """struct<repairable,suggested_urls,action,reasoning>: defaults filled, and nothing is repairable without a suggestion."""
    r = F.from_json(strip_fences(response), "repairable boolean, suggested_urls array<string>, action string, reasoning string")
    urls = F.coalesce(r["suggested_urls"], F.expr("cast(array() as array<string>)"))
    able = F.coalesce(r["repairable"], F.lit(False)) & (F.size(urls) > 0)
    return F.struct(able.alias("repairable"), urls.alias("suggested_urls"), F.when(able, F.coalesce(r["action"], F.lit("repair"))).otherwise("remove").alias("action"), F.coalesce(r["reasoning"], F.lit("")).alias("reasoning"))


def fuzzify_response(response: Column) -> Column:
    """struct<fuzzy_query,reason>; null without a fuzzy_query."""
    r = F.from_json(json_payload(response), "fuzzy_query string, reason string")
    return F.when(strip(r["fuzzy_query"]) != "", F.struct(strip(r["fuzzy_query"]).alias("fuzzy_query"), r["reason"].alias("reason")))


def requirement_response(response: Column) -> Column:
    """struct<requires_files,reason,required_items>."""
    r = F.from_json(json_payload(response), "requires_files boolean, reason string, required_items array<string>")
    return F.struct(F.coalesce(r["requires_files"], F.lit(False)).alias("requires_files"), F.coalesce(r["reason"], F.lit("")).alias("reason"), F.coalesce(r["required_items"], F.expr("cast(array() as array<string>)")).alias("required_items"))


def file_plan(response: Column) -> Column:
    """array<struct<name,url,description>> of a plan's ``files`` that can be fetched: https or data URLs; a missing name comes from the URL."""
    r = F.from_json(json_payload(response), "files array<struct<name:string,url:string,description:string>>")
    can = F.filter(F.coalesce(r["files"], F.expr("cast(array() as array<struct<name:string,url:string,description:string>>)")), lambda f: F.coalesce(f["url"].rlike("^(https://|data:)"), F.lit(False)))
    return F.transform(can, lambda f: F.struct(F.when(strip(f["name"]) != "", strip(f["name"])).otherwise(file_name(f["url"])).alias("name"), f["url"].alias("url"), F.coalesce(f["description"], F.lit("")).alias("description")))


def download_folder(base: str, framework: Column, query: Column, key: Column) -> Column:
    """``<base>/<framework>/<slug of the query, or bundle>-<key>``."""
    return F.concat_ws("/", F.lit(base), framework, F.concat(F.coalesce(slug(query), F.lit("bundle")), F.lit("-"), key.cast("string")))


def augmented_query(response: Column) -> Column:
    """The ``query`` of a JSON answer; null without one."""
    found = strip(F.from_json(json_payload(response), "query string")["query"])
    return F.when(found != "", found)


def file_name(url: Column) -> Column:
    """The last part of a URL's path; ``download`` where there is none."""
    path = F.regexp_extract(url, r"\A[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    last = F.element_at(F.split(path, "/"), -1)
    return F.when(url.startswith("data:"), F.lit("download")).when(last == "", F.lit("download")).otherwise(last)


def rewrite_urls(query: Column, changes: Column) -> Column:
    """``query`` with the array<struct<url,action,new_url>> changes made in order; a removed URL leaves ``[URL removed]``."""
    return F.aggregate(changes, query, lambda q, c: F.replace(q, c["url"], F.when(c["action"] == "replace", c["new_url"]).otherwise(F.lit("[URL removed]"))))


def urls_in(text: Column) -> Column:
    """Distinct http(s) URLs in order, without closing punctuation."""
    found = F.regexp_extract_all(text, F.lit(r"https?://[^\s<>\"'()\[\]]+"), F.lit(0))
    return F.array_distinct(F.transform(found, lambda u: F.regexp_replace(u, r"[.,;:!?]+\z", "")))


def shorten(text: Column, width: int = 80, placeholder: str = "...") -> Column:
    """White space collapsed; if longer than ``width``, whole words up to it and the placeholder."""
    flat = strip(F.regexp_replace(text, r"(?U)\s+", " "))
    room = width - len(placeholder)
    head = F.regexp_extract(flat, rf"(?s)\A(.{{0,{room}}})(?= )", 1)
    return F.when(F.length(flat) <= width, flat).otherwise(F.concat(F.rtrim(head), F.lit(placeholder)))


def trace_name(name: Column) -> Column:
    """A file-safe trace name: other runs than word characters, dot and hyphen become ``_``; ``unnamed_trace`` if nothing is left."""
    safe = F.substring(F.regexp_replace(F.regexp_replace(name, r"(?U)[^\w.-]+", "_"), r"\A[._]+|[._]+\z", ""), 1, 100)
    return F.when(F.coalesce(safe, F.lit("")) == "", "unnamed_trace").otherwise(safe)


def slug(name: Column, most: int = 60) -> Column:
    """Lower-case letters, digits and single hyphens; null if nothing is left."""
    s = F.regexp_replace(F.regexp_replace(F.lower(name), "[^a-z0-9-]+", "-"), "-{2,}", "-")
    s = F.regexp_replace(F.substring(F.regexp_replace(s, r"\A-+|-+\z", ""), 1, most), r"-+\z", "")
    return F.when(s != "", s)


def trace_id_in(log: Column) -> Column:
    """The first trace id that a run's log names; null without one."""
    found = F.regexp_extract(log, r"LangfuseTraceID:\s*([a-zA-Z0-9-]+)", 1)
    return F.when(found != "", found)


def path_weight(count: Column) -> Column:
    """(n + 1) to the power -1.5: paths drawn often weigh less."""
    return F.pow(count + 1, F.lit(-1.5))


def bucket(*parts: Column, of: int = 1_000_000) -> Column:
    """A number in [0, 1) from the md5 of the parts: the same in every engine and run."""
    key = F.md5(F.concat_ws(":", *[p.cast("string") for p in parts]))
    return (F.conv(F.substring(key, 1, 8), 16, 10).cast("bigint") % of) / F.lit(float(of))


def in_language(lang: Column, zh: Column, en: Column) -> Column:
    """The Chinese column for ``chinese``, ``zh`` and ``zh-cn``, else the English one; an empty Chinese one falls back."""
    return F.when(F.lower(lang).isin("chinese", "zh", "zh-cn") & (F.coalesce(zh, F.lit("")) != ""), zh).otherwise(en)


def suitable(response: Column) -> Column:
    """Whether an answer says SUITABLE and holds no NOT, anywhere."""
    up = F.upper(F.coalesce(response, F.lit("")))
    return F.contains(up, F.lit("SUITABLE")) & ~F.contains(up, F.lit("NOT"))


def clamp(p: Column) -> Column:
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), p))


def normalised_framework(name: Column) -> Column:
    return F.replace(name, F.lit("-"), F.lit("_"))


def iso_time(text: Column) -> Column:
    """ISO date and time, with or without offset, as a timestamp; null if it can't be read."""
    return F.try_to_timestamp(text)


def stamp(ts: Column) -> Column:
    """Time part of a generated file name."""
    return F.date_format(ts, "yyyyMMdd_HHmmss_SSSSSS")


def data_url_bytes(url: Column) -> Column:
    """Content of a ``data:`` URL; null for any other URL."""
    head, body = F.split_part(url, F.lit(","), F.lit(1)), F.regexp_extract(url, r"(?s)\A[^,]*,(.*)\z", 1)
    return F.when(url.startswith("data:"), F.when(head.endswith(";base64"), F.unbase64(body)).otherwise(F.try_url_decode(body).cast("binary")))
