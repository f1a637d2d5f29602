"""Queries that write files through the sinks and read them back through the sources, in the shared folder."""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..adapters import AnswerCache, ask
from ..functions import text as X
from ..operators import calls, dialects, spans, stats, synth, taxonomy
from ..sources import files, sinks, traces
from ..sources.snapshots import Snapshots
from ..storage import shared_folder, stored
from ..streaming.streams import run_available
from .base import EVENT_SPANS, Registry, event_spans, iso, table

query = Registry()


def _as_lines(df: DataFrame) -> DataFrame:
    return df.select(F.to_json(F.struct(*df.columns)).alias("line"))


@query(f"""WITH {EVENT_SPANS} SELECT trace_id, span_id, span_type, span_name, start_time_s, parent_id FROM spans""")
def span_file_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = event_spans(spark, sf_dir).drop("line_no").withColumnsRenamed({"start_time_s": "startTime", "parent_id": "parentObservationId"})
    path = shared_folder(spark, "span-file")
    sinks.write_json_lines(found, path)
    sinks.write_text(table(spark, sf_dir, "region").select(F.lit("no object").alias("line")), "line", path, "append")
    return files.spans(spark, path).select("trace_id", "span_id", "span_type", "span_name", "start_time_s", "parent_id")


@query("""SELECT text AS query, coalesce(source, 'deer-flow') AS framework, lang AS difficulty FROM documents WHERE coalesce(source, 'deer-flow') IN ('src1', 'deer-flow')""")
def query_file_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark, "query-file")
    records = table(spark, sf_dir, "documents").select(F.col("text").alias("query"), F.col("source").alias("framework"), F.col("lang").alias("difficulty"))
    sinks.write_text(_as_lines(records), "line", path)
    return files.queries(spark, path, ["src1", "deer-flow"]).select("query", "framework", "difficulty")


@query("""SELECT ok, count(*) AS n FROM (SELECT c_custkey % 4 < 2 AS ok FROM customer WHERE c_custkey % 4 <> 3) GROUP BY 1""")
def dead_letter_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Objects, lists of one number, and blank lines, which are neither good nor dead."""
    k = F.col("c_custkey") % 4
    path = shared_folder(spark, "dead-letters")
    line = F.when(k < 2, F.concat(F.lit('{"k": '), "c_custkey", F.lit("}"))).when(k == 2, F.concat(F.lit("["), "c_custkey", F.lit("]"))).otherwise("  ")
    sinks.write_text(table(spark, sf_dir, "customer").select(line.alias("line")), "line", path)
    lines = files.json_lines(spark, path)
    good, _ = sinks.split_dead_letters(lines, F.col("ok"))
    return good.select("ok").unionByName(files.dead_letters(lines).select("ok")).groupBy("ok").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT c_name AS persona, CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment ELSE '' END AS persona_chinese, CAST(c_nationkey AS VARCHAR) AS nation FROM customer""")
def persona_file_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two appended parts, one of them without the Chinese text; another key becomes metadata."""
    c, path = table(spark, sf_dir, "customer"), shared_folder(spark, "personas")
    own = [F.col("c_name").alias("persona"), F.col("c_nationkey").alias("nation")]
    sinks.write_text(_as_lines(c.filter("c_custkey % 2 = 0").select(*own, F.col("c_mktsegment").alias("persona_chinese"))), "line", path)
    sinks.write_text(_as_lines(c.filter("c_custkey % 2 = 1").select(*own)), "line", path, "append")
    return files.personas(spark, path).select("persona", "persona_chinese", F.get_json_object("metadata", "$.nation").alias("nation"))


@query("""SELECT r_name AS framework, 'r' || r_regionkey AS id, NULL AS parent_id, r_name AS en, '' AS zh, 0 AS sib_pos FROM region
UNION ALL SELECT r_name, 'n' || n_nationkey, 'r' || r_regionkey, n_name, '国', CAST(row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) - 1 AS INTEGER) FROM nation JOIN region ON r_regionkey = n_regionkey""")
def taxonomy_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One document a region, each in a file of its own."""
    n = table(spark, sf_dir, "nation").select("n_regionkey", F.col("n_nationkey").alias("k"), F.concat(F.lit("n"), "n_nationkey").alias("id"), F.col("n_name").alias("en"), F.lit("国").alias("zh"))
    kids = n.groupBy("n_regionkey").agg(F.sort_array(F.collect_list(F.struct("k", "id", "en", "zh"))).alias("children"))
    tree = F.struct(F.concat(F.lit("r"), "r_regionkey").alias("id"), F.col("r_name").alias("en"), "children")
    docs = table(spark, sf_dir, "region").join(kids, F.col("r_regionkey") == F.col("n_regionkey"))
    path = shared_folder(spark, "taxonomies")
    docs.select(F.to_json(F.struct(F.col("r_name").alias("framework"), tree.alias("tree"))).alias("value"), "r_regionkey").repartition("r_regionkey").write.partitionBy("r_regionkey").text(path)
    return files.taxonomies(spark, f"{path}/*")


@query("""SELECT 'geo' AS framework, 'root' AS id, NULL AS parent_id, 'World' AS en, '世界' AS zh, 0 AS sib_pos
UNION ALL SELECT 'geo', 'r' || r_regionkey, 'root', r_name, '', CAST(row_number() OVER (ORDER BY r_regionkey) - 1 AS INTEGER) FROM region
UNION ALL SELECT 'geo', 'n' || n_nationkey, 'r' || n_regionkey, n_name, '国', CAST(row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) - 1 AS INTEGER) FROM nation
UNION ALL SELECT 'geo', 'c' || c_custkey, 'n' || c_nationkey, c_name, c_mktsegment, CAST(row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1 AS INTEGER) FROM customer""")
def taxonomy_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Adjacency rows saved as a version, nested into a document, written, and walked back into adjacency rows."""
    row = lambda t, ident, parent, en, zh, pos: table(spark, sf_dir, t).selectExpr("'geo' AS framework", f"{ident} AS id", f"{parent} AS parent_id", f"{en} AS en", f"{zh} AS zh", f"cast({pos} AS int) AS sib_pos")
    nodes = row("region", "'root'", "cast(null as string)", "'World'", "'世界'", "0").distinct()
    nodes = nodes.unionByName(row("region", "concat('r', r_regionkey)", "'root'", "r_name", "''", "r_regionkey")).unionByName(row("nation", "concat('n', n_nationkey)", "concat('r', n_regionkey)", "n_name", "'国'", "n_nationkey"))
    nodes = nodes.unionByName(row("customer", "concat('c', c_custkey)", "concat('n', c_nationkey)", "c_name", "c_mktsegment", "c_custkey"))
    trees, path = Snapshots(shared_folder(spark, "taxonomy")), shared_folder(spark, "taxonomy-documents")
    sinks.save_taxonomy(trees, nodes)
    sinks.write_documents(files.taxonomy_documents(trees.read(spark)), "document", "framework", path)
    return files.taxonomies(spark, f"{path}/*")


@query(r"""WITH e AS (SELECT event_id, event_type, CAST(json_extract(props, '$.k') AS VARCHAR) AS k FROM events)
SELECT event_id, '{"type": "' || event_type || '", "steps": [["<tool_call>lookup\n<arg_key>k</arg_key>\n<arg_value>' || k || '</arg_value>\n</tool_call>", ' || k || '], {"inner": {"' || event_type || '": "none < ' || k || '"}}]}' AS document FROM e""")
def leaf_rewrites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calls in any string of a nested document, in another dialect."""
    k = F.get_json_object("props", "$.k")
    call = F.concat(F.lit("<tool_use><tool_name>lookup</tool_name><parameter><k>"), k, F.lit("</k></parameter></tool_use>"))
    inner = F.struct(F.create_map("event_type", F.concat(F.lit("none < "), k)).alias("inner"))
    steps = F.concat(F.lit("[["), F.to_json(F.array(call)).substr(F.lit(2), F.length(F.to_json(F.array(call))) - 2), F.lit(","), k, F.lit("],"), F.to_json(inner), F.lit("]"))
    doc = F.concat(F.lit('{"type":"'), "event_type", F.lit('","steps":'), steps, F.lit("}"))
    return table(spark, sf_dir, "events").select("event_id", dialects.leaf_rewriter("glm")(doc).alias("document"))


def _configs(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """A configuration a nation: two agents of one name where its number divides by 5, and limits that some nations break."""
    k = F.col("n_nationkey")
    agents = F.array(
        F.struct(F.lit("lead").alias("agent_name"), F.array(F.lit("search"), F.col("n_name")).alias("tools"), F.when(k % 3 != 0, "p.md").alias("sysprompt_path")),
        F.struct(F.when(k % 5 == 0, "lead").otherwise("helper").alias("agent_name"), F.array(F.lit("search")).alias("tools"), F.lit("h.md").alias("sysprompt_path")),
    )
    models = F.array(F.struct(F.lit("m").alias("llm_name"), (k * 10_000).cast("int").alias("max_tokens"), F.lit(0.5).alias("temperature"), F.lit(60).alias("timeout")))
    nodes = F.array(F.struct(F.lit("lead").alias("id"), F.when(k % 7 == 0, "other").otherwise("agent").alias("type")))
    edges = F.array(F.struct(F.lit("lead").alias("from"), F.lit("helper").alias("to")))
    doc = F.to_json(F.struct(agents.alias("agents"), models.alias("llm_configs"), F.struct(nodes.alias("nodes"), edges.alias("edges")).alias("workflow")))
    path = shared_folder(spark, "frameworks")
    table(spark, sf_dir, "nation").select(doc.alias("value"), "n_nationkey").repartition("n_nationkey").write.partitionBy("n_nationkey").text(path)
    return files.framework_configs(spark, f"{path}/*")


_PLACE = "'n_nationkey=' || n_nationkey AS framework"


@query(f"""SELECT {_PLACE}, 'lead' AS agent_name, 'search,' || n_name AS tools FROM nation
UNION ALL SELECT {_PLACE}, CASE WHEN n_nationkey % 5 = 0 THEN 'lead' ELSE 'helper' END, 'search' FROM nation""")
def framework_config_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _configs(spark, sf_dir)["agents"].select("framework", "agent_name", F.array_join("tools", ",").alias("tools"))


@query(f"""SELECT {_PLACE}, 'lead' AS item, 'agent without a prompt' AS problem FROM nation WHERE n_nationkey % 3 = 0
UNION ALL SELECT {_PLACE}, 'lead', 'agent_name is not unique' FROM nation WHERE n_nationkey % 5 = 0
UNION ALL SELECT {_PLACE}, 'm', 'max_tokens out of range' FROM nation WHERE n_nationkey = 0 OR n_nationkey > 20
UNION ALL SELECT {_PLACE}, 'lead', 'unknown node type' FROM nation WHERE n_nationkey % 7 = 0""")
def config_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.config_violations(_configs(spark, sf_dir))


@query("""SELECT 'Q_' || event_type AS trace_name_safe, count(*) AS n FROM events GROUP BY 1""")
def files_by_trace_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder for each safe name, read back with the name as a column."""
    path = shared_folder(spark, "by-trace-name")
    sinks.write_by_trace_name(table(spark, sf_dir, "events").select("event_id", F.concat(F.lit("..Q: "), "event_type", F.lit("_")).alias("trace_name")), path)
    return spark.read.schema("event_id bigint, trace_name_safe string").json(path).groupBy("trace_name_safe").agg(F.count("event_id").alias("n"))


@query("""SELECT o_orderpriority AS path_id, count(*) + 10 AS n FROM orders GROUP BY 1""")
def counter_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored counters and a run's increments, as the next version."""
    o, path = table(spark, sf_dir, "orders").select(F.lit("o").alias("framework"), F.col("o_orderpriority").alias("path_id")), shared_folder(spark, "counters")
    sinks.write_json_lines(o.distinct().withColumn("n", F.lit(10)), path)
    return sinks.new_counts(spark.read.schema("framework string, path_id string, n bigint").json(path), taxonomy.count_samples(o)).select("path_id", "n")


@query("""SELECT 'doc ' || doc_id AS value FROM documents WHERE doc_id % 3 = 1""")
def valid_lines_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark, "valid-lines")
    sinks.valid_only(table(spark, sf_dir, "documents").select(F.concat(F.lit("doc "), "doc_id").alias("line"), (F.col("doc_id") % 3 == 1).alias("valid")), path)
    return spark.read.text(path).select("value")


@query("""SELECT n_regionkey, count(*) AS n, CAST(sum(n_nationkey) AS BIGINT) AS total FROM nation GROUP BY 1""")
def array_exports(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = sinks.as_json_array(table(spark, sf_dir, "nation").select("n_regionkey", "n_nationkey"), ["n_regionkey"])
    rows = docs.select("n_regionkey", F.explode(F.from_json("document", "array<struct<n_nationkey:bigint>>")).alias("x"))
    return rows.groupBy("n_regionkey").agg(F.count("x").alias("n"), F.sum("x.n_nationkey").alias("total"))


@query("""SELECT CAST(r_regionkey AS BIGINT) AS r_regionkey, r_regionkey = 0 AS is_new FROM region WHERE r_regionkey % 2 = 0""")
def changed_file_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of even regions have another hash than the stored one, or (region 0) none at all."""
    path = shared_folder(spark, "hashes")
    table(spark, sf_dir, "region").select(F.col("r_name").alias("value"), "r_regionkey").repartition("r_regionkey").write.partitionBy("r_regionkey").text(path)
    at = F.regexp_extract("path", "r_regionkey=([0-9]+)", 1).cast("bigint")
    everything = files.changed_files(spark, f"{path}/*", spark.createDataFrame([], "path string, hash string"))
    known = everything.filter(at != 0).select("path", F.when(at % 2 == 1, F.col("hash")).otherwise("old").alias("hash"))
    return files.changed_files(spark, f"{path}/*", known).select(at.alias("r_regionkey"), (at == 0).alias("is_new"))


def _day_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as spans of traces, one a day."""
    e = table(spark, sf_dir, "events").withColumn("ts", F.to_timestamp("ts"))
    return e.select(F.date_format("ts", "yyyy-MM-dd").alias("day"), F.col("event_id").cast("string").alias("span_id"), F.lit("GENERATION").alias("span_type"), F.col("event_type").alias("span_name"), iso("ts").alias("start_time_s"), F.col("user_id").cast("string").alias("parent_id"))


@query("""SELECT strftime(ts, '%Y-%m-%d') AS trace_id, CAST(event_id AS VARCHAR) AS span_id, event_type AS span_name,
row_number() OVER (PARTITION BY strftime(ts, '%Y-%m-%d') ORDER BY ts) - 1 AS line_no FROM events""")
def paged_trace_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages of all traces; within a trace by time."""
    path = shared_folder(spark, "pages")
    traces.write_pages(_day_spans(spark, sf_dir), path, "day")
    return traces.traces(spark, path=path).select("trace_id", "span_id", "span_name", "line_no")


@query("""SELECT strftime(ts, '%Y-%m-%d') AS trace_id, CAST(event_id AS VARCHAR) AS span_id, CAST(user_id AS VARCHAR) AS parent_id FROM events WHERE strftime(ts, '%Y-%m-%dT%H:%M:%S.%gZ') >= '2024-01-05T06:00:00' AND strftime(ts, '%Y-%m-%dT%H:%M:%S.%gZ') < '2024-01-08T18:00:00'""")
def pushed_trace_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A range of time that the source gets: traces outside of it are not asked for."""
    path = shared_folder(spark, "pages")
    traces.write_pages(_day_spans(spark, sf_dir), path, "day")
    found = traces.traces(spark, path=path).filter("start_time_s >= '2024-01-05T06:00:00' and start_time_s < '2024-01-08T18:00:00'")
    return found.select("trace_id", "span_id", "parent_id")


@query("""SELECT strftime(ts, '%Y-%m-%d') AS trace_id, CAST(event_id AS VARCHAR) AS span_id FROM events WHERE ts < (SELECT max(date_trunc('day', ts)) FROM events)""")
def pulled_traces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Traces pulled in two runs from one checkpoint; the newest day may still grow and is left for a later one."""
    rows, path, checkpoint, out = _day_spans(spark, sf_dir), *(shared_folder(spark, k) for k in ("pages", "pull-checkpoint", "pulled"))
    for days in ("day <= '2024-01-15'", "day > '2024-01-15'"):
        traces.write_pages(rows.filter(days), path, "day")
        found = run_available(traces.trace_stream(spark, path=path, unsettled="1"), f"pull-{uuid.uuid4().hex}", "append", checkpoint, out)
    return found.select("trace_id", "span_id")


@query("""SELECT strftime(ts, '%Y-%m-%d') AS trace_id, CAST(event_id AS VARCHAR) AS span_id, event_type AS span_name, strftime(ts, '%Y-%m-%dT%H:%M:%S.%gZ') AS start_time_s, CAST(user_id AS VARCHAR) AS parent_id
FROM events WHERE strftime(ts, '%Y-%m-%d') >= '2024-01-05'""")
def traces_to_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The traces since a day, pulled page by page into a file and read back from there."""
    path, out = shared_folder(spark, "pages"), shared_folder(spark, "trace-file")
    traces.write_pages(_day_spans(spark, sf_dir), path, "day")
    traces.save_traces(spark, out, path=path, start="2024-01-05")
    return files.spans(spark, out).select("trace_id", "span_id", "span_name", "start_time_s", "parent_id")


@query("""SELECT doc_id, source FROM documents WHERE doc_id % 3 = 1""")
def valid_rows_in_place(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table rewritten in place to its valid rows; what was a version before stays readable."""
    lines = Snapshots(shared_folder(spark, "lines"))
    lines.commit(table(spark, sf_dir, "documents").select("doc_id", "source"))
    sinks.rewrite_valid(lines, spark, F.col("doc_id") % 3 == 1)
    return lines.read(spark)


@query("""SELECT o_orderpriority AS path_id, count(*) AS n FROM orders GROUP BY 1""")
def counter_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three runs' counts, each merged into the version before."""
    o = table(spark, sf_dir, "orders").select(F.lit("o").alias("framework"), F.col("o_orderpriority").alias("path_id"), (F.col("o_orderkey") % 3).alias("run"))
    counters = Snapshots(shared_folder(spark, "counters"))
    for k in range(3):
        sinks.merge_counts(counters, taxonomy.count_samples(o.filter(F.col("run") == k)))
    return counters.read(spark).select("path_id", "n")


@query("""SELECT DISTINCT user_id AS trace_id, day(min(ts)) <= 10 AS early FROM events GROUP BY 1""")
def ledger_of_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs with a ledger: the second takes only users that the first did not."""
    e = table(spark, sf_dir, "events").select(F.col("user_id").alias("trace_id"), F.dayofmonth(F.to_timestamp("ts")).alias("day"))
    ledger = Snapshots(shared_folder(spark, "ledger"))
    first = stored(e.filter("day <= 10").select("trace_id").distinct(), "run")
    sinks.mark_done(ledger, first)
    second = stored(sinks.not_done(e, ledger.read(spark)).select("trace_id").distinct(), "run")
    sinks.mark_done(ledger, second)
    return ledger.read(spark).join(first.withColumn("early", F.lit(True)), "trace_id", "left").select("trace_id", F.coalesce("early", F.lit(False)).alias("early"))


@query("""SELECT doc_id, md5(text) AS answer, 1::BIGINT AS times_sent FROM documents WHERE text IS NOT NULL""")
def answers_across_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run over nine tenths of the documents, then one over all: every request has been sent once, as the cache's rows show."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text", F.md5("text").alias("request_key"))  # with the key beside them, texts need not be joined
    cache = AnswerCache(shared_folder(spark, "answer-cache"), "echo")
    ask(d.filter("doc_id % 10 <> 3"), "text", _Echo(), "answer", cache)
    out = ask(d, "text", _Echo(), "answer", cache)
    sent = cache.rows(spark).groupBy(F.col("__key").alias("key")).agg(F.count(F.lit(1)).alias("times_sent"))
    return out.join(sent, F.col("request_key") == F.col("key")).select("doc_id", "answer", "times_sent")


class _Echo:
    """A service that answers with the request's md5."""

    def __call__(self, requests: list[str]) -> list[str]:
        return [hashlib.md5(r.encode()).hexdigest() for r in requests]


class _ServerTools:
    """A server's tool list by its URL, in place of a network call."""

    def __call__(self, urls: list[str]) -> list[str]:
        return [f'[{{"name": "find_{u.rsplit("/", 1)[-1]}", "description": "d", "inputSchema": {{"type": "object"}}}}, {{"name": "list", "description": "d"}}]' for u in urls]


@query("""SELECT s_name AS server, md5('https://tools.example/' || s_suppkey) AS url_key, unnest(['find_' || s_suppkey, 'list']) AS tool_name, unnest(['{"type":"object"}', NULL]) AS parameters FROM supplier""")
def server_tool_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    servers = table(spark, sf_dir, "supplier").select(F.col("s_name").alias("server"), F.concat(F.lit("https://tools.example/"), "s_suppkey").alias("url"))
    return files.server_tools(spark, servers, _ServerTools()).select("server", "url_key", "tool_name", "parameters")


@query("""SELECT CAST(c_custkey AS VARCHAR) AS server, md5('https://tools.example/' || c_custkey % 500) AS url_key, unnest(['find_' || c_custkey % 500, 'list']) AS tool_name, 1::BIGINT AS times_sent FROM customer""")
def server_tools_across_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run over some of the customers' servers, then one over all of them: each URL, shared by many rows, has been asked once."""
    servers = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("server"), F.concat(F.lit("https://tools.example/"), F.col("c_custkey") % 500).alias("url"))
    cache = AnswerCache(shared_folder(spark, "tool-cache"), "tools")
    files.server_tools(spark, servers.filter("server % 3 = 0"), _ServerTools(), cache)
    out = files.server_tools(spark, servers, _ServerTools(), cache)
    sent = cache.rows(spark).groupBy(F.col("__key").alias("url_key")).agg(F.count(F.lit(1)).alias("times_sent"))
    return out.join(sent, "url_key").select("server", "url_key", "tool_name", "times_sent")


@query("""SELECT 'fw' || s_suppkey AS framework, CASE WHEN s_suppkey % 3 = 0 THEN 'own' ELSE 'shared' END AS root, CASE WHEN s_suppkey % 7 = 0 THEN '' WHEN s_nationkey % 2 = 0 AND s_suppkey % 5 <> 0 THEN '框架 ' || s_name
ELSE s_name || CASE WHEN s_suppkey % 3 = 0 THEN ' own' ELSE ' shared' END END AS description, s_suppkey % 4 = 0 AS has_extra FROM supplier""")
def framework_descriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Configurations in two roots, the first of which wins; descriptions by language: some lack the Chinese one, some have neither."""
    k = F.col("s_suppkey")
    rows = table(spark, sf_dir, "supplier").select(F.concat(F.lit("fw"), k).alias("framework"), k.alias("k"), "s_name", F.when(F.col("s_nationkey") % 2 == 0, "Chinese").otherwise("english").alias("language"))
    roots = rows.filter(F.col("k") % 3 == 0).withColumn("root", F.lit("own")).unionByName(rows.withColumn("root", F.lit("shared")))
    told, both = F.col("k") % 7 != 0, (F.col("k") % 7 != 0) & (F.col("k") % 5 != 0)
    doc = F.struct(F.col("framework").alias("name"), F.when(told, F.concat_ws(" ", "s_name", "root")).alias("description"), F.when(both, F.concat(F.lit("框架 "), "s_name")).alias("description_chinese"), F.when(F.col("k") % 4 == 0, "x").alias("extra"))
    path = shared_folder(spark, "roots")
    sinks.write_text(roots.select("root", "framework", F.to_json(doc).alias("line")).select(F.concat_ws("\t", "root", "framework", "line").alias("line")), "line", path)
    part = lambda i: F.split_part(F.col("value"), F.lit("\t"), F.lit(i))
    read = spark.read.text(path).select(part(1).alias("path"), part(2).alias("framework"), part(3).alias("config"))
    found = files.located(read.withColumn("rank", F.when(F.col("path") == "own", 0).otherwise(1)))
    wanted = read.join(found, ["framework", "path"]).join(rows.select("framework", "language"), "framework")
    extra = F.map_contains_key(files.config_metadata(F.col("config")), "extra")
    return wanted.select("framework", F.col("path").alias("root"), files.framework_description(F.col("config"), F.col("language")).alias("description"), extra.alias("has_extra"))


@query("""SELECT n_nationkey, n_name || '_sub_agent' AS name, 'Sub-agent ' || n_name AS description, 'find_' || n_name AS text_name, 'Finds ' || n_name || '.' AS text_description,
'{"type": "object", "properties": {"q": {"type": "string"}, "n": {"type": "string"}}}' AS text_parameters FROM nation""")
def agent_definitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    sub = calls.sub_agent_definition(F.col("n_name"), F.lit(None).cast("string"))["function"]
    prose = F.concat(F.lit("Finds "), "n_name", F.lit(". Usage: <tool_use><parameter><q>text</q><n>3</n></parameter></tool_use>"))
    tool = calls.definition_from_text(F.concat(F.lit("find_"), "n_name"), prose)["function"]
    names = ("name", "description", "parameters")
    return table(spark, sf_dir, "nation").select("n_nationkey", sub["name"].alias("name"), sub["description"].alias("description"), *[tool[k].alias(f"text_{k}") for k in names])


@query("""SELECT c_custkey, CASE WHEN c_custkey % 3 <> 0 THEN 'tr-' || c_custkey END AS trace_id FROM customer""")
def trace_ids_in_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = F.when(F.col("c_custkey") % 3 != 0, F.concat(F.lit("done\nLangfuseTraceID: tr-"), "c_custkey", F.lit("\nLangfuseTraceID: later"))).otherwise("no id")
    return table(spark, sf_dir, "customer").select("c_custkey", X.trace_id_in(log).alias("trace_id"))


@query("""SELECT conv_id, turn, CASE WHEN turn % 3 = 2 THEN NULL ELSE text END AS content FROM conversations""")
def output_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An object, a list whose first element counts, or a bare string, which is no message."""
    one = F.to_json(F.struct(F.col("text").alias("content")), {"ignoreNullFields": "false"})
    output = F.when(F.col("turn") % 3 == 0, one).when(F.col("turn") % 3 == 1, F.concat(F.lit("["), one, F.lit(', {"content": "b"}]'))).otherwise('"bare"')
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", F.try_variant_get(spans.output_message(output), "$.content", "string").alias("content"))


@query("""SELECT c_custkey, greatest(0.0::DOUBLE, least(1.0::DOUBLE, c_acctbal / 1000.0::DOUBLE)) AS p, replace(c_name || '-x', '-', '_') AS framework,
CASE WHEN c_custkey % 2 = 0 THEN 'tool_calls' ELSE 'stop' END AS finish_reason, CASE c_custkey % 3 WHEN 0 THEN 'e' WHEN 1 THEN 'h2' ELSE NULL END AS picked,
CASE WHEN c_custkey % 2 = 0 THEN 1 ELSE 0 END::BIGINT AS n_usable FROM customer""")
def record_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    one = lambda d, q: F.struct(F.lit(d).alias("difficulty"), F.lit(q).alias("query"))
    none = F.filter(F.array(one("", "")), lambda _: F.lit(False))
    drawn = F.when(k % 3 == 2, none).otherwise(F.array(one("easy", "e"), one("hard", "h1"), one("hard", "h2")))
    made = F.when(k % 2 == 0, F.array(F.lit("call")))
    found = F.array(F.struct(F.when(k % 2 == 0, "downloaded").otherwise("failed").alias("status")))
    return table(spark, sf_dir, "customer").select(
        "c_custkey", X.clamp(F.col("c_acctbal") / 1000).alias("p"), X.normalised_framework(F.concat("c_name", F.lit("-x"))).alias("framework"), spans.finish_reason(made).alias("finish_reason"),
        synth.pick_query(drawn, F.when(k % 3 == 0, "medium").otherwise("hard"))["query"].alias("picked"), F.size(synth.usable_files(found)).cast("bigint").alias("n_usable"),
    )


@query("""SELECT o_orderstatus AS framework, count(*) AS total_samples, count(DISTINCT o_custkey) AS total_paths_tracked, (SELECT min(n) FROM (SELECT o_orderstatus AS s, count(*) AS n FROM orders GROUP BY s, o_custkey) WHERE s = o_orderstatus) AS min_count,
round(count(*) / count(DISTINCT o_custkey), 6) AS avg_count FROM orders GROUP BY 1""")
def sampling_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    draws = table(spark, sf_dir, "orders").select(F.col("o_orderstatus").alias("framework"), F.col("o_custkey").cast("string").alias("path_id"))
    return taxonomy.count_statistics(taxonomy.count_samples(draws)).select("framework", "total_samples", "total_paths_tracked", "min_count", F.round("avg_count", 6).alias("avg_count"))


@query("""SELECT event_type AS status, count(*) AS n FROM events GROUP BY 1""")
def outcome_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.outcome_counts(table(spark, sf_dir, "events").select(F.col("event_type").alias("status")))
