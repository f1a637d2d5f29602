"""Queries over taxonomies, sampling, query records, prompts and URLs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import stats, synth, taxonomy, urls
from ..adapters import StubbornLLM, StubLLM, StubProbe, ask
from ..sources.snapshots import Snapshots
from ..storage import shared_folder
from .base import Registry, table

query = Registry()


def _nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """root -> region -> nation as a taxonomy."""
    root = spark.sql("select 'geo' as framework, 'root' as id, cast(null as string) as parent_id, 'World' as en, '世界' as zh, 0 as sib_pos")
    r = table(spark, sf_dir, "region").select(F.lit("geo").alias("framework"), F.concat(F.lit("r"), "r_regionkey").alias("id"), F.lit("root").alias("parent_id"), F.col("r_name").alias("en"), F.col("r_name").alias("zh"), F.col("r_regionkey").cast("int").alias("sib_pos"))
    n = table(spark, sf_dir, "nation").select(F.lit("geo").alias("framework"), F.concat(F.lit("n"), "n_nationkey").alias("id"), F.concat(F.lit("r"), "n_regionkey").alias("parent_id"), F.col("n_name").alias("en"), F.col("n_name").alias("zh"), F.col("n_nationkey").cast("int").alias("sib_pos"))
    return root.unionByName(r).unionByName(n)


_NODES = """RECURSIVE nodes AS (SELECT 'root' AS id, NULL AS parent_id, 'World' AS en UNION ALL SELECT 'r' || r_regionkey, 'root', r_name FROM region UNION ALL SELECT 'n' || n_nationkey, 'r' || n_regionkey, n_name FROM nation),
walk(id, ids, names, depth) AS (SELECT id, id, en, 1 FROM nodes WHERE parent_id IS NULL UNION ALL SELECT n.id, w.ids || '→' || n.id, w.names || ' → ' || n.en, depth + 1 FROM walk w JOIN nodes n ON n.parent_id = w.id),
paths AS (SELECT * FROM walk WHERE id NOT IN (SELECT parent_id FROM nodes WHERE parent_id IS NOT NULL))"""


@query(f"WITH {_NODES} SELECT ids AS path_id, names AS label, depth FROM paths")
def taxonomy_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return taxonomy.paths(_nodes(spark, sf_dir)).select("path_id", taxonomy.label_string(F.col("labels_en")).alias("label"), "depth")


@query(f"WITH {_NODES} SELECT (SELECT count(DISTINCT id) FROM nodes) AS total_nodes, count(*) AS total_paths, max(depth) AS max_depth, min(depth) AS min_depth, round(avg(depth), 6) AS avg_depth FROM paths")
def taxonomy_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = _nodes(spark, sf_dir)
    return taxonomy.statistics(n, taxonomy.paths(n)).select("total_nodes", "total_paths", "max_depth", "min_depth", F.round("avg_depth", 6).alias("avg_depth"))


def _counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").groupBy(F.lit("o").alias("framework"), F.col("o_custkey").cast("string").alias("path_id")).agg(F.count(F.lit(1)).alias("n"))


@query("""WITH c AS (SELECT CAST(c_custkey AS VARCHAR) AS path_id, count(o_orderkey) AS n FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1)
SELECT path_id, n, round(pow(n + 1, -1.5), 9) AS weight, round(pow(n + 1, -1.5) / sum(pow(n + 1, -1.5)) OVER (), 9) AS probability FROM c""")
def path_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = table(spark, sf_dir, "customer").select(F.lit("o").alias("framework"), F.col("c_custkey").cast("string").alias("path_id"))
    return taxonomy.probabilities(found, _counts(spark, sf_dir)).select("path_id", "n", F.round("weight", 9).alias("weight"), F.round("probability", 9).alias("probability"))


@query("""SELECT event_type AS path_id, count(*) AS n FROM events GROUP BY 1""")
def sampling_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select(F.lit("e").alias("framework"), F.col("event_type").alias("path_id"), "event_id")
    half = lambda k: taxonomy.count_samples(e.filter(F.col("event_id") % 2 == k))
    return taxonomy.merge_counts(half(0), half(1)).select("path_id", "n")


@query("""WITH c AS (SELECT o_orderpriority AS path_id, count(*) AS n FROM orders GROUP BY 1), w AS (SELECT *, pow(n + 1, -1.5) AS w FROM c),
p AS (SELECT path_id, sum(w / t) OVER (ORDER BY path_id) AS hi FROM w, (SELECT sum(w) AS t FROM w)),
u AS (SELECT doc_id, (('0x' || substr(md5('7:o:' || doc_id), 1, 8))::BIGINT % 1000000) / 1000000.0 AS u FROM documents)
SELECT doc_id, coalesce((SELECT min(path_id) FROM p WHERE hi > u), (SELECT max(path_id) FROM p)) AS path_id FROM u""")
def weighted_path_draw(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = table(spark, sf_dir, "orders").groupBy(F.lit("o").alias("framework"), F.col("o_orderpriority").alias("path_id")).agg(F.count(F.lit(1)).alias("n"))
    shares = taxonomy.probabilities(counts.select("framework", "path_id"), counts)
    draws = table(spark, sf_dir, "documents").select(F.lit("o").alias("framework"), F.col("doc_id").alias("draw_id"))
    return taxonomy.draw_paths(shares, draws, "7").select(F.col("draw_id").alias("doc_id"), "path_id")


@query("""WITH c AS (SELECT user_id, 'p' || lpad(CAST(event_id AS VARCHAR), 12, '0') AS path_id, user_id % 2 AS f, CAST(event_id % 7 AS BIGINT) AS n FROM events),
w AS (SELECT *, pow(n + 1, -1.5) AS w FROM c), t AS (SELECT f, sum(w) AS t FROM w GROUP BY 1),
p AS (SELECT f, path_id, sum(w / t) OVER (PARTITION BY f ORDER BY path_id) - w / t AS lo FROM w JOIN t USING (f)),
d AS (SELECT o_orderkey AS id, o_orderkey % 2 AS f, (('0x' || substr(md5('9:f' || (o_orderkey % 2) || ':' || o_orderkey), 1, 8))::BIGINT % 1000000) / 1000000.0 AS u,
 (('0x' || substr(md5('9:persona:' || o_orderkey), 1, 8))::BIGINT % 1000000) / 1000000.0 AS v, (('0x' || substr(md5('9:difficulty:' || o_orderkey), 1, 8))::BIGINT % 1000000) / 1000000.0 AS x FROM orders),
q AS (SELECT c_custkey % 2 AS f, c_name AS item, row_number() OVER (PARTITION BY c_custkey % 2 ORDER BY c_name) - 1 AS place, count(*) OVER (PARTITION BY c_custkey % 2) AS n FROM customer)
SELECT id AS o_orderkey, p.path_id, q.item AS persona, CASE WHEN x < 0.2 THEN 'easy' WHEN x < 0.7 THEN 'medium' ELSE 'hard' END AS difficulty
FROM d ASOF JOIN p ON d.f = p.f AND d.u >= greatest(p.lo, 0) JOIN q ON q.f = d.f AND q.place = floor(v * q.n)""")
def whole_draw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Path, persona and difficulty for every order, over as many paths as there are events."""
    name = lambda k: F.concat(F.lit("f"), (F.col(k) % 2).cast("string")).alias("framework")
    counts = table(spark, sf_dir, "events").select(name("user_id"), F.format_string("p%012d", "event_id").alias("path_id"), (F.col("event_id") % 7).alias("n"))
    personas = table(spark, sf_dir, "customer").select(name("c_custkey"), F.col("c_name").alias("item"))
    draws = table(spark, sf_dir, "orders").select(name("o_orderkey"), F.col("o_orderkey").alias("draw_id"))
    drawn = taxonomy.uniform_pick(personas, taxonomy.draw_paths(taxonomy.probabilities(counts.select("framework", "path_id"), counts), draws, "9"), "9", "persona")
    u = X.bucket(F.lit("9"), F.lit("difficulty"), F.col("draw_id"))
    return drawn.select(F.col("draw_id").alias("o_orderkey"), "path_id", "persona", synth.drawn_difficulty({"easy": 0.2, "medium": 0.5, "hard": 0.3}, u).alias("difficulty"))


_U = "(('0x' || substr(md5({}), 1, 8))::BIGINT % 1000000) / 1000000.0"


def _round_sql(k: int) -> str:
    """Round k in SQL: draws from the paths ``p`` and counts ``c`` of the round before."""
    u, v, x = (_U.format(f"'4.{k}:{what}:' || o_orderkey") for what in ("f' || (o_orderkey % 2) || '", "node", "expand"))
    return f"""w{k} AS MATERIALIZED (SELECT f, path_id, nodes, pow(n + 1, -1.5) AS w FROM p{k}),
s{k} AS MATERIALIZED (SELECT f, path_id, nodes, sum(w / t) OVER (PARTITION BY f ORDER BY path_id) - w / t AS lo FROM w{k} JOIN (SELECT f, sum(w) AS t FROM w{k} GROUP BY 1) USING (f)),
d{k} AS MATERIALIZED (SELECT o_orderkey, o_orderkey % 2 AS f, {u} AS u, {v} AS v, {x} AS x FROM orders WHERE o_orderkey // 2 % 3 = {k}),
r{k} AS MATERIALIZED (SELECT o_orderkey, f, path_id, CASE WHEN x < 0.3 THEN list_append(nodes[1:pos], 't' || nodes[pos]) ELSE nodes END AS nodes
  FROM (SELECT o_orderkey, d.f, x, path_id, nodes, 2 + CAST(floor(v * (len(nodes) - 1)) AS BIGINT) AS pos FROM d{k} AS d ASOF JOIN s{k} AS s ON d.f = s.f AND d.u >= greatest(s.lo, 0))),
p{k + 1} AS MATERIALIZED (SELECT f, path_id, any_value(nodes) AS nodes, CAST(sum(n) AS BIGINT) AS n FROM (SELECT f, path_id, nodes, n FROM p{k} UNION ALL SELECT f, array_to_string(nodes, '→'), nodes, 0 FROM r{k}
  UNION ALL SELECT r.f, path_id, p.nodes, 1 FROM r{k} AS r JOIN p{k} AS p USING (f, path_id)) GROUP BY 1, 2)"""


@query(f"""WITH p0 AS (SELECT c_custkey % 2 AS f, array_to_string(nodes, '→') AS path_id, nodes, n FROM (SELECT c_custkey, ['root', 'n' || c_nationkey, 'c' || c_custkey] AS nodes, CAST(c_custkey % 5 AS BIGINT) AS n FROM customer)),
{", ".join(_round_sql(k) for k in range(3))}
{" UNION ALL ".join(f"SELECT o_orderkey, {k} AS round, path_id, array_to_string(nodes, '→') AS trace FROM r{k}" for k in range(3))}""")
def tag_trace_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three rounds of tag traces, one for each order, over a path a customer; what a round grows the next ones draw from."""
    name = lambda k: F.concat(F.lit("f"), (F.col(k) % 2).cast("string")).alias("framework")
    ids = F.array(F.lit("root"), F.concat(F.lit("n"), F.col("c_nationkey")), F.concat(F.lit("c"), F.col("c_custkey")))
    state = Snapshots(shared_folder(spark, "tag-traces"))
    state.commit(table(spark, sf_dir, "customer").select(name("c_custkey"), taxonomy.path_id(ids).alias("path_id"), ids.alias("node_ids"), (F.col("c_custkey") % 5).cast("long").alias("n")))
    draws = table(spark, sf_dir, "orders").select(name("o_orderkey"), F.col("o_orderkey").alias("draw_id"), (F.floor(F.col("o_orderkey") / 2) % 3).cast("int").alias("round"))
    grow = lambda rows: rows.withColumn("tag", F.concat(F.lit("t"), "parent_id"))
    traces = taxonomy.trace_rounds(state, draws, "4", 3, 0.3, grow)
    return traces.select(F.col("draw_id").alias("o_orderkey"), "round", "path_id", "trace")


@query("""SELECT doc_id, CASE WHEN u < 0.2 THEN 'easy' WHEN u < 0.7 THEN 'medium' ELSE 'hard' END AS difficulty FROM (SELECT doc_id, (('0x' || substr(md5('0:difficulty:' || doc_id), 1, 8))::BIGINT % 1000000) / 1000000.0 AS u FROM documents)""")
def difficulty_draw(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = X.bucket(F.lit("0"), F.lit("difficulty"), F.col("doc_id"))
    return table(spark, sf_dir, "documents").select("doc_id", synth.drawn_difficulty({"easy": 0.2, "medium": 0.5, "hard": 0.3}, u).alias("difficulty"))


@query("""SELECT c_custkey, array_to_string(['root', 'r', 'n' || c_nationkey, 'c' || c_custkey, 'x'][1:3 + CAST(floor(u * 3) AS BIGINT)], '→') AS path FROM (SELECT *, (('0x' || substr(md5('cut:' || c_custkey), 1, 8))::BIGINT % 1000000) / 1000000.0 AS u FROM customer)""")
def truncate_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = F.array(F.lit("root"), F.lit("r"), F.concat(F.lit("n"), F.col("c_nationkey").cast("string")), F.concat(F.lit("c"), F.col("c_custkey").cast("string")), F.lit("x"))
    return table(spark, sf_dir, "customer").select("c_custkey", taxonomy.path_id(taxonomy.truncate(ids, F.lit("cut"), F.col("c_custkey"))).alias("path"))


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    level = F.when(F.substring("o_orderpriority", 1, 1).isin("1", "2"), "easy").when(F.substring("o_orderpriority", 1, 1) == "3", "medium").otherwise("hard")
    return o.select(level.alias("difficulty"), F.col("o_orderstatus").alias("problem_type"), F.col("o_orderpriority").alias("query"), (F.col("o_orderstatus") != "F").alias("success"))


@query("""SELECT count(*) AS total, count(*) FILTER (substr(o_orderpriority, 1, 1) IN ('1', '2')) AS n_easy, count(*) FILTER (substr(o_orderpriority, 1, 1) = '3') AS n_medium, count(*) FILTER (substr(o_orderpriority, 1, 1) IN ('4', '5')) AS n_hard,
count(DISTINCT o_orderstatus) AS problem_types, round(avg(length(o_orderpriority)), 6) AS avg_length, count(*) FILTER (o_orderstatus <> 'F') AS succeeded, count(*) FILTER (o_orderstatus = 'F') AS failed FROM orders""")
def run_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.run_statistics(_records(spark, sf_dir)).withColumn("avg_length", F.round("avg_length", 6))


@query("""SELECT count(*) AS total, count(*) FILTER (o_orderstatus <> 'F') AS succeeded, count(*) FILTER (o_orderstatus = 'F') AS failed, round(count(*) FILTER (o_orderstatus <> 'F') / count(*), 6) AS rate FROM orders""")
def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.run_summary(_records(spark, sf_dir)).withColumn("rate", F.round("rate", 6))


@query("""SELECT doc_id, source FROM documents WHERE coalesce(source, 'deer-flow') IN ('src1', 'src2') ORDER BY doc_id LIMIT 20""")
def load_filter_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", "source").filter(F.coalesce("source", F.lit("deer-flow")).isin("src1", "src2"))
    return d.orderBy("doc_id").limit(20)



@query("""SELECT doc_id, unnest(['easy', 'medium', 'hard']) AS difficulty, unnest(['e' || doc_id, 'm' || doc_id, 'h' || doc_id]) AS query FROM documents""")
def parse_english_response(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("doc_id").cast("string")
    r = F.concat(F.lit("**EASY:** e"), i, F.lit("\n**MEDIUM:** m"), i, F.lit("\n**NOTE:** x\n**HARD:** h"), i, F.lit("\n"))
    return table(spark, sf_dir, "documents").select("doc_id", F.explode(X.english_queries(r)).alias("q")).select("doc_id", "q.difficulty", "q.query")


@query("""SELECT doc_id, unnest(['easy', 'hard']) AS difficulty, unnest(['甲' || doc_id, '乙' || doc_id]) AS query FROM documents""")
def parse_chinese_response(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("doc_id").cast("string")
    r = F.concat(F.lit("**简单:** 甲"), i, F.lit(" **困难:** 乙"), i)
    return table(spark, sf_dir, "documents").select("doc_id", F.explode(X.chinese_queries(r)).alias("q")).select("doc_id", "q.difficulty", "q.query")


@query("""SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events""")
def json_payload_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    body = X.json_payload(F.concat(F.lit("Answer: "), "props", F.lit(" end")))
    return e.select("event_id", F.get_json_object(body, "$.k").cast("bigint").alias("k"))


@query("""SELECT split_part(url, '/', 3) AS host, count(*) AS total_extracted, count(*) FILTER (page_id % 3 <> 0) AS accessible FROM pages GROUP BY 1""")
def url_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "pages").select("page_id", F.explode(X.urls_in(F.concat(F.lit("see "), "url", F.lit(".")))).alias("u"))
    found = p.select(F.expr("try_parse_url(u, 'HOST')").alias("host"), (F.col("page_id") % 3 != 0).alias("ok"), F.lit(None).cast("string").alias("new_url"))
    return urls.url_statistics(found, "host").select("host", "total_extracted", "accessible")


@query("""SELECT page_id, 'see ' || CASE WHEN page_id % 2 = 0 THEN 'https://new.example/' || page_id ELSE '[URL removed]' END || ' now' AS query FROM pages""")
def url_rewrite_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    change = F.array(F.struct(F.col("url"), F.when(F.col("page_id") % 2 == 0, "replace").otherwise("remove").alias("action"), F.concat(F.lit("https://new.example/"), F.col("page_id").cast("string")).alias("new_url")))
    return table(spark, sf_dir, "pages").select("page_id", X.rewrite_urls(F.concat(F.lit("see "), "url", F.lit(" now")), change).alias("query"))


@query("""WITH u AS (SELECT page_id, url, contains(url, '://ok.') OR ('0x' || substr(md5(url), 1, 8))::BIGINT % 3 <> 0 AS ok FROM pages)
SELECT page_id, 'read ' || CASE WHEN ok THEN url ELSE 'https://ok.example/' || substr(md5('# repair 0' || chr(10) || url || chr(10) || 'not accessible'), 1, 6) END AS query,
1::BIGINT AS total_extracted, ok::BIGINT AS accessible, (NOT ok)::BIGINT AS repaired, 0::BIGINT AS removed FROM u""")
def url_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "pages").select("page_id", F.concat(F.lit("read "), "url").alias("query"))
    return urls.repair_urls(p, "page_id", "query", StubProbe(), StubLLM()).select("page_id", "query", "url_stats.*")


@query("""WITH s0 AS (SELECT page_id, url, ('0x' || substr(md5(url), 1, 8))::BIGINT % 3 <> 0 AS ok, CAST(NULL AS VARCHAR) AS new_url, ('0x' || substr(md5(url), 1, 8))::BIGINT % 3 = 0 AS open, 'not accessible' AS note FROM pages),
p0 AS (SELECT *, '# repair 0' || chr(10) || url || chr(10) || note AS q FROM s0),
s1 AS (SELECT page_id, url, ok, CASE WHEN open AND ('0x' || substr(md5(q), 1, 8))::BIGINT % 4 = 1 THEN 'https://ok.example/' || substr(md5(q), 1, 6) ELSE new_url END AS new_url,
  open AND ('0x' || substr(md5(q), 1, 8))::BIGINT % 4 > 1 AS open, 'failed: http://gone.example/' || substr(md5(q), 1, 6) AS note FROM p0),
p1 AS (SELECT *, '# repair 1' || chr(10) || url || chr(10) || note AS q FROM s1),
s2 AS (SELECT page_id, url, ok, CASE WHEN open AND ('0x' || substr(md5(q), 1, 8))::BIGINT % 4 = 1 THEN 'https://ok.example/' || substr(md5(q), 1, 6) ELSE new_url END AS new_url,
  open AND ('0x' || substr(md5(q), 1, 8))::BIGINT % 4 > 1 AS open, 'failed: http://gone.example/' || substr(md5(q), 1, 6) AS note FROM p1),
p2 AS (SELECT *, '# repair 2' || chr(10) || url || chr(10) || note AS q FROM s2),
s3 AS (SELECT page_id, url, ok, CASE WHEN open AND ('0x' || substr(md5(q), 1, 8))::BIGINT % 4 = 1 THEN 'https://ok.example/' || substr(md5(q), 1, 6) ELSE new_url END AS new_url,
  open AND ('0x' || substr(md5(q), 1, 8))::BIGINT % 4 > 1 AS open, 'failed: http://gone.example/' || substr(md5(q), 1, 6) AS note FROM p2)
SELECT page_id, 'read ' || CASE WHEN ok THEN url ELSE coalesce(new_url, '[URL removed]') END AS query, 1::BIGINT AS total_extracted, ok::BIGINT AS accessible,
(NOT ok AND new_url IS NOT NULL)::BIGINT AS repaired, (NOT ok AND new_url IS NULL)::BIGINT AS removed FROM s3""")
def url_repair_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A model that refuses a quarter of the requests and suggests broken URLs for half of them: every round runs, and some URLs go."""
    p = table(spark, sf_dir, "pages").select("page_id", F.concat(F.lit("read "), "url").alias("query"))
    return urls.repair_urls(p, "page_id", "query", StubProbe(gone="://gone."), StubbornLLM()).select("page_id", "query", "url_stats.*")


@query("""SELECT page_id, CASE WHEN f = '' THEN 'download' ELSE f END AS name FROM (SELECT page_id, regexp_extract(regexp_replace(url, '[?#].*$', ''), '([^/]*)$', 1) AS f FROM pages)""")
def filename_from_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", X.file_name(F.col("url")).alias("name"))


@query("""SELECT doc_id, md5('# fuzzify' || chr(10) || 'Make this query less exact, as JSON with fuzzy_query: ' || coalesce(text, '')) AS digest FROM documents""")
def prompt_render(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(synth.prompt("fuzzify", query=F.col("text"))).alias("digest"))


@query("""SELECT doc_id, CASE WHEN lang IN ('de', 'fr') THEN source ELSE lang END AS label FROM documents""")
def language_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    language = F.when(F.col("lang").isin("de", "fr"), "zh").otherwise("english")
    return table(spark, sf_dir, "documents").select("doc_id", X.in_language(language, F.col("source"), F.col("lang")).alias("label"))


@query("""SELECT p_partkey, CASE WHEN p_brand = p_type THEN p_brand ELSE p_name || ' ' || p_brand || '|' || p_name END AS terms FROM part""")
def search_terms_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = stats.ordered_distinct(X.shorten(F.concat_ws("  ", "p_name", "p_brand")), X.shorten(F.col("p_name")), X.shorten(F.col("p_name")))
    return table(spark, sf_dir, "part").select("p_partkey", F.array_join(both, "|").alias("terms"))


@query("""SELECT conv_id, turn, turn % 3 = 0 AS suitable FROM conversations""")
def persona_suitability(spark: SparkSession, sf_dir: str) -> DataFrame:
    answer = F.when(F.col("turn") % 3 == 0, "Suitable.").when(F.col("turn") % 3 == 1, "not_suitable").otherwise("Suitable, nothing wrong")
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", X.suitable(answer).alias("suitable"))


@query("""SELECT doc_id FROM documents WHERE (('0x' || substr(md5('0:fuzzify:' || doc_id), 1, 8))::BIGINT % 1000000) / 1000000.0 < 0.3""")
def probability_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").filter(synth.gate(0.3, "0", "fuzzify", F.col("doc_id"))).select("doc_id")


@query("""SELECT r_regionkey, CASE WHEN r_regionkey % 2 = 0 THEN 'hard' ELSE '' END AS missing, r_name AS extra FROM region""")
def distribution_keys_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    want = F.array(*[F.lit(k) for k in ("easy", "medium", "hard")])
    have = F.concat(F.array(F.lit("easy"), F.lit("medium"), F.col("r_name")), F.when(F.col("r_regionkey") % 2 == 1, F.array(F.lit("hard"))).otherwise(F.expr("cast(array() as array<string>)")))
    return table(spark, sf_dir, "region").select("r_regionkey", F.array_join(F.array_except(want, have), ",").alias("missing"), F.array_join(F.array_except(have, want), ",").alias("extra"))


@query("""SELECT doc_id, lang AS a, 'right' AS b, source AS c FROM documents""")
def query_metadata_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    one = lambda *kv: F.create_map(*[x for k, v in kv for x in (F.lit(k), v)])
    m = synth.merged(one(("a", F.col("lang")), ("b", F.lit("left"))), one(("b", F.lit("right")), ("c", F.col("source"))))
    get = lambda k: F.try_element_at("m", F.lit(k)).alias(k)
    return table(spark, sf_dir, "documents").select("doc_id", m.alias("m")).select("doc_id", get("a"), get("b"), get("c"))


@query("""SELECT doc_id, md5(text) AS hash FROM documents""")
def file_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.md5("text").alias("hash"))


@query("""WITH d AS (SELECT doc_id, (('0x' || substr(md5('5:persona:' || doc_id), 1, 8))::BIGINT % 1000000) / 1000000.0 AS u, (('0x' || substr(md5('5:detail:' || doc_id), 1, 8))::BIGINT % 1000000) / 1000000.0 AS v FROM documents),
p AS (SELECT n_name AS item, row_number() OVER (ORDER BY n_name) - 1 AS place, count(*) OVER () AS n FROM nation)
SELECT doc_id, item AS persona, ['high', 'low', 'medium'][1 + CAST(floor(v * 3) AS BIGINT)] AS detail FROM d JOIN p ON place = floor(u * n)""")
def uniform_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    draws = table(spark, sf_dir, "documents").select(F.lit("o").alias("framework"), F.col("doc_id").alias("draw_id"))
    personas = table(spark, sf_dir, "nation").select(F.lit("o").alias("framework"), F.col("n_name").alias("item"))
    details = spark.createDataFrame([("o", k) for k in synth.DETAIL], "framework string, item string")
    both = taxonomy.uniform_pick(details, taxonomy.uniform_pick(personas, draws, "5", "persona"), "5", "detail")
    return both.select(F.col("draw_id").alias("doc_id"), "persona", "detail")


@query("""WITH c AS (SELECT c_custkey, c_nationkey, 'table-' || c_custkey || '.csv' AS name FROM customer)
SELECT c_custkey, CASE WHEN c_nationkey % 3 = 2 THEN 0 ELSE 1 END::BIGINT AS n_files, CASE WHEN c_nationkey % 3 <> 2 THEN name END AS name,
'base/geo/' || CASE WHEN c_nationkey % 2 = 0 THEN 'query-of-' || c_nationkey ELSE 'bundle' END || '-' || c_custkey AS folder FROM c""")
def file_plans(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, at = F.col("c_custkey").cast("string"), F.col("c_nationkey") % 3
    one = F.concat(F.lit('{"name": "'), F.when(at == 0, F.concat(F.lit("table-"), k, F.lit(".csv"))).otherwise(""), F.lit('", "url": "'), F.when(at == 2, "http://no.example/").otherwise("https://files.example/"), F.lit("table-"), k, F.lit('.csv"}'))
    plan = X.file_plan(F.concat(F.lit("Plan: {\"files\": ["), one, F.lit("]} end")))
    wanted = F.when(F.col("c_nationkey") % 2 == 0, F.concat(F.lit(" Query of "), F.col("c_nationkey").cast("string"), F.lit("!"))).otherwise("???")
    return table(spark, sf_dir, "customer").select("c_custkey", F.size(plan).cast("bigint").alias("n_files"), F.get(plan, 0)["name"].alias("name"), X.download_folder("base", F.lit("geo"), wanted, F.col("c_custkey")).alias("folder"))


def _md5_number(text: str, n: int) -> str:
    return f"(('0x' || substr(md5({text}), 1, 8))::BIGINT % {n})"


def _search_sql(term: str) -> str:
    lines = " || chr(10) || ".join(f"'{i + 1}. ' || substr({term}, 1, 40) || ' {i} - about ' || substr({term}, 1, 40) || ' (https://site{i}.example/' || {_md5_number(term, 1000)} || ')'" for i in range(5))
    return f"'Search: ' || {term} || chr(10) || {lines}"


def _short_sql(text: str) -> str:
    flat = f"trim(regexp_replace({text}, '\\s+', ' ', 'g'))"
    return f"CASE WHEN length({flat}) <= 80 THEN {flat} ELSE rtrim(regexp_extract({flat}, '^(.{{0,77}}) ', 1)) || '...' END"


#: Every stage in SQL: the stub services answer by the md5 of their prompts.
_SYNTHESIS = f"""WITH a AS (SELECT c_custkey AS id, n_name AS problem_type, c_mktsegment || ' ' || c_name AS persona0 FROM customer JOIN nation ON c_nationkey = n_nationkey),
b AS (SELECT *, {_md5_number("'# suitability' || chr(10) || 'Persona: ' || persona0 || chr(10) || 'Framework: geo' || chr(10) || 'Answer SUITABLE or NOT_SUITABLE.'", 4)} = 0 AS rewritten,
  substr(md5('# rewrite' || chr(10) || 'Rewrite this persona so that it fits geo: ' || persona0), 1, 6) AS tag FROM a),
c AS (SELECT *, CASE WHEN rewritten THEN '**EASY:** question ' || tag || ' one' || chr(10) || '**MEDIUM:** question ' || tag || ' two' || chr(10) || '**HARD:** question ' || tag || ' three' ELSE persona0 END AS persona,
  {_md5_number("'0:search:' || id", 1000000)} / 1000000.0 < 0.3 AS used_web_search, {_md5_number("'0:difficulty:' || id", 1000000)} / 1000000.0 AS u FROM b),
d AS (SELECT *, {_short_sql("problem_type || ' ' || persona")} AS term1, {_short_sql("problem_type")} AS term2, CASE WHEN u < 0.2 THEN 'easy' WHEN u < 0.7 THEN 'medium' ELSE 'hard' END AS difficulty FROM c),
e AS (SELECT *, CASE WHEN used_web_search THEN {_search_sql("term1")} || chr(10) || chr(10) || {_search_sql("term2")} ELSE '' END AS search_context FROM d),
f AS (SELECT *, 'question ' || substr(md5('# queries' || chr(10) || 'Persona: ' || persona || chr(10) || 'Problem type: ' || problem_type || chr(10) || 'Tools: search, lookup' || chr(10) || search_context || chr(10) || 'Write one EASY, one MEDIUM and one HARD query.'), 1, 6)
  || CASE difficulty WHEN 'easy' THEN ' one' WHEN 'medium' THEN ' two' ELSE ' three' END AS asked FROM e),
g AS (SELECT *, '# files' || chr(10) || 'Does this query need local files? JSON with requires_files, reason, required_items: ' || asked AS p FROM f),
h AS (SELECT *, {_md5_number("p", 3)} = 0 AS needs, 'table-' || substr(md5(p), 1, 6) AS item FROM g),
i AS (SELECT *, substr(md5('# plan' || chr(10) || 'Which public files does this query need? JSON with files (name, url, description): ' || asked || chr(10) || 'Items: ' || item), 1, 6) AS file FROM h),
j AS (SELECT *, CASE WHEN needs AND {_md5_number("'https://files.example/' || file || '.csv'", 5)} <> 0
  THEN 'use the files of ' || substr(md5('# with files' || chr(10) || 'Rewrite this query so that it uses these files, as JSON with query: ' || asked || chr(10) || 'Files: downloads/geo/' || replace(asked, ' ', '-') || '-' || id || '/table-' || file || '.csv'), 1, 6) ELSE asked END AS exact,
  {_md5_number("'0:fuzzify:' || id", 1000000)} / 1000000.0 < 0.3 AS fuzzified FROM i)
SELECT CASE WHEN fuzzified THEN 'something about ' || substr(md5('# fuzzify' || chr(10) || 'Make this query less exact, as JSON with fuzzy_query: ' || exact), 1, 6) ELSE exact END AS query, difficulty, problem_type, 'root→' || problem_type AS trace_context, 'geo' AS framework,
  needs AS requires_local_files, used_web_search, fuzzified, CASE WHEN fuzzified THEN exact END AS original_query,
  '{{"persona_was_rewritten":' || rewritten || CASE WHEN needs THEN ',"file_requirement_reason":"stub","file_required_items":["' || item || '"]' ELSE '' END || ',"source":"synth"}}' AS metadata FROM j"""


@query(_SYNTHESIS)
def synthesised_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    draws = d.select(F.col("c_custkey").alias("draw_id"), F.lit("geo").alias("framework"), F.concat_ws(" ", "c_mktsegment", "c_name").alias("persona"), F.col("n_name").alias("problem_type"), F.array(F.lit("root"), F.col("n_name")).alias("trace_context"), F.lit("search, lookup").alias("capabilities"))
    return synth.query_records(synth.synthesise(draws)).withColumn("trace_context", taxonomy.path_id(F.col("trace_context")))


@query(f"""WITH {_NODES},
all_nodes AS (SELECT 'geo' AS framework, 'root' AS id, NULL AS parent_id, 'World' AS en, '世界' AS zh, 0 AS sib_pos UNION ALL SELECT 'geo', 'r' || r_regionkey, 'root', r_name, r_name, r_regionkey FROM region UNION ALL SELECT 'geo', 'n' || n_nationkey, 'r' || n_regionkey, n_name, n_name, n_nationkey FROM nation),
p AS (SELECT string_split(ids, '→') AS ids, row_number() OVER (ORDER BY string_split(ids, '→')) - 1 AS place, count(*) OVER () AS n FROM paths),
d AS (SELECT r_regionkey AS draw, (('0x' || substr(md5('3:path:' || r_regionkey), 1, 8))::BIGINT % 1000000) / 1000000.0 AS u, (('0x' || substr(md5('3:node:' || r_regionkey), 1, 8))::BIGINT % 1000000) / 1000000.0 AS v FROM region),
k AS (SELECT draw, ids[2 + CAST(floor(v * (len(ids) - 1)) AS BIGINT)] AS parent_id FROM d JOIN p ON place = floor(u * n)),
t AS (SELECT parent_id, substr(md5('# tag' || chr(10) || 'Suggest a new tag under ' || parent_id || '; siblings: ' || draw || '. JSON with id, en, zh.'), 1, 6) AS tag FROM k),
l AS (SELECT parent_id, max(sib_pos) AS last FROM all_nodes GROUP BY 1),
f AS (SELECT DISTINCT t.parent_id || '_' || tag AS id, t.parent_id, 'Tag ' || tag AS en, '标签 ' || tag AS zh FROM t)
SELECT framework, id, parent_id, en, zh, CAST(sib_pos AS INTEGER) AS sib_pos FROM all_nodes
UNION ALL SELECT 'geo', f.id, f.parent_id, f.en, f.zh, CAST(coalesce(l.last, -1) + row_number() OVER (PARTITION BY f.parent_id ORDER BY f.id) AS INTEGER) FROM f LEFT JOIN l ON l.parent_id = f.parent_id""")
def taxonomy_expansion(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = _nodes(spark, sf_dir)
    draws = table(spark, sf_dir, "region").select(F.lit("geo").alias("framework"), F.col("r_regionkey").alias("draw_id"))
    parents = taxonomy.expansion_parents(taxonomy.paths(n), draws, "3")
    answered = ask(parents, synth.prompt("tag", parent_id=F.col("parent_id"), siblings=F.col("draw_id")), StubLLM(), "answer")
    new = answered.withColumn("t", X.new_tag(F.col("answer"), F.col("parent_id"))).filter("t is not null").select("framework", "t.id", "parent_id", "t.en", "t.zh")
    return taxonomy.add_children(n, new)
