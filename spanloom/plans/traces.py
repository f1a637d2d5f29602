"""Queries over spans, conversations and tool calls."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import calls, dialects, quality, spans, stats
from ..sources import sinks
from .base import EVENT_SPANS, Registry, event_spans, table

query = Registry()


@query(f"""WITH {EVENT_SPANS}, g AS (SELECT *, coalesce(parent_id, span_id) AS k FROM spans WHERE span_type = 'GENERATION' AND contains(span_name, 'OpenAI-generation')),
r AS (SELECT *, row_number() OVER (PARTITION BY trace_id, k ORDER BY start_time_s DESC, line_no DESC) AS rn, min(line_no) OVER (PARTITION BY trace_id, k) AS first_line FROM g)
SELECT trace_id, span_id, parent_id, start_time_s, first_line FROM r WHERE rn = 1""")
def last_generation_per_parent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spans.last_generation_per_parent(event_spans(spark, sf_dir)).select("trace_id", "span_id", "parent_id", "start_time_s", "first_line")


@query("""SELECT conv_id, max(turn) AS turn, arg_max(text, turn) AS content FROM conversations WHERE role = 'assistant' GROUP BY conv_id""")
def last_assistant_message(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations").filter("role = 'assistant'")
    return c.groupBy("conv_id").agg(F.max(F.struct("turn", "text")).alias("m")).select("conv_id", "m.turn", F.col("m.text").alias("content"))


@query("""SELECT conv_id, count(*) AS n_messages, arg_max(role, turn) AS last_role, string_agg(role || ': ' || text, chr(10) ORDER BY turn) AS content FROM conversations GROUP BY conv_id""")
def conversation_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = spans.flatten_messages(table(spark, sf_dir, "conversations"), ["conv_id"], "turn")
    lines = F.transform("messages", lambda m: F.concat(m["role"], F.lit(": "), m["content"]))
    return flat.select("conv_id", "n_messages", "last_role", F.array_join(lines, "\n").alias("content"))


@query("""SELECT n.n_name AS span_name, CASE WHEN r.r_regionkey IS NOT NULL THEN r.r_name END AS parent_name FROM nation n LEFT JOIN region r ON n.n_regionkey = r.r_regionkey""")
def parent_name_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    child = table(spark, sf_dir, "nation").select(F.lit("t").alias("trace_id"), F.col("n_name").alias("span_name"), F.col("n_regionkey").cast("string").alias("parent_id"))
    index = table(spark, sf_dir, "region").select(F.lit("t").alias("trace_id"), F.col("r_regionkey").cast("string").alias("span_id"), F.col("r_name").alias("span_name"), F.col("r_regionkey").alias("line_no"))
    return spans.with_parent_name(child, index).select("span_name", "parent_name")


@query("""WITH a AS (SELECT DISTINCT n_name AS agent_name FROM nation WHERE n_nationkey % 2 = 0),
s AS (SELECT s_suppkey, CASE WHEN s_suppkey % 3 = 0 THEN lower(n_name) ELSE n_name END AS parent_name FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey)
SELECT s_suppkey, CASE WHEN e.agent_name IS NOT NULL THEN parent_name ELSE coalesce(l.agent_name, parent_name) END AS agent_name
FROM s LEFT JOIN a e ON e.agent_name = parent_name LEFT JOIN a l ON lower(l.agent_name) = lower(parent_name)""")
def agent_resolution_ci(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    s = table(spark, sf_dir, "supplier").join(n, F.col("s_nationkey") == F.col("n_nationkey"), "left")
    s = s.select("s_suppkey", F.when(F.col("s_suppkey") % 3 == 0, F.lower("n_name")).otherwise(F.col("n_name")).alias("parent_name"))
    return spans.resolve_agent(s, n.filter("n_nationkey % 2 = 0").select(F.col("n_name").alias("agent_name"))).select("s_suppkey", "agent_name")


@query("""SELECT event_id, CASE WHEN event_type = 'error' THEN NULL WHEN event_type = 'signup' THEN 'meta' ELSE event_type END AS agent_name FROM events WHERE event_type <> 'signup'""")
def drop_meta_null_safe(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("event_id", F.when(F.col("event_type") == "signup", "meta").when(F.col("event_type") != "error", F.col("event_type")).alias("agent_name"))
    return spans.drop_meta(e)


@query("""SELECT CASE WHEN role = 'system' THEN 'unknown' ELSE role END AS agent_name, count(*) AS n FROM conversations GROUP BY 1""")
def agent_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.agent_distribution(table(spark, sf_dir, "conversations").select(F.when(F.col("role") != "system", F.col("role")).alias("agent_name")))


@query("""SELECT event_id, CAST(strftime(ts, '%Y%m%d%H') AS BIGINT) AS created_hour FROM events""")
def created_hour_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = event_spans(spark, sf_dir)
    return e.select(F.col("line_no").alias("event_id"), X.created_hour(F.col("start_time_s")).alias("created_hour"))


def _tool_message(c: DataFrame) -> DataFrame:
    """``conversations`` whose text ends with one call named after the role."""
    call = F.concat(F.lit("<tool_use><tool_name>"), "role", F.lit("</tool_name><parameter><turn>"), F.col("turn").cast("string"), F.lit("</turn><conv>"), F.col("conv_id").cast("string"), F.lit("</conv></parameter></tool_use>"))
    return c.select("conv_id", "turn", "role", F.concat(F.lit("before "), call).alias("content"))


@query("""SELECT conv_id, turn, 'before' AS clean_content, role AS name, '{"turn": "' || turn || '", "conv": "' || conv_id || '"}' AS arguments,
'call_' || md5(conv_id || ':' || turn || ':0') AS id FROM conversations""")
def tool_call_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = calls.extract_calls(_tool_message(table(spark, sf_dir, "conversations")), keys=("conv_id", "turn"))
    return made.select("conv_id", "turn", "clean_content", F.explode("tool_calls").alias("c")).select("conv_id", "turn", "clean_content", "c.name", "c.arguments", "c.id")


@query("""SELECT conv_id, turn, '<tool_use><tool_name>' || role || '</tool_name>' || CASE WHEN turn % 2 = 0 THEN '</tool_use>' ELSE '' END || CASE WHEN turn % 2 = 1 THEN '</tool_use>' ELSE '' END AS content FROM conversations""")
def restore_closing_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations")
    cut = F.concat(F.lit("<tool_use><tool_name>"), "role", F.lit("</tool_name>"), F.when(F.col("turn") % 2 == 0, "</tool_use>").otherwise(""))
    return c.select("conv_id", "turn", X.restore_closing_tags(cut).alias("content"))


@query("""SELECT conv_id, turn, 'role' AS k, role AS v FROM conversations UNION ALL SELECT conv_id, turn, 'turn', CAST(turn AS VARCHAR) FROM conversations""")
def xml_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations")
    body = F.concat(F.lit("<role> "), "role", F.lit(" </role><turn>"), F.col("turn").cast("string"), F.lit("</turn>"))
    return c.select("conv_id", "turn", F.explode(X.xml_params(body)).alias("p")).select("conv_id", "turn", "p.k", "p.v")


@query("""WITH c AS (SELECT conv_id, turn, role, CAST(role = 'assistant' AS INT) AS call, CAST(role = 'user' AND turn > 0 AS INT) AS res FROM conversations),
n AS (SELECT *, sum(res) OVER w AS r, sum(call) OVER w AS p, row_number() OVER (PARTITION BY conv_id, call ORDER BY turn) AS nth FROM c WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
d AS (SELECT *, greatest(0, max(CASE WHEN res = 1 THEN r - p END) OVER (PARTITION BY conv_id ORDER BY turn)) AS short FROM n),
x AS (SELECT *, coalesce(lag(short) OVER (PARTITION BY conv_id ORDER BY turn), 0) AS was FROM d)
SELECT x.conv_id, x.turn, 'call-' || a.turn AS tool_call_id, 'lookup' AS name FROM x JOIN n a ON a.conv_id = x.conv_id AND a.call = 1 AND a.nth = x.r - x.short
WHERE x.res = 1 AND x.short = coalesce(x.was, 0)""")
def tool_result_pairing(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations")
    result = (F.col("role") == "user") & (F.col("turn") > 0)
    body = F.concat(F.lit("Tool execution results:<tool_result><tool_name>lookup</tool_name><result>"), F.col("turn").cast("string"), F.lit("</result></tool_result>"))
    call = F.array(F.struct(F.concat(F.lit("call-"), F.col("turn").cast("string")).alias("id"), F.lit("lookup").alias("name")))
    m = c.select("conv_id", "turn", F.struct("turn", "role", F.when(result, body).otherwise(F.lit("-")).alias("content"), F.when(F.col("role") == "assistant", call).alias("tool_calls")).alias("m"))
    ms = m.groupBy("conv_id").agg(F.sort_array(F.collect_list("m")).alias("ms"))
    done = ms.select("conv_id", F.explode(calls.pair_results(F.col("ms"))).alias("x")).filter("x.role = 'tool'")
    known = done.select("conv_id", F.col("x.content").cast("bigint").alias("turn"), "x.tool_call_id", "x.name")
    return known.filter("tool_call_id like 'call-%'")


@query("""WITH c AS (SELECT conv_id, turn, role, CAST(role = 'assistant' AS INT) AS call, CAST(role = 'user' AND turn > 0 AS INT) AS res FROM conversations),
n AS (SELECT *, sum(res) OVER w AS r, sum(call) OVER w AS p, row_number() OVER (PARTITION BY conv_id, call ORDER BY turn) AS nth FROM c WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
d AS (SELECT *, greatest(0, max(CASE WHEN res = 1 THEN r - p END) OVER (PARTITION BY conv_id ORDER BY turn)) AS short FROM n),
x AS (SELECT *, coalesce(lag(short) OVER (PARTITION BY conv_id ORDER BY turn), 0) AS was FROM d)
SELECT x.conv_id, x.turn, x.role, CASE WHEN x.res = 1 AND x.short = coalesce(x.was, 0) THEN 'call-' || a.turn WHEN x.res = 1 THEN 'call_' || md5(x.turn || ':0:lookup') END AS tool_call_id
FROM (SELECT * REPLACE (CASE WHEN res = 1 THEN 'tool' ELSE role END AS role) FROM x) x LEFT JOIN n a ON a.conv_id = x.conv_id AND a.call = 1 AND a.nth = x.r - x.short""")
def tool_result_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results paired with pending calls row by row; those without a pending call get an id of their place."""
    c = table(spark, sf_dir, "conversations")
    result = (F.col("role") == "user") & (F.col("turn") > 0)
    body = F.concat(F.lit("Tool execution results:<tool_result><tool_name>lookup</tool_name><result>"), F.col("turn").cast("string"), F.lit("</result></tool_result>"))
    call = F.array(F.struct(F.concat(F.lit("call-"), F.col("turn").cast("string")).alias("id"), F.lit("lookup").alias("name")))
    m = c.select("conv_id", F.col("turn").alias("at"), "role", F.when(result, body).otherwise(F.lit("-")).alias("content"), F.when(F.col("role") == "assistant", call).alias("tool_calls"))
    return calls.paired_rows(m, ["conv_id"]).select("conv_id", F.col("at").alias("turn"), "role", "tool_call_id")


@query("""SELECT doc_id, md5(text || chr(10)) AS digest FROM documents""")
def system_prompt_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    text = F.concat("text", F.lit("\n<TOOL_DEFINITIONS_START>tools<TOOL_DEFINITIONS_END><SUB_AGENTS_DEFINITIONS_START>a\nb<SUB_AGENTS_DEFINITIONS_END><TOOL_USAGE_INSTRUCTIONS_START>u<TOOL_USAGE_INSTRUCTIONS_END>"))
    return d.select("doc_id", F.md5(X.clean_system_prompt(text)).alias("digest"))


@query("""SELECT l_suppkey AS agent, count(*) AS n_tools, sum(p_size)::BIGINT AS total_size, min(p_name) AS first_name FROM (SELECT DISTINCT l_suppkey, l_partkey FROM lineitem) JOIN part ON p_partkey = l_partkey GROUP BY 1""")
def tool_definition_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("agent"), F.col("l_partkey").alias("name"))
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("tool"), "p_name", "p_size")
    parts = 16 * li.rdd.getNumPartitions()  # a split of the file system is bounded, and so is a sixteenth of it
    return calls.agent_tools(li, p, "agent", "name", "tool", parts).groupBy("agent").agg(F.count(F.lit(1)).alias("n_tools"), F.sum("p_size").alias("total_size"), F.min("p_name").alias("first_name"))


@query("""SELECT c_nationkey AS src, s_nationkey AS dst, count(*) AS n FROM (SELECT DISTINCT c_nationkey FROM customer) c JOIN (SELECT DISTINCT s_nationkey, s_suppkey FROM supplier) s ON s_suppkey % 25 = c_nationkey
WHERE c_nationkey % 5 <> 0 AND s_nationkey % 5 <> 0 GROUP BY 1, 2""")
def workflow_successors(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("id"), F.when(F.col("n_nationkey") % 5 == 0, "tool").otherwise("agent").alias("type"))
    src = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("src")).distinct()
    e = table(spark, sf_dir, "supplier").select((F.col("s_suppkey") % 25).cast("int").alias("src"), F.col("s_nationkey").alias("dst")).join(src, "src")
    return calls.workflow_successors(e, n).groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT l_partkey AS tool_name, count(*) AS n FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 25) GROUP BY 1""")
def unregistered_tools(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("tool_name"))
    p = table(spark, sf_dir, "part").filter("p_size > 25").select(F.col("p_partkey").alias("tool_name"))
    return calls.unregistered_tools(li, p).groupBy("tool_name").agg(F.count(F.lit(1)).alias("n"))


_XML_CASES = """CASE turn % 4 WHEN 0 THEN '<tool_use><tool_name>a</tool_name><parameter><q>' || conv_id || '</q></parameter></tool_use>'
WHEN 1 THEN '<tool_use><tool_name>a</tool_name></tool_use>' WHEN 2 THEN '<tool_use>' ELSE 'plain' END"""


@query(f"""SELECT conv_id, turn FROM (SELECT *, {_XML_CASES} AS content FROM conversations) WHERE role <> 'assistant' OR turn % 4 IN (0, 3)""")
def xml_valid_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations").withColumn("content", F.expr(_XML_CASES))
    return quality.message_errors(c, "full").filter(F.size("errors") == 0).select("conv_id", "turn")


@query(f"""SELECT count(*) AS total, count(*) FILTER (turn % 4 IN (0, 3)) AS valid, count(*) FILTER (turn % 4 NOT IN (0, 3)) AS invalid FROM conversations""")
def xml_filter_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations").withColumn("content", F.expr(_XML_CASES))
    line = F.to_json(F.struct(F.array(F.struct(F.lit("assistant").alias("role"), F.col("content"))).alias("messages")))
    return quality.filter_statistics(quality.filter_valid(c.select(line.alias("line"))))


@query("""SELECT doc_id, count(*) AS n_words, CAST(sum(last) AS BIGINT) AS places FROM (SELECT doc_id, w, max(i) AS last FROM (SELECT doc_id, unnest(string_split(text, ' ')) AS w, generate_subscripts(string_split(text, ' '), 1) AS i FROM documents) GROUP BY doc_id, w) GROUP BY doc_id""")
def last_place_of_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each document's words the last place, within its row."""
    words = F.transform(F.split("text", " "), lambda w, i: F.struct(w.alias("k"), (i + 1).alias("v")))
    last = F.map_values(stats.last_of_each(words))
    d = table(spark, sf_dir, "documents").filter("text is not null").select("doc_id", last.alias("last"))
    return d.select("doc_id", F.size("last").cast("long").alias("n_words"), F.aggregate("last", F.lit(0).cast("long"), lambda a, v: a + v).alias("places"))


#: Fixed values in SQL: what a tag's name holds, and the elements that need no closer.
_TAG_NAME = r"[A-Za-z\x{4e00}-\x{9fff}][\p{L}\p{N}_:-]*"
_TAG_STACK = rf"""WITH RECURSIVE t AS (SELECT page_id, list_filter(regexp_extract_all(regexp_replace(coalesce(html, ''), '(?s)<!--.*?-->', '', 'g'), '</?{_TAG_NAME}(?:>|/>|\s[^>]*>)'),
  lambda x: NOT regexp_full_match(x, '</?{_TAG_NAME}/>') AND NOT (x NOT LIKE '</%' AND lower(regexp_extract(x, '^<({_TAG_NAME})', 1)) IN ('br', 'img', 'hr', 'input', 'meta', 'link'))) AS tags FROM pages),
n AS (SELECT page_id, list_transform(tags, lambda x: x LIKE '</%') AS closer, list_transform(tags, lambda x: regexp_extract(x, '^</?({_TAG_NAME})', 1)) AS name FROM t),
w(page_id, place, waiting, errors) AS (SELECT page_id, 1, []::VARCHAR[], 0 FROM n
  UNION ALL SELECT page_id, place + 1, CASE WHEN NOT closer[place] THEN list_append(waiting, name[place]) ELSE waiting[1:len(waiting) - 1] END, errors + CASE WHEN closer[place] AND waiting[-1] IS DISTINCT FROM name[place] THEN 1 ELSE 0 END FROM w JOIN n USING (page_id) WHERE place <= len(name))
SELECT page_id, CAST(errors + len(waiting) AS BIGINT) AS n_errors FROM w JOIN n USING (page_id) WHERE place = len(name) + 1"""


@query(_TAG_STACK)
def tag_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "pages")
    return quality.tag_balance(p, "page_id", "html").select("page_id", "n_errors")


@query("""SELECT page_id, len(regexp_extract_all(html, '<p>'))::BIGINT AS opened, len(regexp_extract_all(html, '</p>'))::BIGINT AS closed FROM pages""")
def tag_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "pages")
    return p.select("page_id", X.occurrences(F.col("html"), "<p>").cast("long").alias("opened"), X.occurrences(F.col("html"), "</p>").cast("long").alias("closed"))


_DIALECT_SQL = {
    "qwen": "'<tool_call>' || chr(10) || '<function=' || role || '>' || chr(10) || '<parameter=turn>' || turn || '</parameter>' || chr(10) || '<parameter=conv>' || conv_id || '</parameter>' || chr(10) || '</function>' || chr(10) || '</tool_call>'",
    "minimax": "'<invoke name=' || role || '>' || chr(10) || '<parameter name=turn>' || turn || '</parameter>' || chr(10) || '<parameter name=conv>' || conv_id || '</parameter>' || chr(10) || '</invoke>'",
    "glm": "'<tool_call>' || role || chr(10) || '<arg_key>turn</arg_key>' || chr(10) || '<arg_value>' || turn || '</arg_value>' || chr(10) || '<arg_key>conv</arg_key>' || chr(10) || '<arg_value>' || conv_id || '</arg_value>' || chr(10) || '</tool_call>'",
    "openrouter": "'<' || role || '>' || chr(10) || '<turn>' || turn || '</turn>' || chr(10) || '<conv>' || conv_id || '</conv>' || chr(10) || '</' || role || '>'",
    "deepseek": "'<｜tool▁calls▁begin｜><｜tool▁call▁begin｜>' || role || '<｜tool▁sep｜>{\"turn\": \"' || turn || '\", \"conv\": \"' || conv_id || '\"}<｜tool▁call▁end｜><｜tool▁calls▁end｜>'",
}


def _dialect(name: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        said = _tool_message(table(spark, sf_dir, "conversations")).withColumn("role", F.lit("assistant"))
        return dialects.rewrite_messages(said, name).select("conv_id", "turn", "content")

    return run


for _name, _sql in _DIALECT_SQL.items():
    query(f"SELECT conv_id, turn, 'before ' || {_sql} AS content FROM conversations", f"dialect_{_name}")(_dialect(_name))


@query(f"""SELECT conv_id, turn, role, 'before ' || CASE WHEN role = 'user' THEN '<tool_use><tool_name>' || role || '</tool_name><parameter><turn>' || turn || '</turn><conv>' || conv_id || '</conv></parameter></tool_use>' ELSE {_DIALECT_SQL['qwen']} END AS content FROM conversations""")
def dialect_message_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dialects.rewrite_messages(_tool_message(table(spark, sf_dir, "conversations")), "qwen")


@query("""SELECT conv_id, turn, role, text, 'q' AS query, 'deer-flow' AS framework, '' AS stop FROM conversations""")
def enrich_constants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sinks.with_constants(table(spark, sf_dir, "conversations"), query="q", framework="deer-flow", stop="")


@query("""SELECT user_id, count(*) AS n, min(event_id) AS first_id FROM events WHERE ts >= TIMESTAMP '2024-01-05' AND ts <= TIMESTAMP '2024-01-12' GROUP BY user_id""")
def trace_time_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").filter("ts >= timestamp_ntz'2024-01-05' and ts <= timestamp_ntz'2024-01-12'")
    return e.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.min("event_id").alias("first_id"))


@query("""SELECT status, count(*) AS n FROM (SELECT CASE WHEN l.doc_id IS NOT NULL THEN 'exists' WHEN event_type = 'error' THEN 'failed' WHEN event_type = 'signup' THEN 'skipped' ELSE 'saved' END AS status
FROM events e LEFT JOIN labels l ON l.doc_id = e.event_id) GROUP BY 1""")
def download_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").join(table(spark, sf_dir, "labels").select(F.col("doc_id").alias("event_id"), F.lit(True).alias("there")), "event_id", "left")
    status = F.when(F.col("there"), "exists").when(F.col("event_type") == "error", "failed").when(F.col("event_type") == "signup", "skipped").otherwise("saved")
    return stats.outcome_counts(e.select(status.alias("status")))


@query("""SELECT doc_id, lang FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""")
def processed_antijoin(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sinks.not_done(table(spark, sf_dir, "documents").select("doc_id", "lang"), table(spark, sf_dir, "labels"), "doc_id")


@query("""SELECT page_id, CASE WHEN s = '' THEN 'unnamed_trace' ELSE s END AS name FROM (SELECT page_id, substr(regexp_replace(regexp_replace(url, '[^\\p{L}\\p{N}_.-]+', '_', 'g'), '^[._]+|[._]+$', '', 'g'), 1, 100) AS s FROM pages)""")
def sanitize_trace_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", X.trace_name(F.col("url")).alias("name"))


@query("""SELECT user_id, event_type, round(sum(value), 6) AS seconds, round(sum(value) * 100 / sum(sum(value)) OVER (PARTITION BY user_id), 6) AS percent FROM events GROUP BY user_id, event_type""")
def timing_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = stats.timing_share(table(spark, sf_dir, "events"), "user_id", "event_type", "value")
    return t.select("user_id", "event_type", F.round("seconds", 6).alias("seconds"), F.round("percent", 6).alias("percent"))


@query("""SELECT c_custkey, row_number() OVER (ORDER BY c_acctbal, c_custkey) AS number FROM customer""")
def sequential_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.numbered(table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal"), "c_acctbal", "c_custkey").select("c_custkey", "number")
