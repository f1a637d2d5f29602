"""One query per training-data operator, over whole tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .centroids import cluster_centroids
from .common import held_out, load
from .conversation_repair import repair_conversations
from .decontaminate import contaminated, matches
from .exact_dedup import exact_report
from .html_extract import extract_main_text
from .language_id import fit_language_model, identify_language
from .line_dedup import dedup_lines
from .packing import pack_documents
from .quality import fit_quality_model, score_quality
from .quality_rules import apply_rules, fit_ratio_model
from .simhash import simhash_components
from .toxicity import fit_toxicity_model, score_toxicity
from .warc import build_derivatives, responses

#: Tokens in a packed sequence.
CAPACITY = 2048


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """Place of a public tokenizer file on this machine; executors have the same files installed."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    model = fit_toxicity_model(docs, load(spark, sf_dir, "labels").filter(~held_out("doc_id")))
    found = score_toxicity(docs.select("doc_id", held_out("doc_id").alias("held_out"), "text"), model, threshold=0.7)
    return found.select("doc_id", "held_out", "score", "predicted", "n_matches")


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(load(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    model = fit_quality_model(docs, load(spark, sf_dir, "labels").filter(~held_out("doc_id")))
    found = score_quality(docs.select("doc_id", held_out("doc_id").alias("held_out"), "text"), model, threshold=0.5)
    return found.select("doc_id", "held_out", "score", "predicted")


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(load(spark, sf_dir, "documents"), tokenizer_path(), capacity=CAPACITY)


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(load(spark, sf_dir, "documents"), min_words=50, count_col="n_chars").select("doc_id", "lines_removed", "n_chars", "text")


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(load(spark, sf_dir, "documents"), radius=4, shingle=4, seed=42)


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_report(load(spark, sf_dir, "documents"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    model = fit_language_model(docs.filter(~held_out("doc_id")))
    found = identify_language(docs.select("doc_id", held_out("doc_id").alias("held_out"), "text"), model)
    return found.select("doc_id", "held_out", "lang_pred", "score", "lang_accepted")


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = matches(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))
    return found.select(
        F.col("__id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), contaminated().alias("contaminated"),
    )


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = build_derivatives(responses(load(spark, sf_dir, "pages")).select("page_id", "record"))
    return made.withColumn("record_sha256", F.sha2("record", 256)).drop("record")


def op11_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit_ratio_model(docs, load(spark, sf_dir, "labels").filter(~held_out("doc_id")), most=8000)  # as the SQL has it
    return apply_rules(docs, model).drop("text")


def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster_centroids(load(spark, sf_dir, "embeddings"), k=16, rounds=3, size=64)


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_conversations(load(spark, sf_dir, "conversations"))


_OP5_SQL = r"""
WITH l AS (
  SELECT doc_id, i, line, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS words,
         row_number() OVER (PARTITION BY doc_id ORDER BY i) AS pos
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
), c AS (SELECT *, sum(words) OVER (PARTITION BY doc_id ORDER BY pos) AS upto FROM l),
fwd AS (SELECT a.doc_id, a.pos AS p, min(b.pos) AS e FROM c a JOIN c b ON a.doc_id = b.doc_id AND b.pos >= a.pos AND b.upto - a.upto + a.words >= 50 GROUP BY 1, 2),
bwd AS (SELECT b.doc_id, max(a.pos) AS p, b.pos AS e FROM c a JOIN c b ON a.doc_id = b.doc_id AND b.pos >= a.pos AND b.upto - a.upto + a.words >= 50 GROUP BY b.doc_id, b.pos),
w AS (SELECT * FROM fwd UNION SELECT * FROM bwd),
g AS (SELECT w.doc_id, p, e, string_agg(line, chr(10) ORDER BY pos) AS body FROM w JOIN c ON c.doc_id = w.doc_id AND c.pos BETWEEN p AND e GROUP BY 1, 2, 3),
f AS (SELECT *, row_number() OVER u AS nth, first_value(doc_id) OVER u AS first_id, first_value(e) OVER u AS first_end FROM g WINDOW u AS (PARTITION BY body ORDER BY doc_id, p)),
gone AS (SELECT DISTINCT c.doc_id, c.i FROM f JOIN c ON c.doc_id = f.doc_id AND c.pos BETWEEN p AND e WHERE nth > 1 AND (c.doc_id <> first_id OR c.pos > first_end)),
kept AS (
  SELECT doc_id, string_agg(line, chr(10) ORDER BY i) AS text
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents) ANTI JOIN gone USING (doc_id, i)
  GROUP BY 1
), n AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY 1)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS INTEGER) AS lines_removed,
       CASE WHEN d.text IS NOT NULL THEN length(coalesce(kept.text, '')) END AS n_chars, CASE WHEN d.text IS NOT NULL THEN coalesce(kept.text, '') END AS text
FROM documents d LEFT JOIN kept USING (doc_id) LEFT JOIN n USING (doc_id)
"""

_OP7_SQL = r"""
WITH t AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS h FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY h) AS keep_id, count(*) OVER (PARTITION BY h) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY h) AS kept, h AS text_sha256
FROM t
"""

_OP9_SQL = r"""
WITH b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bn AS (SELECT item_id, w, least(len(w), 13) AS n FROM b WHERE len(w) > 0),
g AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS gram FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS i FROM bn)),
d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
p AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS gram FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM g) WHERE len(w) >= n)),
m AS (SELECT doc_id, i, n, item_id FROM p JOIN g USING (n, gram)),
h AS (SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS pos FROM m) GROUP BY 1),
s AS (SELECT doc_id, count(*) AS n_items, sha256(string_agg(item_id, ',' ORDER BY item_id)) AS h FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM m) GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       coalesce(s.h, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN s USING (doc_id)
"""


#: CRC-32 in SQL: its table of bytes, and of a text's UTF-8 bytes in hexadecimal.
_CRC_TABLE = "crc AS MATERIALIZED (SELECT list(c ORDER BY n) AS t FROM (SELECT n, list_reduce(range(8), lambda a, k: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END, n) AS c FROM range(256) AS r(n)))"


def _crc(text: str) -> str:
    digit = "strpos('0123456789ABCDEF', hex(encode({0}))[{1}])".format
    byte = f"({digit(text, 'i')} - 1) * 16 + {digit(text, 'i + 1')} - 1"
    return f"xor(list_reduce(list_transform(range(1, 2 * octet_length(encode({text})) + 1, 2), lambda i: {byte}), lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1]), 4294967295), 4294967295)"


_OP11_SQL = rf"""
WITH {_CRC_TABLE},
d AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
e AS (SELECT doc_id, i, w[i] AS word FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d)),
k AS MATERIALIZED (SELECT word, {_crc('word')} AS c FROM (SELECT DISTINCT word FROM e), crc),
c AS (SELECT doc_id, i, c, lead(c) OVER (PARTITION BY doc_id ORDER BY i) AS nxt FROM e JOIN k USING (word)),
g AS MATERIALIZED (SELECT doc_id, c % 65536 AS b FROM c UNION ALL SELECT doc_id, (c * 31 + nxt) % 65536 FROM c WHERE nxt IS NOT NULL),
l AS (SELECT doc_id, {_crc("CAST(doc_id AS VARCHAR)")} AS h FROM labels, crc WHERE doc_id IS NOT NULL AND quality IS NOT NULL
      GROUP BY doc_id, t HAVING min(quality) = 1 AND max(quality) = 1 AND h % 3 <> 1 ORDER BY h, doc_id LIMIT 8000),
r AS (SELECT b, count(*) AS raw, count(*) FILTER (h // 3 % 4 <> 0) AS trusted FROM g LEFT JOIN l USING (doc_id) GROUP BY 1),
n AS (SELECT coalesce(sum(raw), 0) + 65536 AS nr, coalesce(sum(trusted), 0) + 65536 AS nt FROM r),
wt AS (SELECT b, CAST(round(ln((trusted + 1) * nr / ((raw + 1) * nt)) * 1000) AS BIGINT) AS weight FROM r, n),
s AS (SELECT doc_id, CAST(floor(CAST(sum(weight) AS BIGINT) / count(*)) AS BIGINT) AS ratio FROM g JOIN wt USING (b) GROUP BY 1),
lim AS (SELECT coalesce(quantile_disc(ratio, 0.002), -4611686018427387904) AS least FROM s JOIN l USING (doc_id) WHERE h // 3 % 4 = 0),
v AS (SELECT doc_id, i, array_to_string(w[i:i + 4], ' ') AS win FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5)),
rep AS (SELECT doc_id, count(DISTINCT pos) AS n FROM (SELECT doc_id, unnest(range(i, i + 5)) AS pos FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, win) AS times FROM v) WHERE times > 1) GROUP BY 1),
dup AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d) WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY 1),
o AS (SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
       CAST(length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols, coalesce(dup.n, 0) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words, ratio
  FROM d LEFT JOIN dup USING (doc_id) LEFT JOIN rep USING (doc_id) LEFT JOIN s USING (doc_id))
SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed, NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND coalesce(ratio, 0) >= (SELECT least FROM lim) AS kept FROM o
"""


def _op12_sql(k: int = 16, rounds: int = 3) -> str:
    """Every round as two tables: assignments, then centroids; components as rows."""
    out = f"""
WITH v AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda e: CAST(floor(64 * CAST(e AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = 64),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h, x) - 1 AS c, x FROM (SELECT sha256('1:' || coalesce(CAST(vec_id AS VARCHAR), '')) AS h, x FROM v ORDER BY h, x LIMIT {k})),"""
    for i in range(rounds + 1):
        out += f"""
a{i} AS MATERIALIZED (SELECT r, min((dist, c)) AS best FROM (SELECT r, c, CAST(list_sum(list_transform(range(1, 65), lambda i: (v.x[i] - c.x[i]) * (v.x[i] - c.x[i]))) AS BIGINT) AS dist FROM v, c{i} AS c) GROUP BY r),"""
        if i < rounds:
            out += f"""
m{i} AS (SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS x FROM (SELECT best[2] AS c, i, sum(x[i]) AS s, count(*) AS n FROM a{i} JOIN v USING (r), range(1, 65) AS q(i) GROUP BY ALL) GROUP BY c),
c{i + 1} AS MATERIALIZED (SELECT c, coalesce(m.x, o.x) AS x FROM c{i} AS o LEFT JOIN m{i} AS m USING (c)),"""
    return (
        out
        + f"""
f AS (SELECT r, vec_id, CAST(best[2] AS INTEGER) AS cluster, best[1] AS distance FROM a{rounds} JOIN v USING (r))
SELECT vec_id, cluster, distance, CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia, CAST(sum(distance) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(x, ',')) AS centroid_sha256 FROM f JOIN c{rounds} AS c ON c.c = cluster
"""
    )


_OP13_SQL = rf"""
WITH RECURSIVE {_CRC_TABLE},
raw AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {_crc("k")} % 20 AS f
        FROM (SELECT *, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations), crc),
hurt AS (SELECT conv_id, turn, CASE WHEN f = 4 THEN 'user' ELSE role END AS role, CASE f WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(range(CASE WHEN f = 3 THEN 2 ELSE 1 END)) AS copy FROM raw WHERE f <> 0),
placed AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM hurt),
rows_ AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS nth FROM placed),
x AS MATERIALIZED (SELECT conv_id, turn, role, text, i, role[1] AS ini, CASE WHEN NOT regexp_matches(text, '[^ 	-
]') THEN 'blank' WHEN nth > 1 THEN 'duplicate'
       WHEN NOT regexp_matches(text, '[.!?][ 	-
]*\z') THEN 'truncated' ELSE '' END AS fault FROM rows_),
delta AS (SELECT * FROM (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)) AS t(p, o, q)),
ins AS (SELECT * FROM (VALUES (0, 0, 0, ''), (1, 1, 0, ''), (2, 2, 0, ''), (3, 3, 0, ''), (0, 2, 5, 'I'), (0, 3, 10, 'II'), (1, 2, 5, 'I'), (1, 3, 10, 'II'), (2, 3, 5, 'I'), (3, 2, 5, 'I')) AS t(p, q, c, l)),
arcs AS MATERIALIZED (
  SELECT conv_id, i, p, q, min((c, l)) AS w FROM (
    SELECT conv_id, i, ins.p, ins.q AS q, ins.c + 2 AS c, ins.l || 'D' AS l FROM x, ins
    UNION ALL SELECT conv_id, i, ins.p, d.q, ins.c + CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END, ins.l || 'K' FROM x JOIN delta d ON d.o = ini JOIN ins ON ins.q = d.p WHERE fault IN ('', 'truncated')
    UNION ALL SELECT conv_id, i, ins.p, d.q, ins.c + 1 + CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END, ins.l || 'R' FROM x JOIN delta d ON d.o <> 's' JOIN ins ON ins.q = d.p WHERE fault IN ('', 'truncated')
  ) GROUP BY ALL),
best AS (
  SELECT DISTINCT conv_id, CAST(0 AS BIGINT) AS i, 0 AS q, CAST(0 AS BIGINT) AS c, '' AS l FROM x
  UNION ALL
  SELECT conv_id, i, q, w[1], w[2] FROM (SELECT a.conv_id, a.i, a.q, min((CAST(b.c + a.w[1] AS BIGINT), b.l || a.w[2])) AS w FROM best b JOIN arcs a ON a.conv_id IS NOT DISTINCT FROM b.conv_id AND a.i = b.i + 1 AND a.p = b.q GROUP BY ALL)
),
n AS (SELECT conv_id, max(i) AS n FROM x GROUP BY 1),
ends AS (SELECT b.conv_id, min((CAST(b.c + ins.c AS BIGINT), b.l || ins.l)) AS w FROM best b JOIN n ON n.conv_id IS NOT DISTINCT FROM b.conv_id AND n.n = b.i JOIN ins ON ins.p = b.q WHERE ins.q IN (0, 3) GROUP BY 1),
lab AS (SELECT conv_id, w[2] AS l, j, w[2][j] AS e FROM (SELECT conv_id, w, unnest(range(1, length(w[2]) + 1)) AS j FROM ends)),
pos AS (SELECT *, count(*) FILTER (e <> 'I') OVER u AS i, count(*) FILTER (e <> 'D') OVER u AS o, count(*) FILTER (e <> 'D') OVER (PARTITION BY conv_id) AS total FROM lab WINDOW u AS (PARTITION BY conv_id ORDER BY j)),
fixed AS (SELECT pos.conv_id, sha256(string_agg(CASE WHEN e = 'K' THEN role ELSE CASE WHEN (o - 1 - total % 2) % 2 = 0 THEN 'user' ELSE 'assistant' END END || ':' || CASE WHEN e = 'I' THEN '' ELSE text END, chr(10) ORDER BY j)) AS sha
          FROM pos LEFT JOIN x ON x.conv_id IS NOT DISTINCT FROM pos.conv_id AND x.i = pos.i WHERE e <> 'D' GROUP BY 1),
facts AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
          count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (before IS NOT NULL AND before || ini NOT IN ('su', 'ua', 'au')) AS illegal
          FROM (SELECT *, lag(ini) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM x) GROUP BY 1)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
       coalesce(w[1], 0) AS cost, coalesce(w[2], '') AS audit, coalesce(sha, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN facts f ON f.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN ends e ON e.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN fixed x ON x.conv_id IS NOT DISTINCT FROM c.conv_id
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_toxicity, op2_html_extraction, op3_quality, op4_packing, op5_line_dedup, op6_simhash, op7_exact_dedup, op8_language_id, op9_decontamination, op10_warc, op11_quality_rules, op12_centroid_clustering, op13_conversation_repair)}


def oracle_sql() -> dict[str, str]:
    return {
        "op5_line_dedup": _OP5_SQL, "op7_exact_dedup": _OP7_SQL, "op9_decontamination": _OP9_SQL,
        "op11_quality_rules": _OP11_SQL, "op12_centroid_clustering": _op12_sql(), "op13_conversation_repair": _OP13_SQL,
    }
