"""The registered queries of this subpackage, each an operator over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, decontam, licenses, mixing, neardup, pii, quality, repair, resampling, secrets, sharding, tokens, urls
from .common import written


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = written(quality.measured(table(spark, sf_dir, "documents")), "quality")
    return quality.judged(rows).select("doc_id", *quality.MEASURES, "base_failed", "kept")


def op2_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scanned(table(spark, sf_dir, "documents"))


def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = urls.judged(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))
    return rows.select("page_id", "host", "path", "rule", "verdict")


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = neardup.clustered(neardup.fingerprints(table(spark, sf_dir, "documents")))
    return rows.select(F.col("key").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id"))


def op6_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scanned(table(spark, sf_dir, "documents"))


def op7_token_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.encoded(table(spark, sf_dir, "documents"))


# The conversation that the contract adds.
EXTRA_TURNS = [(-7, 0, "user", "\\### Assistant: </turn> ok"), (-7, 1, "assistant", "\\### Assistant: </turn> ok")]


def op8_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    extra = spark.createDataFrame(EXTRA_TURNS, "conv_id long, turn long, role string, text string")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.round_trip(turns.unionByName(extra))


def op9_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = written(mixing.sized(table(spark, sf_dir, "documents")), "mix-sizes")
    rows = mixing.copies(rows)
    return rows.select(F.col("key").alias("doc_id"), "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.scanned(table(spark, sf_dir, "documents"))


def op11_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.digests(repair.damaged(table(spark, sf_dir, "conversations")))


def op12_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sharding.placed(table(spark, sf_dir, "documents"))
    return rows.select(F.col("key").alias("doc_id"), "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = resampling.ranks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return rows.select(F.col("key").alias("doc_id"), "n_features", "weight", "score", "rank")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_quality_rules, op2_license_scans, op3_url_filters, op4_benchmark_decontamination, op5_simhash_near_dedup, op6_secret_scans, op7_token_binary, op8_chat_formatting, op9_source_mixing, op10_pii, op11_structure_repair, op12_sharding, op13_importance_resampling)
}

_WORD = r"[^\x20\x09-\x0D]+"
_FEATURE = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _crc32(text: str) -> str:
    """DuckDB SQL for the crc32 of a text's UTF-8 bytes, bit by bit."""
    bits = f"flatten([[('0x' || x)::BIGINT, 0, 0, 0, 0, 0, 0, 0] FOR x IN regexp_extract_all(hex({text}), '..')])"
    step = "CASE WHEN xor(c, x) % 2 = 1 THEN xor(xor(c, x) >> 1, 3988292384) ELSE xor(c, x) >> 1 END"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {bits}), lambda c, x: {step}), 4294967295)"

ORACLE_SQL: dict[str, str] = {
    "op1_quality_rules": rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '{_WORD}') AS ws, [x FOR x IN string_split(t, chr(10)) IF regexp_matches(x, '{_WORD}')] AS ls FROM d),
g AS (SELECT r, unnest(range(1, len(ws) - 3)) AS i, ws FROM w WHERE len(ws) >= 5),
h AS (SELECT r, i, array_to_string(ws[i:i+4], ' ') AS gram FROM g),
twice AS (SELECT r, gram FROM h GROUP BY r, gram HAVING count(*) > 1),
rep AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT h.r, unnest([i, i+1, i+2, i+3, i+4]) AS p FROM h JOIN twice USING (r, gram)) GROUP BY r),
m AS (
  SELECT w.r, doc_id, source, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words
  FROM w LEFT JOIN rep USING (r)),
f AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m),
hosts AS (SELECT source, count(*)::DOUBLE AS n, sum(base_failed::INT)::DOUBLE AS k FROM f GROUP BY source),
s AS (SELECT count(*) AS hs, sum(n) AS n, sum(k) AS k, sum(k * k / n) AS kk FROM hosts),
v AS (SELECT k / n AS mean, kk / n - (k / n) * (k / n) - (k / n) * (1 - k / n) * hs / n AS b FROM s),
p AS (SELECT mean, CASE WHEN b > 0 THEN least(greatest(mean * (1 - mean) / b - 1, 1.0), 1e6) ELSE 1e6 END AS wt FROM v),
ab AS (SELECT source, k + mean * wt AS a, n - k + (1 - mean) * wt AS b FROM hosts, p),
bad AS (SELECT source, a / (a + b) - 1.645 * sqrt(a / (a + b) * (1 - a / (a + b)) / (a + b + 1)) > 0.5 AS rejected FROM ab)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
       NOT (base_failed OR rejected) AS kept
FROM f JOIN bad ON f.source IS NOT DISTINCT FROM bad.source""",
    "op3_url_filters": r"""
WITH u AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
q AS (SELECT page_id, translate(regexp_extract(coalesce(rest, ''), '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path FROM u),
l AS (SELECT doc_id AS page_id, coalesce(quality = 0, false) OR coalesce(toxic = 1, false) AS bad FROM labels WHERE quality IS NOT NULL OR toxic IS NOT NULL),
h0 AS (SELECT host, count(bad) AS n, coalesce(sum(bad::INT), 0) AS k FROM q LEFT JOIN l USING (page_id) GROUP BY host),
h AS (SELECT *, array_to_string(string_split(host, '.')[greatest(len(string_split(host, '.')) - 1, 1):], '.') AS domain, string_split(host, '.')[-1] AS suffix FROM h0),
d0 AS (SELECT domain, suffix, sum(n) AS n, sum(k) AS k FROM h GROUP BY ALL),
s0 AS (SELECT suffix, sum(n) AS n, sum(k) AS k FROM h GROUP BY ALL),
g AS (SELECT CASE WHEN sum(n) > 0 THEN sum(k) / sum(n) ELSE 0 END AS mean FROM s0),
sw AS (SELECT sum(n) AS n, sum(n * (k / n - mean) * (k / n - mean)) AS spread, sum(mean * (1 - mean)) AS noise, sum(n * mean * (1 - mean)) AS bin FROM s0, g WHERE n > 0),
sm AS (SELECT CASE WHEN n > 0 AND (spread - noise) / n > 0 THEN least(greatest(bin / n / ((spread - noise) / n) - 1, 1), 1000) ELSE 1000 END AS w FROM sw),
s AS (SELECT suffix, (k + w * mean) / (n + w) AS pr FROM s0, g, sm),
d1 AS (SELECT domain, n, k, pr FROM d0 JOIN s USING (suffix)),
dw AS (SELECT sum(n) AS n, sum(n * (k / n - pr) * (k / n - pr)) AS spread, sum(pr * (1 - pr)) AS noise, sum(n * pr * (1 - pr)) AS bin FROM d1 WHERE n > 0),
dm AS (SELECT CASE WHEN n > 0 AND (spread - noise) / n > 0 THEN least(greatest(bin / n / ((spread - noise) / n) - 1, 1), 1000) ELSE 1000 END AS w FROM dw),
d AS (SELECT domain, (k + w * pr) / (n + w) AS pr FROM d1, dm),
h1 AS (SELECT host, n, k, pr FROM h JOIN d USING (domain)),
hw AS (SELECT sum(n) AS n, sum(n * (k / n - pr) * (k / n - pr)) AS spread, sum(pr * (1 - pr)) AS noise, sum(n * pr * (1 - pr)) AS bin FROM h1 WHERE n > 0),
hm AS (SELECT CASE WHEN n > 0 AND (spread - noise) / n > 0 THEN least(greatest(bin / n / ((spread - noise) / n) - 1, 1), 1000) ELSE 1000 END AS w FROM hw),
hr AS (SELECT host, (k + w * pr) / (n + w) AS rate, n + w AS m FROM h1, hm),
rules(verdict, rule, rh, rp) AS (VALUES ('allow', 'org/', 'org', '/'), ('block', 'example.org/es/', 'example.org', '/es/'), ('block', 'example.org/en/1', 'example.org', '/en/1'), ('allow', 'com/fr/', 'com', '/fr/'), ('block', 'com/de/', 'com', '/de/')),
fit AS (SELECT page_id, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict FROM (SELECT DISTINCT * FROM q) AS q JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY page_id)
SELECT q.page_id, q.host, q.path, fit.rule, coalesce(fit.verdict, CASE WHEN rate - 1.645 * sqrt(rate * (1 - rate) / (m + 1)) > 0.5 THEN 'block' ELSE 'allow' END) AS verdict
FROM q LEFT JOIN hr USING (host) LEFT JOIN fit ON fit.page_id = q.page_id""",
    "op8_chat_formatting": r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
f AS (SELECT *, CASE WHEN role IN ('system', 'user', 'assistant', 'tool') THEN 4 + length(role) + 2
                     ELSE 4 + length(role) + len(regexp_extract_all(role, '\\|###|</turn>|:')) + 2 END
                + length(text) + len(regexp_extract_all(text, '\\|###|</turn>')) + 8 AS chars FROM t)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(chars)::BIGINT AS formatted_chars
FROM f GROUP BY conv_id""",
    "op9_source_mixing": rf"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{_WORD}'))::BIGINT AS size, substr(md5(coalesce(text, '')), 1, 16) AS tie FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
r AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank FROM s),
w AS (SELECT *, (rank % 3 + 1)::BIGINT AS weight FROM r),
p AS (SELECT *, sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER (ORDER BY source_size / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
             sum(weight) OVER (ORDER BY source_size / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights FROM w),
lv AS (SELECT rest, weights FROM p WHERE 3 * source_size * weights >= rest * weight ORDER BY source_size / weight, rank LIMIT 1),
t AS (SELECT source, source_size, least((3 * source_size)::DOUBLE, lv.rest::DOUBLE * weight::DOUBLE / lv.weights::DOUBLE) AS target FROM p, lv),
c AS (SELECT *, length(bin(size)) AS bits, substr(md5(coalesce(doc_id::VARCHAR, '') || ':' || tie), 1, 3) AS cell FROM d),
k AS (SELECT *, bits * 4 + CASE WHEN size >= 4 THEN floor(4 * (size / pow(2.0, bits - 1) - 1)) ELSE size END AS class FROM c),
o AS (SELECT doc_id, source, size, row_number() OVER (PARTITION BY source ORDER BY class, cell, size, doc_id NULLS FIRST, tie) AS place FROM k),
x AS (SELECT o.doc_id, o.size, t.source_size, t.target, place, CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate,
             ('0x' || substr(md5('7:' || coalesce('s' || o.source, 'null')), 1, 8))::BIGINT::DOUBLE / 4294967296.0 AS u
      FROM o JOIN t ON o.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, (least(floor(place * rate + u)::BIGINT - floor((place - 1) * rate + u)::BIGINT, 3) * size)::BIGINT AS taken FROM x""",
    "op11_structure_repair": rf"""
WITH RECURSIVE o AS (SELECT row_number() OVER () AS r, conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                  {_crc32("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS what FROM conversations),
d AS (SELECT conv_id, turn, CASE WHEN what = 4 THEN 'user' ELSE role END AS role,
             CASE what WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
      FROM (SELECT *, unnest(CASE WHEN what = 3 THEN [0, 1] ELSE [0] END) FROM o WHERE what > 0)),
p AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text)) AS pos FROM d),
f AS (SELECT *, substr(role, 1, 1) AS letter, lead(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY pos) AS next_letter,
             CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
                  WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 THEN 'duplicate'
                  WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' ELSE '' END AS fault FROM p),
c AS (SELECT o.conv_id, coalesce(g.n, 0) AS n, coalesce(g.gaps, 0) AS gaps, coalesce(g.blank, 0) AS blank, coalesce(g.duplicate, 0) AS duplicate,
             coalesce(g.truncated, 0) AS truncated, coalesce(g.illegal, 0) AS illegal
      FROM (SELECT DISTINCT conv_id FROM o) AS o LEFT JOIN (
        SELECT conv_id, max(pos) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
               count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
               count(*) FILTER (next_letter IS NOT NULL AND letter || next_letter NOT IN ('su', 'ua', 'au')) AS illegal
        FROM f GROUP BY conv_id) AS g ON o.conv_id IS NOT DISTINCT FROM g.conv_id),
-- the best rest of a conversation from each state: cost, edits, lines
b(conv_id, pos, s0, s1, s2, s3) AS (
  SELECT conv_id, n, {{c: 0, e: '', l: []::VARCHAR[]}}, {{c: 10, e: 'II', l: ['user:', 'assistant:']}}, {{c: 5, e: 'I', l: ['assistant:']}}, {{c: 0, e: '', l: []::VARCHAR[]}} FROM c
  UNION ALL
  SELECT conv_id, pos, t0, t1, t2, t3 FROM (
    SELECT *, least(u0, {{c: t2.c + 5, e: 'I' || t2.e, l: list_prepend('user:', t2.l)}}) AS t0, least(u1, {{c: t2.c + 5, e: 'I' || t2.e, l: list_prepend('user:', t2.l)}}) AS t1,
           least(u3, {{c: t2.c + 5, e: 'I' || t2.e, l: list_prepend('user:', t2.l)}}) AS t3
    FROM (SELECT *, least(u2, {{c: u3.c + 5, e: 'I' || u3.e, l: list_prepend('assistant:', u3.l)}}) AS t2 FROM (
      SELECT f.conv_id, f.pos - 1 AS pos,
        least({{c: s0.c + 2, e: 'D' || s0.e, l: s0.l}}, CASE WHEN free AND letter = 's' THEN {{c: s1.c + x, e: 'K' || s1.e, l: list_prepend(line, s1.l)}} END, CASE WHEN free AND letter = 'u' THEN {{c: s2.c + x, e: 'K' || s2.e, l: list_prepend(line, s2.l)}} END, CASE WHEN free THEN {{c: s2.c + x + 1, e: 'R' || s2.e, l: list_prepend('user:' || text, s2.l)}} END) AS u0,
        least({{c: s1.c + 2, e: 'D' || s1.e, l: s1.l}}, CASE WHEN free AND letter = 'u' THEN {{c: s2.c + x, e: 'K' || s2.e, l: list_prepend(line, s2.l)}} END, CASE WHEN free THEN {{c: s2.c + x + 1, e: 'R' || s2.e, l: list_prepend('user:' || text, s2.l)}} END) AS u1,
        least({{c: s2.c + 2, e: 'D' || s2.e, l: s2.l}}, CASE WHEN free AND letter = 'a' THEN {{c: s3.c + x, e: 'K' || s3.e, l: list_prepend(line, s3.l)}} END, CASE WHEN free THEN {{c: s3.c + x + 1, e: 'R' || s3.e, l: list_prepend('assistant:' || text, s3.l)}} END) AS u2,
        least({{c: s3.c + 2, e: 'D' || s3.e, l: s3.l}}, CASE WHEN free AND letter = 'u' THEN {{c: s2.c + x, e: 'K' || s2.e, l: list_prepend(line, s2.l)}} END, CASE WHEN free THEN {{c: s2.c + x + 1, e: 'R' || s2.e, l: list_prepend('user:' || text, s2.l)}} END) AS u3
      FROM b JOIN (SELECT *, fault IN ('', 'truncated') AS free, CASE fault WHEN 'truncated' THEN 5 ELSE 0 END AS x, role || ':' || text AS line FROM f) AS f ON b.conv_id IS NOT DISTINCT FROM f.conv_id AND b.pos = f.pos)))
)
SELECT c.conv_id, gaps::BIGINT AS gaps, blank::BIGINT AS blank, duplicate::BIGINT AS duplicate, truncated::BIGINT AS truncated, illegal::BIGINT AS illegal,
       s0.c::BIGINT AS cost, s0.e AS audit, sha256(array_to_string(s0.l, chr(10))) AS repaired_sha256
FROM c JOIN b ON c.conv_id IS NOT DISTINCT FROM b.conv_id AND b.pos = 0""",
    "op12_sharding": f"""
WITH d AS (SELECT doc_id, octet_length(encode(coalesce(text, '')))::BIGINT + 8 AS size, {_crc32("coalesce(text, '')")} AS text_crc32 FROM documents),
i AS (SELECT DISTINCT doc_id, coalesce(doc_id::VARCHAR, '') AS id FROM d),
leaf AS (SELECT shard::INT AS shard, (shard // 8)::VARCHAR AS g, (shard // 8)::VARCHAR || '/' || (shard // 4 % 2)::VARCHAR AS k FROM range(25) AS t(shard)),
nodes AS (SELECT 24 + extra AS n, level, parent, name, count(*)::DOUBLE AS weight, any_value(shard) AS shard
          FROM (SELECT shard, unnest([{{l: 1, p: '', x: g}}, {{l: 2, p: g, x: k}}, {{l: 3, p: k, x: k || '/' || shard::VARCHAR}}], recursive := true) FROM leaf) AS t(shard, level, parent, name)
               JOIN range(2) AS e(extra) ON shard < 24 + extra
          GROUP BY ALL HAVING count(*) > 0),
one AS (SELECT n, doc_id, id, arg_min(name, draw) AS name FROM (SELECT n, doc_id, id, name, -ln((('0x' || substr(md5('11:' || name || ':' || id), 1, 8))::BIGINT::DOUBLE + 0.5) / 4294967296.0) / weight AS draw FROM i JOIN (SELECT n, name, sum(weight) AS weight FROM nodes WHERE level = 1 GROUP BY ALL) ON true) GROUP BY ALL),
two AS (SELECT n, doc_id, id, arg_min(name, draw) AS name FROM (SELECT n, doc_id, id, k.name, -ln((('0x' || substr(md5('11:' || k.name || ':' || id), 1, 8))::BIGINT::DOUBLE + 0.5) / 4294967296.0) / weight AS draw FROM one JOIN (SELECT n, parent, name, sum(weight) AS weight FROM nodes WHERE level = 2 GROUP BY ALL) AS k USING (n) WHERE k.parent = one.name) GROUP BY ALL),
three AS (SELECT n, doc_id, arg_min(shard, draw) AS shard FROM (SELECT n, doc_id, id, k.shard, -ln((('0x' || substr(md5('11:' || k.name || ':' || id), 1, 8))::BIGINT::DOUBLE + 0.5) / 4294967296.0) AS draw FROM two JOIN (SELECT * FROM nodes WHERE level = 3) AS k USING (n) WHERE k.parent = two.name) GROUP BY ALL),
s AS (SELECT d.*, a.shard, b.shard AS grown_shard, substr(md5(coalesce(d.doc_id::VARCHAR, '') || ':' || size || ':' || text_crc32), 1, 4) AS cell
      FROM d JOIN three AS a ON a.n = 24 AND d.doc_id IS NOT DISTINCT FROM a.doc_id JOIN three AS b ON b.n = 25 AND d.doc_id IS NOT DISTINCT FROM b.doc_id)
SELECT doc_id, size, text_crc32, 'key' AS law, shard, row_number() OVER (PARTITION BY shard ORDER BY cell, doc_id NULLS FIRST, size, text_crc32) - 1 AS slot, grown_shard FROM s""",
    "op13_importance_resampling": rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_FEATURE}') AS ws FROM documents),
e AS (SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_FEATURE}')) AS w FROM benchmark),
u AS (SELECT r, unnest(ws) AS w FROM d),
k AS (SELECT w, {_crc32("w")} % 10000 AS bucket FROM (SELECT w FROM u UNION SELECT w FROM e)),
s AS (SELECT bucket, count(*) AS s FROM u JOIN k USING (w) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS t FROM e JOIN k USING (w) GROUP BY bucket),
n AS (SELECT (SELECT coalesce(sum(s), 0) FROM s) AS s_all, (SELECT coalesce(sum(t), 0) FROM t) AS t_all),
g AS (SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * (s_all + 10000)::DOUBLE / ((coalesce(s, 0) + 1)::DOUBLE * (t_all + 10000)::DOUBLE)))::BIGINT AS gain FROM s FULL JOIN t USING (bucket), n),
w AS (SELECT r, sum(gain) AS weight FROM u JOIN k USING (w) JOIN g USING (bucket) GROUP BY r),
x AS (SELECT doc_id, len(ws)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
             floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT::DOUBLE + 0.5) / 4294967296.0)))::BIGINT AS noise FROM d LEFT JOIN w USING (r)),
o AS (SELECT *, weight + noise AS score, n_features >= 20 AS able FROM x),
q AS (SELECT *, row_number() OVER (PARTITION BY able ORDER BY score DESC, doc_id NULLS FIRST) AS place, count(*) FILTER (able) OVER () * 10 // 100 AS size FROM o)
SELECT doc_id, n_features, weight, score, CASE WHEN able AND place <= size THEN place END AS rank FROM q""",
}
