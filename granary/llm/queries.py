"""The queries of the corpus operators, with production parameters, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.llm import conversation_repair, filter_audit, jaccard_join, license_scan, mixing, packing, quality, secret_scan, sharding, simhash, substring_dedup, token_counts, topk_search
from granary.llm.common import Scratch, documents

PIECE_MODEL, WORD_TOKENIZER = "piece_bpe_32k.model", "word_bpe_49k.json"


def tokenizer(name: str) -> str:
    """Where a public tokenizer's file is, here and on the executors."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(documents(spark, sf_dir), tokenizer(PIECE_MODEL))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), tokenizer(WORD_TOKENIZER), with_ids=False).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.repeated_spans(documents(spark, sf_dir))


def op4_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.mix(documents(spark, sf_dir).select("doc_id", "source", mixing.words(F.col("text")).alias("words")), F.col("words"))
    return out.select("doc_id", F.col("_size").alias("size"), F.col("_source_size").alias("source_size"), F.col("_target").alias("target"), F.col("_taken").alias("taken"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(documents(spark, sf_dir)).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "log_perplexity")


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(secret_scan.scan_secrets(documents(spark, sf_dir)))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(documents(spark, sf_dir))


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join_documents(documents(spark, sf_dir))


def op9_two_pass_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, text = documents(spark, sf_dir), F.coalesce("text", F.lit(""))
    out = sharding.two_pass_shuffle(docs, ["doc_id", "text"], 8)
    path = f"{Scratch(spark).root}/shards"
    sharding.write_shards(out, path)
    out = spark.read.schema(out.schema).parquet(path)
    return out.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op10_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_search.top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 20 == 0)


def op11_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = conversation_repair.damaged(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    reports = Scratch(spark).save(conversation_repair.repairs(rows), "reports")
    turns = conversation_repair.repaired(rows, reports)
    digests = conversation_repair.digests(turns).withColumnRenamed("conv_id", "of")
    out = reports.join(digests, reports["conv_id"].eqNullSafe(digests["of"]), "left")
    return out.withColumn("repaired_sha256", F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256))).drop("of")


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_token_counts, op2_best_fit_packing, op3_substring_dedup, op4_source_mix, op5_quality_rules, op6_secret_scan, op7_license_scan, op8_jaccard_join, op9_two_pass_shards, op10_exact_top_k, op11_simhash_dedup, op12_conversation_repair, op13_filter_audit)}

ORACLE: dict[str, str] = {
    "op4_source_mix": r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':17'), 1, 15))::BIGINT AS h
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source IS NULL, encode(source)) AS rk FROM d GROUP BY source),
w AS (SELECT *, ((rk - 1) % 3 + 1)::BIGINT AS weight FROM s),
b AS (SELECT sum(source_size)::BIGINT AS budget FROM s),
f AS (
  SELECT w.*, 3 * source_size / weight::DOUBLE AS fullness, budget,
         coalesce(sum(3 * source_size) OVER (ORDER BY 3 * source_size / weight::DOUBLE, rk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS spent,
         sum(weight) OVER (ORDER BY 3 * source_size / weight::DOUBLE, rk ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights
  FROM w, b),
l AS (SELECT max(CASE WHEN (budget - spent)::DOUBLE / weights <= fullness THEN (budget - spent)::DOUBLE / weights END) AS level FROM f),
t AS (SELECT source, rk, weight, source_size, CASE WHEN level IS NULL THEN 3 * source_size ELSE least((3 * source_size)::DOUBLE, weight * level) END::DOUBLE AS target FROM f, l),
c AS (
  SELECT d.doc_id, d.size, t.*, d.h, sum(d.size) OVER (PARTITION BY t.rk ORDER BY d.h, d.doc_id, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
q AS (SELECT doc_id, rk, size, (cum + e * source_size)::DOUBLE / weight AS vt, e FROM c, (SELECT unnest([0, 1, 2]) AS e) WHERE size > 0),
r AS (SELECT *, sum(size) OVER (ORDER BY vt, rk ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS running FROM q),
k AS (SELECT doc_id, rk, count(*) AS times FROM r, b WHERE running <= budget GROUP BY doc_id, rk)
SELECT c.doc_id, c.size, c.source_size, c.target, (c.size * coalesce(k.times, 0))::BIGINT AS taken
FROM c LEFT JOIN k ON c.doc_id = k.doc_id AND c.rk = k.rk
""",
    "op8_jaccard_join": r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM documents),
i AS (SELECT doc_id, ws, least(5, len(ws)) AS k, unnest(range(1, len(ws) - least(5, len(ws)) + 2)) AS j FROM w WHERE len(ws) > 0),
s AS (SELECT DISTINCT doc_id, array_to_string(list_slice(ws, j, j + k - 1), ' ') AS g FROM i),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY 1, 2),
l AS (SELECT a, b, c = x.n AND c = y.n AS same FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 5 * c >= 4 * (x.n + y.n - c)),
r AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
t AS (SELECT d.doc_id, least(d.doc_id, min(l.b) FILTER (WHERE same)) AS set_id, 1 + count(*) FILTER (WHERE same) AS copies, count(l.b) AS n_links FROM documents d LEFT JOIN l ON l.a = d.doc_id GROUP BY d.doc_id),
o AS (SELECT l.a AS doc_id, count(DISTINCT t.set_id) AS n_set_links FROM l JOIN t ON t.doc_id = l.b WHERE NOT same GROUP BY l.a),
q AS (SELECT a AS doc_id, least(a, min(b)) AS class_id, count(DISTINCT b) AS class_size FROM r GROUP BY a)
SELECT t.doc_id, coalesce(class_id, t.doc_id) AS class_id, coalesce(class_size, 1) AS class_size, CASE WHEN n.n IS NOT NULL THEN set_id END AS set_id, copies, n_links, coalesce(n_set_links, 0) AS n_set_links
FROM t LEFT JOIN q ON q.doc_id = t.doc_id LEFT JOIN o ON o.doc_id = t.doc_id LEFT JOIN n ON n.doc_id = t.doc_id
""",
    "op10_exact_top_k": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS q FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (
  SELECT a.vec_id AS query_id, b.vec_id, list_inner_product(a.q, b.q)::BIGINT AS score
  FROM v a, v b WHERE a.vec_id % 20 = 0 AND a.vec_id <> b.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM p)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
""",
    "op12_conversation_repair": r"""
WITH RECURSIVE b AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         list_transform(str_split(hex(encode(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))), ''), lambda x: strpos('0123456789ABCDEF', x) - 1) AS nibbles
  FROM conversations),
p AS (
  SELECT conv_id, turn, role, text, list_transform(range(1, len(nibbles) // 2 + 1), lambda k: (16 * nibbles[2 * k - 1] + nibbles[2 * k])::BIGINT) AS bytes FROM b),
h AS (
  SELECT conv_id, turn, role, text,
         xor(4294967295::BIGINT, list_reduce(bytes, lambda acc, x: list_reduce(range(8), lambda y, k: CASE WHEN y & 1 = 1 THEN xor(y >> 1, 3988292384::BIGINT) ELSE y >> 1 END, xor(acc, x)), 4294967295::BIGINT)) % 20 AS f
  FROM p),
d AS (
  SELECT conv_id, turn, CASE WHEN f = 4 THEN 'user' ELSE role END AS role, CASE f WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM (SELECT *, unnest(range(CASE WHEN f = 3 THEN 2 ELSE 1 END)) FROM h WHERE f <> 0)),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(length(role) || ':' || role || text)) AS i FROM d),
n AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS seen, rtrim(text, E' \t\n\x0b\x0c\r') AS bare, role[1] AS initial FROM o),
r AS (
  SELECT conv_id, i, turn, role, text, initial, bare = '' AS blank, bare <> '' AND seen > 1 AS duplicate, bare <> '' AND seen = 1 AND right(bare, 1) NOT IN ('.', '!', '?') AS truncated,
         lag(initial) OVER (PARTITION BY conv_id ORDER BY i) AS before
  FROM n),
s AS (
  SELECT conv_id, 0::BIGINT AS i, [{'c': 0::BIGINT, 'a': '', 't': NULL::VARCHAR}, NULL, NULL, NULL] AS v FROM (SELECT DISTINCT conv_id FROM conversations)
  UNION ALL
  SELECT conv_id, i, list_transform(range(4), lambda z: list_min(list_transform(list_filter(ways, lambda w: w.q = z), lambda w: w.x))) FROM (
    SELECT conv_id, i, list_concat(
      list_transform(pre, lambda p: {'q': p.q, 'x': {'c': p.x.c + 3, 'a': p.x.a || 'D', 't': p.x.t}}),
      list_transform(list_filter(pre, lambda p: NOT gone), lambda p: {'q': CASE WHEN p.q = 2 THEN 3 ELSE 2 END::BIGINT, 'x': {'c': p.x.c + 2 + late, 'a': p.x.a || 'R', 't': coalesce(p.x.t || chr(10), '') || CASE WHEN p.q = 2 THEN 'assistant:' ELSE 'user:' END || text}}),
      list_transform(list_filter(pre, lambda p: NOT gone AND (initial = 's' AND p.q = 0 OR initial = 'u' AND p.q <> 2 OR initial = 'a' AND p.q = 2)),
                     lambda p: {'q': CASE initial WHEN 's' THEN 1 WHEN 'u' THEN 2 ELSE 3 END::BIGINT, 'x': {'c': p.x.c + late, 'a': p.x.a || 'K', 't': coalesce(p.x.t || chr(10), '') || role || ':' || text}})) AS ways
    FROM (
      SELECT r.*, blank OR duplicate AS gone, truncated::BIGINT AS late,
             list_filter(list_concat(
               list_transform(range(4), lambda z: {'q': z::BIGINT, 'x': v[z + 1]}),
               list_transform(range(4), lambda z: {'q': CASE WHEN z = 2 THEN 3 ELSE 2 END::BIGINT, 'x': {'c': v[z + 1].c + 2, 'a': v[z + 1].a || 'I', 't': coalesce(v[z + 1].t || chr(10), '') || CASE WHEN z = 2 THEN 'assistant:' ELSE 'user:' END}}),
               list_transform(range(4), lambda z: {'q': CASE WHEN z = 2 THEN 2 ELSE 3 END::BIGINT, 'x': {'c': v[z + 1].c + 4, 'a': v[z + 1].a || 'II', 't': coalesce(v[z + 1].t || chr(10), '') || CASE WHEN z = 2 THEN 'assistant:' || chr(10) || 'user:' ELSE 'user:' || chr(10) || 'assistant:' END}})),
               lambda p: p.x.c IS NOT NULL) AS pre
      FROM s JOIN r ON r.conv_id IS NOT DISTINCT FROM s.conv_id AND r.i = s.i + 1))),
e AS (
  SELECT conv_id, list_min(list_filter([
    v[1], {'c': v[2].c + 4, 'a': v[2].a || 'II', 't': v[2].t || chr(10) || 'user:' || chr(10) || 'assistant:'}, {'c': v[3].c + 2, 'a': v[3].a || 'I', 't': v[3].t || chr(10) || 'assistant:'}, v[4]], lambda x: x.c IS NOT NULL)) AS x
  FROM (SELECT conv_id, arg_max(v, i) AS v FROM s GROUP BY conv_id)),
g AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps, count(*) FILTER (blank) AS blank, count(*) FILTER (duplicate) AS duplicate,
         count(*) FILTER (truncated) AS truncated, count(*) FILTER (i > 1 AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM r GROUP BY conv_id)
SELECT e.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
       x.c AS cost, x.a AS audit, sha256(coalesce(x.t, '')) AS repaired_sha256
FROM e LEFT JOIN g ON g.conv_id IS NOT DISTINCT FROM e.conv_id
""",
    "op13_filter_audit": r"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
m AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, len(ws) < 200 AS a, 100 * len(list_distinct(ws)) < 50 * len(ws) AS b,
         100 * len(regexp_extract_all(text, '[A-Z]')) > 2 * length(text) AS c, regexp_matches(text, '[#$%&*|]') AS d, coalesce(d.doc_id > min(d.doc_id) OVER (PARTITION BY text), false) AS e
  FROM d LEFT JOIN l ON l.doc_id = d.doc_id),
f AS (SELECT part, good, toxic, (CASE WHEN a THEN 'A' ELSE '' END || CASE WHEN b THEN 'B' ELSE '' END || CASE WHEN c THEN 'C' ELSE '' END || CASE WHEN d THEN 'D' ELSE '' END || CASE WHEN e THEN 'E' ELSE '' END) AS fails FROM m),
g AS (SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM f GROUP BY part, fails),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (SELECT p.x || q.x || r.x || s.x || t.x AS filter_order FROM x p, x q, x r, x s, x t WHERE len(list_distinct([p.x, q.x, r.x, s.x, t.x])) = 5),
y AS (SELECT *, unnest(range(1, 6))::INT AS step FROM g, o),
z AS (SELECT *, contains(fails, filter_order[step]) AS here, len(translate(filter_order[1:step - 1], fails, '')) < step - 1 AS gone FROM y),
w AS (
  SELECT part, filter_order, step, (coalesce(sum(n) FILTER (NOT here AND NOT gone), 0))::BIGINT AS kept, (coalesce(sum(n) FILTER (here AND NOT gone), 0))::BIGINT AS removed,
         (coalesce(sum(n) FILTER (here AND gone), 0))::BIGINT AS redundant, (coalesce(sum(n) FILTER (fails = filter_order[step]), 0))::BIGINT AS unique_fails,
         (coalesce(sum(good) FILTER (here AND NOT gone), 0))::BIGINT AS good_lost, (coalesce(sum(toxic) FILTER (here AND NOT gone), 0))::BIGINT AS toxic_lost
  FROM z GROUP BY part, filter_order, step)
SELECT *, (sum(removed) OVER (PARTITION BY part, filter_order[step]))::BIGINT AS shapley FROM w
""",
}
