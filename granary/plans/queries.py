"""The registered queries over the driver's tables, each with the SQL that must give the same rows.

The tables hold none of the defects that the operators are about, so that queries inject them by key.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.functions import html, ids, text, validate
from granary.operators import extract, gate, reports, robots, store
from granary.sources import allow_list, listing

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
NOW = "1998-09-01 00:00:00"


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def now() -> Column:
    return F.to_timestamp(F.lit(NOW))


@query("""SELECT page_id, coalesce(nullif(regexp_replace(regexp_extract(url, '^[a-z]+://([^/?#]*)', 1), '^www\\.', ''), ''), 'synthetic') AS source, substr(sha256(url), 1, 16) AS source_id,
 sha256(html) AS content_hash, nullif(regexp_extract(html, '(?i)<html[^>]+lang=["'']([a-z]{2})["'']', 1), '') AS lang, url FROM pages""")
def q_page_identity(spark, d):
    c = F.col
    return table(spark, d, "pages").select("page_id", ids.derived_source(c("url")).alias("source"), ids.derived_id(c("url")).alias("source_id"), text.sha256(c("html")).alias("content_hash"), text.html_lang(c("html")).alias("lang"), "url")


@query("""SELECT page_id, nullif(trim(regexp_extract('# ' || regexp_extract(html, '<h1[^>]*>([^<]*)', 1), '(?m)^#\\s+(.+)$', 1)), '') AS title FROM pages""")
def q_page_title(spark, d):
    h1 = F.concat(F.lit("# "), F.regexp_extract("html", r"<h1[^>]*>([^<]*)", 1))
    return table(spark, d, "pages").select("page_id", text.first_heading(h1).alias("title"))


@query("""SELECT lang, count(*) AS n FROM (SELECT coalesce(nullif(regexp_extract(html, '(?i)<html[^>]+lang=["'']([a-z]{2})["'']', 1), ''), 'en') AS lang FROM pages) GROUP BY lang""")
def q_page_language(spark, d):
    return table(spark, d, "pages").groupBy(F.coalesce(text.html_lang(F.col("html")), F.lit("en")).alias("lang")).agg(F.count("*").alias("n"))


def article_payloads(spark, d):
    """Documents as articles' JSON with defects by doc_id."""
    k = F.col("doc_id") % 11
    return table(spark, d, "documents").select("doc_id", F.to_json(F.struct(
        F.lit("docs").alias("source"), F.concat(F.when(k == 1, "ftp://x/").otherwise("https://Example.com/"), F.col("doc_id").cast("string")).alias("source_url"), F.col("doc_id").cast("string").alias("source_id"),
        F.when(k == 2, F.lit("")).when(k == 3, F.repeat(F.lit("t"), 501)).when(k == 4, F.lit(None).cast("string")).otherwise(F.lit("A title")).alias("title"),
        F.when(k == 5, F.lit("short")).when(k == 6, F.concat(F.lit("Lorem Ipsum "), F.col("text"))).otherwise(F.concat(F.lit("body text "), F.col("text"))).alias("body_md"),
        F.when(k == 7, F.lit("eng")).when(k == 8, F.lit(" English ")).when(k == 9, F.lit("EN")).otherwise(F.lit("en")).alias("language"),
    ), {"ignoreNullFields": "false"}).alias("payload"))


@query("""SELECT doc_id, CASE doc_id % 11 WHEN 1 THEN 'source_url:url_type' WHEN 2 THEN 'title:string_too_short' WHEN 3 THEN 'title:string_too_long' WHEN 4 THEN 'title:missing'
 WHEN 5 THEN 'body_md:string_too_short' WHEN 6 THEN 'body_md:placeholder' WHEN 7 THEN 'language:pattern_mismatch' WHEN 9 THEN 'language:pattern_mismatch' ELSE '' END AS errors,
 CASE WHEN doc_id % 11 = 7 THEN 'eng' WHEN doc_id % 11 = 9 THEN 'EN' ELSE 'en' END AS language,
 CASE WHEN doc_id % 11 <> 1 THEN 'https://example.com/' || doc_id END AS source_url FROM documents""")
def q_article_validate(spark, d):
    out = validate.validate(article_payloads(spark, d), "article")
    return out.select("doc_id", F.array_join(F.transform("errors", lambda e: F.concat_ws(":", e["field"], e["code"])), ",").alias("errors"), F.col("record.language").alias("language"), F.col("record.source_url").alias("source_url"))


@query("""SELECT CASE WHEN o_orderkey % 5 IN (1, 3, 4) THEN 'bad' ELSE 'ok' END AS verdict, count(*) AS n FROM orders GROUP BY 1""")
def q_product_validate(spark, d):
    k = F.col("o_orderkey") % 5
    payload = F.concat(F.lit('{"source": "s", "source_url": "https://a.b/c", "source_id": "1", "name": "n", "in_stock": '), F.when(k == 1, "2").when(k == 2, '"yes"').otherwise("true"), F.lit(', "price": '), F.when(k == 3, "0").when(k == 2, '"29.90"').otherwise("12.5"), F.lit(', "currency": '), F.when(k == 4, '"usd"').otherwise("null"), F.lit("}"))
    out = validate.validate(table(spark, d, "orders").select(payload.alias("payload")), "product")
    return out.groupBy(F.when(F.size("errors") > 0, "bad").otherwise("ok").alias("verdict")).agg(F.count("*").alias("n"))


@query("""SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN 'lorem ipsum' WHEN doc_id % 4 = 1 THEN 'page not found' END AS marker FROM documents""")
def q_placeholder_soft_hard(spark, d):
    k = F.col("doc_id") % 4
    body = F.when(k == 0, F.concat(F.lit("LOREM ipsum "), F.rpad(F.lit(""), 600, "x"))).when(k == 1, F.rpad(F.lit("Page not found"), 499, "x")).when(k == 2, F.rpad(F.lit("Page not found"), 500, "x")).otherwise("fine")
    return table(spark, d, "documents").select("doc_id", text.placeholder(body).alias("marker"))


@query("""SELECT language, count(*) AS n FROM (SELECT CASE WHEN doc_id % 3 = 2 THEN 'Klingon' ELSE lang END AS language FROM documents) GROUP BY language""")
def q_language_normalise(spark, d):
    names = F.create_map(*[F.lit(x) for k, v in text.LANGUAGES.items() for x in (v, k)])
    k = F.col("doc_id") % 3
    c = F.when(k == 0, F.concat(F.lit(" "), F.initcap(F.element_at(names, F.col("lang"))))).when(k == 1, F.col("lang")).otherwise("Klingon")
    return table(spark, d, "documents").groupBy(text.language_code(c).alias("language")).agg(F.count("*").alias("n"))


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 4 THEN NULL ELSE date_trunc('day', o_orderdate) END AS parsed FROM orders""")
def q_date_normalise(spark, d):
    t, k = F.col("o_orderdate"), F.col("o_orderkey") % 5
    s = F.when(k == 0, F.date_format(t, "MMM d, yyyy")).when(k == 1, F.date_format(t, "MMMM d, yyyy")).when(k == 2, F.date_format(t, "yyyy-MM-dd")).when(k == 3, F.concat(F.lit(" "), F.date_format(t, "yyyy-MM-dd'T00:00:00Z'"))).otherwise("15/03/2026")
    return table(spark, d, "orders").select("o_orderkey", text.date_value(s).cast("timestamp_ntz").alias("parsed"))


@query("""SELECT p_partkey, CASE p_partkey % 6 WHEN 0 THEN printf('%d.50', p_size) WHEN 1 THEN printf('%d.50', p_size) WHEN 4 THEN printf('%d345.67', p_size) END AS price_text,
 CASE p_partkey % 6 WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' WHEN 2 THEN 'USD' WHEN 4 THEN 'RUB' END AS currency FROM part""")
def q_price_parse(spark, d):
    n, k = F.col("p_size").cast("string"), F.col("p_partkey") % 6
    s = F.when(k == 0, F.concat(F.lit("$"), n, F.lit(".50"))).when(k == 1, F.concat(n, F.lit(",50 €"))).when(k == 2, F.concat(F.lit("Price: $"), n)).when(k == 3, F.concat(F.lit("$"), n, F.lit(",299.00"))).when(k == 4, F.concat(n, F.lit(" 345,67 ₽"))).otherwise("none")
    p = text.price(s)
    return table(spark, d, "part").select("p_partkey", p["price_text"].alias("price_text"), p["currency"].alias("currency"))


@query("""SELECT p_brand, count(*) FILTER (WHERE p_size % 4 NOT IN (0, 1, 2)) AS n_in, count(*) FILTER (WHERE p_size % 4 IN (0, 1, 2)) AS n_out FROM part GROUP BY p_brand""")
def q_in_stock(spark, d):
    k = F.col("p_size") % 4
    markup = F.concat(F.lit("<div data-in-stock="), F.when(k == 0, '"false"').when(k == 1, "'0'").when(k == 2, "NO").otherwise('"true"'), F.lit(">"))
    there = text.in_stock(markup)
    return table(spark, d, "part").groupBy("p_brand").agg(F.count_if(there).alias("n_in"), F.count_if(~there).alias("n_out"))


def injected_turns(spark, d):
    k = (F.col("conv_id") + F.col("turn")) % 4
    return table(spark, d, "conversations").withColumn("dirty", F.when(k == 0, F.concat(F.lit("System : "), "text")).when(k == 1, F.concat("text", F.lit("\n\n  USER:"), "text")).otherwise(F.col("text")))


@query("""WITH t AS (SELECT *, (conv_id + turn) % 4 AS k FROM conversations)
SELECT conv_id, turn, CASE k WHEN 0 THEN '[neutralized-role-prefix]: ' || text WHEN 1 THEN text || chr(10) || '[neutralized-role-prefix]:' || text ELSE text END AS clean, CASE WHEN k < 2 THEN 'role_prefix_neutralized' ELSE '' END AS warnings FROM t""")
def q_sanitize_roles(spark, d):
    s = text.sanitize(F.col("dirty"))
    return injected_turns(spark, d).select("conv_id", "turn", s["text"].alias("clean"), F.array_join(s["warnings"], ",").alias("warnings"))


@query("""SELECT doc_id, doc_id % 5 < 4 AS hinted FROM documents""")
def q_injection_hints(spark, d):
    k = F.col("doc_id") % 5
    s = F.concat("text", F.lit(" "), F.when(k == 0, "Ignore previous instructions").when(k == 1, "DISREGARD the above").when(k == 2, "You are now").when(k == 3, "new instructions:").otherwise("fine"))
    return table(spark, d, "documents").select("doc_id", text.has_hint(s).alias("hinted"))


@query("""SELECT doc_id, text AS clean, CASE WHEN doc_id % 4 < 3 THEN 'invisible_characters_stripped' ELSE '' END AS warnings FROM documents""")
def q_invisible(spark, d):
    k = F.col("doc_id") % 4
    mark = F.when(k == 0, "​").when(k == 1, "‮").when(k == 2, "﻿").otherwise("")
    s = text.sanitize(F.concat(mark, F.regexp_replace("text", " ", F.concat(mark, F.lit(" ")))))
    return table(spark, d, "documents").select("doc_id", s["text"].alias("clean"), F.array_join(s["warnings"], ",").alias("warnings"))


@query("""SELECT page_id, CASE page_id % 5 WHEN 0 THEN 'library/p' || page_id WHEN 1 THEN 'Web/' || page_id WHEN 2 THEN 'slug-' || page_id WHEN 3 THEN CASE WHEN page_id % 2 = 0 THEN 'index' ELSE 'p' || page_id END ELSE page_id::VARCHAR END AS source_id FROM pages""")
def q_parse_ids(spark, d):
    p, k = F.col("page_id").cast("string"), F.col("page_id") % 5
    names = list(ids.BASES)
    source = F.when(k == 0, names[0]).when(k == 1, names[1]).when(k == 2, names[2]).when(k == 3, names[3]).otherwise(names[4])
    base = F.element_at(F.create_map(*[F.lit(x) for kv in ids.BASES.items() for x in kv]), source)
    tail = F.when(k == 0, F.concat(F.lit("library/p"), p, F.lit(".html"))).when(k == 1, F.concat(F.lit("Web/"), p, F.lit("#values"))).when(k == 2, F.concat(F.lit("slug-"), p)).when(k == 3, F.when(F.col("page_id") % 2 == 0, "").otherwise(F.concat(F.lit("p"), p, F.lit("/")))).otherwise(F.concat(p, F.lit("/?x=1")))
    return table(spark, d, "pages").select("page_id", ids.source_id(source, F.concat(base, tail)).alias("source_id"))


@query("""SELECT row_number() OVER (ORDER BY doc_id) + 7 AS id, source, doc_id::VARCHAR AS source_id, sha256('{"n":' || n_chars || ',"source":"' || source || '"}') AS content_hash FROM documents""")
def q_raw_append_hash(spark, d):
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("seq"), "source", F.col("doc_id").cast("string").alias("source_id"), F.lit("u").alias("url"), F.to_json(F.struct("source", F.col("n_chars").alias("n"))).alias("payload"))
    return store.record_attempts(docs, 7, now(), "t").select("id", "source", "source_id", "content_hash")


@query("""SELECT sha256(text) AS content_hash, count(*) AS n, min(doc_id) AS first_id FROM documents GROUP BY 1 HAVING count(*) > 1""")
def q_dup_content(spark, d):
    return table(spark, d, "documents").groupBy(text.sha256(F.col("text")).alias("content_hash")).agg(F.count("*").alias("n"), F.min("doc_id").alias("first_id")).where("n > 1")


@query("""SELECT user_id, event_id AS raw_id, event_type, round(value, 4) AS value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events) WHERE rn = 1""")
def q_upsert_latest(spark, d):
    e = table(spark, d, "events").select("user_id", F.col("event_id").alias("raw_id"), "event_type", "value")
    return store.latest(e, "raw_id", ["user_id"]).withColumn("value", F.round("value", 4))


@query("""WITH v AS (SELECT p_partkey, p_name, p_size, CASE WHEN p_partkey % 3 = 0 THEN p_size + 1 ELSE p_size END AS size2, p_brand, CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE p_brand END AS brand2 FROM part)
SELECT p_partkey, 'size' AS field, p_size::VARCHAR AS old_value, size2::VARCHAR AS new_value FROM v WHERE p_size IS DISTINCT FROM size2
UNION ALL SELECT p_partkey, 'brand', '"' || p_brand || '"', coalesce('"' || brand2 || '"', 'null') FROM v WHERE p_brand IS DISTINCT FROM brand2""")
def q_change_history(spark, d):
    p = table(spark, d, "part")
    body = lambda size, brand: F.to_json(F.struct(F.col("p_name").alias("name"), size.alias("size"), brand.alias("brand")))
    key = F.col("p_partkey")
    one = p.select("p_partkey", F.lit(1).alias("seq"), store.field_values(body(F.col("p_size"), F.col("p_brand"))).alias("fields"))
    two = p.select("p_partkey", F.lit(2).alias("seq"), store.field_values(body(F.when(key % 3 == 0, F.col("p_size") + 1).otherwise(F.col("p_size")), F.when(key % 5 != 0, F.col("p_brand")))).alias("fields"))
    return store.successive_changes(one.unionByName(two), "seq", now(), ["p_partkey"]).select("p_partkey", "field", "old_value", "new_value")


def customers_fetched(spark, d):
    o = table(spark, d, "orders").groupBy("o_custkey").agg(F.max("o_orderdate").cast("timestamp").alias("scraped_at"))
    c = table(spark, d, "customer").select(F.lit("c").alias("source"), F.col("c_custkey").cast("string").alias("source_id"), "c_custkey")
    return c, o.select(F.lit("c").alias("source"), F.col("o_custkey").cast("string").alias("source_id"), "scraped_at")


@query(f"""SELECT c_custkey, round(date_diff('second', t, TIMESTAMP '{NOW}') / 86400.0, 4) AS age_days, coalesce(date_diff('second', t, TIMESTAMP '{NOW}') / 86400.0 <= 60, false) AS is_fresh
FROM customer LEFT JOIN (SELECT o_custkey, max(o_orderdate) AS t FROM orders GROUP BY 1) ON c_custkey = o_custkey""")
def q_freshness(spark, d):
    c, o = customers_fetched(spark, d)
    return store.freshness(c, o, now(), 60).select("c_custkey", F.round("age_days", 4).alias("age_days"), "is_fresh")


@query(f"""SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders GROUP BY 1 HAVING max(o_orderdate) >= TIMESTAMP '{NOW}' - INTERVAL 60 DAY)""")
def q_skip_fresh(spark, d):
    c, o = customers_fetched(spark, d)
    return store.freshness(c, o, now(), 60).where(~F.col("is_fresh")).select("c_custkey")


@query("""SELECT page_id, url FROM pages WHERE page_id % 3 <> 0""")
def q_unseen_urls(spark, d):
    p = table(spark, d, "pages").select("page_id", "url")
    return store.unseen(p, p.where("page_id % 3 = 0"), ["url"])


@query("""SELECT DISTINCT o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 5000)""")
def q_fresh_ids(spark, d):
    rich = table(spark, d, "customer").where("c_acctbal > 5000").select(F.col("c_custkey").alias("o_custkey"))
    return table(spark, d, "orders").join(rich, "o_custkey", "left_semi").select("o_orderkey")


@query("""SELECT e.event_id AS id, e.user_id, r.props AS raw_payload FROM (SELECT * FROM events WHERE event_type = 'error' ORDER BY ts DESC, event_id DESC LIMIT 10) e JOIN events r ON r.event_id = e.event_id""")
def q_failed_with_raw_top10(spark, d):
    e = table(spark, d, "events")
    failed = e.where("event_type = 'error'").select(F.col("event_id").alias("id"), F.col("event_id").alias("raw_id"), "user_id", F.col("ts").alias("detected_at"))
    raw = e.select(F.col("event_id").alias("id"), F.lit("").alias("source_id"), F.col("props").alias("raw_payload"))
    return reports.failures_with_raw(failed, raw).select("id", "user_id", "raw_payload")


def attempts(spark, d):
    return table(spark, d, "events").select(F.col("user_id").alias("source"), F.col("event_id").alias("seq"), F.when(F.col("event_id") % 2 == 0, "scrape").otherwise("http").alias("kind"), (F.col("event_type") != "error").alias("ok"))


GATE_SQL = """WITH a AS (SELECT user_id AS source, event_id AS seq, CASE WHEN event_id % 2 = 0 THEN 'scrape' ELSE 'http' END AS kind, event_type <> 'error' AS ok FROM events),
n AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY seq) AS pos FROM a),
u AS (SELECT *, coalesce(sum(CASE WHEN ok AND kind = 'scrape' THEN 5 ELSE 0 END) OVER w, 0)::BIGINT AS credits_used, coalesce(sum(CASE WHEN ok AND kind = 'http' THEN 1 ELSE 0 END) OVER w, 0)::BIGINT AS http_used,
 pos - 1 AS iterations, pos - 1 - coalesce(max(CASE WHEN ok THEN pos END) OVER w, 0) AS consecutive_errors FROM n WINDOW w AS (PARTITION BY source ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
g AS (SELECT *, CASE WHEN kind = 'scrape' AND credits_used + 5 > {credits} THEN 'cost cap reached' WHEN kind = 'http' AND http_used + 1 > {http} THEN 'HTTP cap reached' WHEN iterations >= {iterations} THEN 'iteration cap reached' WHEN consecutive_errors >= {errors} THEN 'circuit breaker tripped' END AS tripped FROM u)
"""


@query(GATE_SQL.format(credits=100, http=200, iterations=200, errors=2) + "SELECT source, seq, consecutive_errors, tripped FROM g")
def q_circuit_breaker(spark, d):
    return gate.gate(attempts(spark, d), gate.Budget(errors=2)).select("source", "seq", "consecutive_errors", "tripped")


@query(GATE_SQL.format(credits=12, http=3, iterations=8, errors=3) + "SELECT source, seq, credits_used, http_used, iterations, tripped FROM g")
def q_credit_cap(spark, d):
    return gate.gate(attempts(spark, d), gate.Budget(12, 8, 3, 3)).select("source", "seq", "credits_used", "http_used", "iterations", "tripped")


@query(GATE_SQL.format(credits=12, http=3, iterations=8, errors=3) + "SELECT source, seq, kind, ok FROM g WHERE seq < coalesce((SELECT min(seq) FROM g h WHERE h.source = g.source AND h.tripped IS NOT NULL), 9223372036854775807)")
def q_gate_prefix(spark, d):
    return gate.admitted(gate.gate(attempts(spark, d), gate.Budget(12, 8, 3, 3))).select("source", "seq", "kind", "ok")


@query("""SELECT event_id, round(coalesce(greatest(0.0, 3600.0 - (epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id))) / 1e6), 0.0), 3) AS wait_s FROM events""")
def q_rate_spacing(spark, d):
    return gate.required_wait(table(spark, d, "events"), 1 / 3600, "ts", ["user_id"]).select("event_id", F.round("wait_s", 3).alias("wait_s"))


@query("""WITH RECURSIVE n AS (SELECT event_id, event_type, epoch_us(ts) AS t, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS pos FROM events),
s AS (SELECT *, t AS start FROM n WHERE pos = 1 UNION ALL SELECT n.*, greatest(n.t, s.start + 1200000000) FROM s JOIN n ON n.event_type = s.event_type AND n.pos = s.pos + 1)
SELECT event_id, round((start - t) / 1e6, 3) AS wait_s FROM s""")
def q_rate_schedule(spark, d):
    return gate.schedule(table(spark, d, "events"), 1 / 1200, "ts", ["event_type"]).select("event_id", F.round("wait_s", 3).alias("wait_s"))


@query("""SELECT c_custkey, CASE s WHEN 7 THEN 'rules' WHEN 0 THEN 'rules' WHEN 1 THEN 'allow' WHEN 2 THEN 'allow' WHEN 3 THEN 'deny' WHEN 4 THEN 'deny' WHEN 5 THEN 'deny' ELSE 'deny' END AS verdict, s NOT IN (5, 6) AS cached FROM (SELECT c_custkey, c_custkey % 8 AS s FROM customer)""")
def q_robots_decision(spark, d):
    codes = [200, 404, 403, 429, 451, 503, None, 301]
    status = F.element_at(F.array(*[F.lit(x).cast("int") for x in codes]), (F.col("c_custkey") % 8 + 1).cast("int"))
    v = robots.status_verdict(status)
    return table(spark, d, "customer").select("c_custkey", v["verdict"].alias("verdict"), v["cached"].alias("cached"))


ROBOTS_SQL = """WITH u AS (SELECT page_id, url, regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) AS host, regexp_extract(url, '^[a-z]+://[^/?#]*(.*)$', 1) AS path FROM pages),
f AS (SELECT host, min(page_id) AS first, min(regexp_extract(path, '^/[^/]*', 0)) AS lang, max(path) AS last FROM u GROUP BY host)
"""


@query(ROBOTS_SQL + """SELECT page_id, CASE first % 4 WHEN 0 THEN starts_with(path, lang || '/') WHEN 1 THEN NOT starts_with(path, lang || '/') OR contains(path, '?') AND path = last WHEN 2 THEN path <> last ELSE true END AS allowed,
 CASE first % 4 WHEN 0 THEN (1 + first % 7)::DOUBLE WHEN 1 THEN 2.0 END AS delay FROM u JOIN f USING (host)""")
def q_robots_rules(spark, d):
    """A file for each host, made of its pages' paths: rules for others, for all and for this agent, in one group or some."""
    host = F.regexp_extract("url", r"^([a-z]+://[^/?#]*)", 1)
    path = F.regexp_extract("url", r"^[a-z]+://[^/?#]*(.*)$", 1)
    urls = table(spark, d, "pages").select("page_id", "url")
    hosts = urls.select(host.alias("host"), "page_id", path.alias("path")).groupBy("host").agg(F.min("page_id").alias("first"), F.min(F.regexp_extract("path", "^/[^/]*", 0)).alias("lang"), F.max("path").alias("last"))
    k, lang, last = F.col("first") % 4, F.col("lang"), F.col("last")
    lines = lambda *xs: F.concat_ws("\n", *[x if isinstance(x, Column) else F.lit(x) for x in xs])
    body = (
        F.when(k == 0, lines("User-agent: other", "Disallow: /", "", "User-Agent: *  # all", F.concat(F.lit("Allow: "), lang, F.lit("/")), "Disallow: /", F.concat(F.lit("Crawl-delay: "), (1 + F.col("first") % 7).cast("string"))))
        .when(k == 1, lines("User-agent: *", "Disallow: /", "Crawl-delay: 9", "", "user-agent: x", "User-agent: GRANARY", "Sitemap: /s", F.concat(F.lit("allow: "), F.when(last.contains("?"), last).otherwise("/none")), F.concat(F.lit("Disallow:"), lang, F.lit("/")), "Crawl-delay: 2", "Crawl-delay: two"))
        .when(k == 2, lines("Disallow: /", "User-agent: *", "", "User-agent: gran", F.concat(F.lit("Disallow: "), last), ""))
        .otherwise(lines("User-agent: *", "Disallow:", "User-agent: granary", "", "Disallow: /"))
    )
    files = hosts.select(F.concat("host", F.lit("/robots.txt")).alias("robots_url"), F.lit(200).alias("status"), body.alias("body"))
    return robots.decide(urls, files, now()).select("page_id", "allowed", "delay")


@query("""WITH p AS (SELECT c_nationkey AS source, (row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1) // 3 AS page FROM customer),
q AS (SELECT source, page, count(*) AS n_items FROM p GROUP BY 1, 2), r AS (SELECT *, sum(n_items) OVER (PARTITION BY source ORDER BY page) AS seen FROM q),
e AS (SELECT *, n_items < 3 OR seen >= 7 OR page + 1 >= 4 AS ends FROM r)
SELECT source, page, n_items, seen FROM e WHERE NOT EXISTS (SELECT 1 FROM e f WHERE f.source = e.source AND f.page < e.page AND f.ends)""")
def q_pagination(spark, d):
    from pyspark.sql import window as W

    rank = F.row_number().over(W.Window.partitionBy("c_nationkey").orderBy("c_custkey")) - 1
    pages = table(spark, d, "customer").select(F.col("c_nationkey").alias("source"), F.floor(rank / 3).alias("page")).groupBy("source", "page").agg(F.count("*").alias("n_items")).withColumn("total", F.lit(7))
    return listing.pages_read(pages, 3, 4, ["source"]).select("source", "page", "n_items", "seen")


BUCKET = ["canonical", "validation_failed", "skipped_robots", "errors", "skipped_fresh"]
TYPES = ["view", "click", "signup", "error", "purchase"]


@query("SELECT user_id, " + ", ".join(f"count(*) FILTER (WHERE event_type = '{t}') AS {b}" for b, t in zip(BUCKET, TYPES)) + ", count(*) AS iterated FROM events GROUP BY user_id")
def q_bucket_counts(spark, d):
    named = F.element_at(F.create_map(*[F.lit(x) for b, t in zip(BUCKET, TYPES) for x in (t, b)]), F.col("event_type"))
    return reports.bucket_counts(table(spark, d, "events").withColumn("bucket", named), ["user_id"], BUCKET)


@query("""SELECT source, coalesce(a, 0) AS n_canonical, coalesce(b, 0) AS n_unresolved FROM (SELECT source, count(*) AS a FROM documents WHERE doc_id % 3 > 0 GROUP BY 1) FULL JOIN
 (SELECT source, count(*) FILTER (WHERE doc_id % 2 = 0) AS b FROM documents WHERE doc_id % 3 = 0 GROUP BY 1) USING (source)""")
def q_state_counts(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "source", F.when(F.col("doc_id") % 2 > 0, "fixed").alias("resolution"))
    return reports.state_counts(docs.where("doc_id % 3 > 0"), docs.where("doc_id % 3 = 0"))


@query("""SELECT l_returnflag AS source, l_linestatus AS source_id, l_linenumber::VARCHAR AS field, count(*) AS n_changes, grouping(l_returnflag, l_linestatus, l_linenumber)::BIGINT AS level FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus, l_linenumber)""")
def q_change_rollup(spark, d):
    li = table(spark, d, "lineitem").select(F.col("l_returnflag").alias("source"), F.col("l_linestatus").alias("source_id"), F.col("l_linenumber").cast("string").alias("field"))
    return reports.change_rollup(li)


@query("""SELECT date_trunc('month', l_shipdate)::DATE AS month, count(*) AS n_changes, count(*) > 50 AS over_limit FROM lineitem GROUP BY 1""")
def q_change_rate(spark, d):
    return reports.change_rate(table(spark, d, "lineitem").withColumnRenamed("l_shipdate", "changed_at"))


@query("""SELECT user_id, count(*) AS n_spans, count(*) FILTER (WHERE event_type = 'error') AS n_errors, round(quantile_cont(value, 0.5), 4) AS p50, round(quantile_cont(value, 0.95), 4) AS p95, round(max(value), 4) AS longest FROM events GROUP BY user_id""")
def q_trace_report(spark, d):
    spans = table(spark, d, "events").withColumn("status", F.when(F.col("event_type") == "error", "error").otherwise("ok"))
    out = reports.trace_report(spans, ["user_id"], "value")
    return out.select("user_id", "n_spans", "n_errors", *[F.round(c, 4).alias(c) for c in ("p50", "p95", "longest")])


@query("""SELECT event_type, count(*) AS n_spans, count(*) FILTER (WHERE event_type = 'error') AS n_errors, round(max(value), 4) AS longest, true AS p50_near, true AS p95_near FROM events GROUP BY event_type""")
def q_trace_sketches(spark, d):
    """Days' sketches brought together; the ranks of their quantiles are looked up in the table itself."""
    spans = table(spark, d, "events").withColumn("status", F.when(F.col("event_type") == "error", "error").otherwise("ok"))
    out = reports.report_of_sketches(reports.latency_sketches(spans, ["event_type"], "ts", "value"), ["event_type"])
    near = lambda q, p: (F.abs(F.count_if(F.col("value") <= F.col(q)) / F.count("value") - p) < 0.025).alias(f"{q}_near")
    ranks = spans.select("event_type", "value").join(out, "event_type").groupBy("event_type").agg(F.first("n_spans").alias("n_spans"), F.first("n_errors").alias("n_errors"), F.round(F.first("longest"), 4).alias("longest"), near("p50", 0.5), near("p95", 0.95))
    return ranks


@query("""SELECT event_id, round(count(*) FILTER (WHERE event_type = 'error') OVER w / count(*) OVER w, 6) AS ratio FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 24 HOUR PRECEDING AND CURRENT ROW)""")
def q_failure_ratio_24h(spark, d):
    return reports.failure_ratio(table(spark, d, "events"), "ts", F.col("event_type") == "error", ["user_id"]).select("event_id", F.round("ratio", 6).alias("ratio"))


@query("""SELECT event_id, user_id FROM events WHERE (props::JSON ->> '$.k')::INT = 7""")
def q_trace_filter(spark, d):
    return table(spark, d, "events").where(F.try_variant_get(F.parse_json("props"), "$.k", "int") == 7).select("event_id", "user_id")


@query("""WITH b AS (SELECT user_id AS source, event_id // 100 AS batch, max((event_type = 'error')::INT) AS had FROM events GROUP BY 1, 2)
SELECT source, batch, avg(had) OVER (PARTITION BY source ORDER BY batch ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) > 1.0 / 3 AS escalate, had FROM b""")
def q_timeout_escalation(spark, d):
    e = table(spark, d, "events").select(F.col("user_id").alias("source"), F.floor(F.col("event_id") / 100).alias("batch"), (F.col("event_type") == "error").alias("is_timeout"))
    return reports.timeout_escalation(e).select("source", "batch", "escalate", "had")


@query("""SELECT c_custkey::VARCHAR AS source_id, CASE WHEN o_custkey IS NULL THEN NULL ELSE t END AS scraped_at FROM customer JOIN (SELECT o_custkey, max(o_orderkey) AS k, max_by(o_orderdate, o_orderkey) AS t FROM orders GROUP BY 1) ON c_custkey = o_custkey""")
def q_last_scraped(spark, d):
    o = table(spark, d, "orders")
    raw = o.select(F.col("o_orderkey").alias("id"), F.col("o_orderdate").alias("scraped_at"))
    versions = o.select(F.lit("c").alias("source"), F.col("o_custkey").cast("string").alias("source_id"), F.col("o_orderkey").alias("raw_id"))
    return store.last_scraped(store.latest(versions, "raw_id"), raw).select("source_id", "scraped_at")


@query("""SELECT o_orderkey AS id, CASE WHEN o_orderkey % 10 = 0 THEN 'discarded' END AS resolution FROM orders""")
def q_resolve_failures(spark, d):
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.lit(None).cast("timestamp").alias("resolved_at"), F.lit(None).cast("string").alias("resolution"))
    out = store.resolve(o, o.where("id % 10 = 0").select("id", F.lit("discarded").alias("resolution")), now())
    return out.select("id", "resolution").where(F.col("resolution").isNotNull() | F.col("id").isNotNull())


@query("""SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN 'new-' || c_custkey ELSE c_custkey::VARCHAR END AS source_id FROM customer""")
def q_rename_keys(spark, d):
    c = table(spark, d, "customer").select(F.lit("c").alias("source"), F.col("c_custkey").cast("string").alias("source_id"), F.lit("u").alias("url"), "c_custkey")
    names = c.where("c_custkey % 4 = 0").select("source", "source_id", F.concat(F.lit("new-"), "source_id").alias("new_id"))
    return store.rename_keys(c, names).select("c_custkey", "source_id")


@query("""SELECT count(*) AS total, count(*) FILTER (WHERE regexp_matches(url, '^https?://[^/]+/[^/?#]+/?$')) AS matching, count(*) FILTER (WHERE regexp_matches(url, '^https?://[^/]+/[^/?#]+/?$') AND page_id % 2 = 1) AS "new" FROM pages""")
def q_discovered(spark, d):
    from granary.sources import files

    p = table(spark, d, "pages")
    host = F.regexp_extract("url", "^(https?://[^/]+/)", 1)
    slug = F.regexp_replace(F.regexp_replace("url", "^https?://[^/]+/", ""), "/$", "")
    keep = (host != "") & (slug != "") & ~slug.rlike("[/#?]")
    return files.discovered(p, p.where("page_id % 2 = 0"), keep)


@query("""SELECT doc_id, count(*) AS n_blocks FROM (SELECT doc_id, unnest(range(doc_id % 4)) FROM documents) GROUP BY doc_id UNION ALL SELECT doc_id, 0 FROM documents WHERE doc_id % 4 = 0""")
def q_code_blocks(spark, d):
    md = F.concat("text", F.repeat(F.lit("\n```py\nx = 1\n```\n"), (F.col("doc_id") % 4).cast("int")))
    return table(spark, d, "documents").select("doc_id", text.code_blocks(md).cast("long").alias("n_blocks"))


@query("""SELECT source, n FROM (SELECT source, count(*) AS n FROM documents GROUP BY source ORDER BY n DESC, source LIMIT 50)""")
def q_read_only_sql(spark, d):
    table(spark, d, "documents").createOrReplaceTempView("granary_documents")
    return store.read_only_sql(spark, "SELECT source, count(*) AS n FROM granary_documents GROUP BY source ORDER BY n DESC, source")


@query("""SELECT doc_id FROM documents WHERE lang = 'en' AND doc_id >= 100 AND contains(lower(text), 'the')""")
def q_language_recency_text(spark, d):
    return table(spark, d, "documents").where((F.col("lang") == "en") & (F.col("doc_id") >= 100) & F.lower("text").contains("the")).select("doc_id")


def steps(start: str, *replaced: tuple[str, str]) -> str:
    """SQL that replaces one pattern after the other in a text."""
    for pattern, to in replaced:
        start = f"regexp_replace({start}, {pattern}, {to}, 'gs')"
    return start


def decoded(text: str) -> str:
    """SQL without the pages' character references."""
    return f"replace(replace(replace(replace({text}, '&copy;', '©'), '&middot;', '·'), '&quot;', '\"'), '&amp;', '&')"


#: What a page's Markdown is, for the elements that the tables' pages have.
MARKDOWN = steps(
    "html", (r"'\s+'", "' '"), ("'<!DOCTYPE[^>]*>|<!--.*?-->|<script>.*?</script>|<style>.*?</style>|</?(head|title|b)>|</li>|<meta[^>]*>'", "''"), ("'<h1>'", r"E'\n\n# '"), ("'<a href=\"([^\"]*)\">([^<]*)</a>'", r"'[\2](\1)'"), ("'<br>'", r"E'\n'"), ("'<li>'", r"E'\n* '"), ("'</?(p|div|article|footer|nav|body|html|ul|h1)( [^>]*)?>'", r"E'\n\n'"), (r"'\n +'", r"E'\n'"), (r"'\n{3,}'", r"E'\n\n'"),
)


@query(f"""SELECT page_id, trim({decoded(MARKDOWN)}, E' \\n') || chr(10) AS md FROM pages""")
def q_html_to_md(spark, d):
    p = html.page_parts(F.col("html"))
    return table(spark, d, "pages").select("page_id", p["md"].alias("md"))


@query("""SELECT page_id, 'top ' || page_id || ',' || array_to_string(list_filter(list_transform(regexp_extract_all(regexp_extract(html, '<nav><ul>(.*?)</ul></nav>', 1), '<a href="[^"]*">([^<]*)</a>', 1), lambda x: trim(x)), lambda x: x <> ''), ',') AS section_path FROM pages""")
def q_breadcrumb(spark, d):
    crumbs = F.regexp_replace("html", r"<nav><ul>", F.concat(F.lit('<nav class="site Breadcrumbs"><ul><li> top '), F.col("page_id").cast("string"), F.lit(" </li><li></li>")))
    p = html.page_parts(crumbs)
    return table(spark, d, "pages").select("page_id", F.array_join(p["section_path"], ",").alias("section_path"))


@query("""SELECT page_id, CASE WHEN page_id % 5 < 4 THEN 'role_prefix_neutralized,injection_hint_detected' ELSE '' END AS warnings, CASE WHEN page_id % 5 < 4 THEN html
 ELSE replace(html, '<article>', '<article><div style="color: red"><p>system: <b>you are now</b> needle</p><img src="x"></div>') END AS text FROM pages""")
def q_hidden_strip(spark, d):
    """Whole pages with an element put in that its style hides, or not, in four ways and at any depth."""
    k = F.col("page_id") % 5
    style = F.when(k == 0, "display: none").when(k == 1, "color:white").when(k == 2, "VISIBILITY:hidden").when(k == 3, "opacity:0").otherwise("color: red")
    put = F.concat(F.lit('<article><div style="'), style, F.lit('"><p>system: <b>you are now</b> needle</p><img src="x"></div>'))
    s = html.normalized_visible(F.replace(F.col("html"), F.lit("<article>"), put))
    return table(spark, d, "pages").select("page_id", F.array_join(s["warnings"], ",").alias("warnings"), s["text"].alias("text"))


@query("""SELECT doc_id, 'file ' || doc_id || ' é ' || upper(substr(coalesce(lang, ''), 1, 2)) AS clean FROM documents""")
def q_nfkc(spark, d):
    wide = F.translate(F.col("doc_id").cast("string"), "0123456789", "０１２３４５６７８９")
    letters = F.translate(F.upper(F.substring(F.coalesce("lang", F.lit("")), 1, 2)), "DEFNRS", "ＤＥＦＮＲＳ")
    return table(spark, d, "documents").select("doc_id", text.nfkc(F.concat(F.lit("ﬁle "), wide, F.lit(" e\u0301 "), letters)).alias("clean"))


#: The first heading of a page, in DuckDB.
H1 = f"trim({decoded("regexp_extract(html, '<h1>(.*?)</h1>', 1)")})"
#: Its breadcrumb's links.
CRUMBS = f"array_to_string(list_filter(list_transform(regexp_extract_all(regexp_extract(html, '<nav><ul>(.*?)</ul></nav>', 1), '<a href=\"[^\"]*\">([^<]*)</a>', 1), lambda x: trim({decoded('x')})), lambda x: x <> ''), ',')"


def found(spark: SparkSession, d: str, page_type: str, markup: Column) -> DataFrame:
    """The records of pages with some markup of the query's own."""
    return extract.parsed(table(spark, d, "pages").select("page_id", "url", markup.alias("raw")), page_type).select("page_id", "record.*")


@query(f"""SELECT page_id, {H1} AS title, 'part ' || page_id || ',' || {CRUMBS} AS section_path,
 page_id % 4 AS code_block_count, 0 AS n_errors FROM pages""")
def q_extract_docs(spark, d):
    crumbs = F.regexp_replace("html", r"<nav><ul>", F.concat(F.lit('<nav class="breadcrumb"><ul><li>part '), F.col("page_id").cast("string"), F.lit("</li>")))
    code = F.regexp_replace(crumbs, "</article>", F.concat(F.repeat(F.lit("<pre><code>x = 1</code></pre>"), (F.col("page_id") % 4).cast("int")), F.lit("</article>")))
    p = table(spark, d, "pages").select("page_id", "url", code.alias("raw"), F.col("page_id").cast("string").alias("source_id"))
    out = validate.validate(extract.local(p, "docs"), "docs")
    return out.select("page_id", "record.title", F.array_join("record.section_path", ",").alias("section_path"), F.col("record.code_block_count").cast("long").alias("code_block_count"), F.size("errors").alias("n_errors"))


@query(f"""SELECT page_id, replace({H1}, 'By', 'by') AS title, CASE WHEN page_id % 3 = 0 THEN 'Ann Smith' END AS author, CASE WHEN page_id % 2 = 0 THEN '2024-01-0' || (1 + page_id % 9) END AS published_at,
 coalesce(nullif(regexp_extract(html, '(?i)<html[^>]+lang=["'']([a-z]{{2}})["'']', 1), ''), 'en') AS language, contains(html, '<p>') AS has_body,
 substr(sha256(url), 1, 16) AS source_id FROM pages""")
def q_extract_article(spark, d):
    k = F.col("page_id")
    date = F.when(k % 2 == 0, F.concat(F.lit("2024-01-0"), (1 + k % 9).cast("string"))).otherwise("")
    head = F.regexp_replace(F.replace("html", F.lit("By"), F.lit("by")), "<style>", F.concat(F.lit('<meta property="article:published_time" content="'), date, F.lit('"><style>')))
    return found(spark, d, "article", F.regexp_replace(head, "<article>", F.when(k % 3 == 0, "<article><p>By  Ann Smith</p>").otherwise("<article>"))).select("page_id", "title", "author", "published_at", "language", (F.length("body_md") > 10).alias("has_body"), "source_id")


@query(f"""SELECT page_id, replace({H1}, '$', '') AS name, CASE WHEN page_id % 3 = 0 THEN page_id || '.5' WHEN page_id % 3 = 1 THEN (page_id + 1) || '.25' END AS price, CASE WHEN page_id % 3 = 0 THEN 'USD' WHEN page_id % 3 = 1 THEN 'EUR' END AS currency,
 page_id % 4 <> 1 AS in_stock FROM pages""")
def q_extract_product(spark, d):
    k = F.col("page_id")
    price = F.when(k % 3 == 0, F.concat(F.lit("price:$"), k.cast("string"), F.lit(".5"))).when(k % 3 == 1, F.concat(F.lit("price:"), (k + 1).cast("string"), F.lit(",25 €"))).otherwise("no price")
    stock = F.when(k % 4 == 1, "false").when(k % 4 == 2, "true").otherwise("1")
    return found(spark, d, "product", F.concat(F.lit("<html><body><h1>"), F.translate(F.regexp_extract("html", "<h1>(.*?)</h1>", 1), "$", ""), F.lit("</h1><p data-in-stock='"), stock, F.lit("'>"), price, F.lit("</p></body></html>"))).select("page_id", "name", "price", "currency", "in_stock")


@query(f"""SELECT page_id, {H1} AS term, 0 AS n_examples, true AS no_date FROM pages""")
def q_extract_reference(spark, d):
    title = F.concat(F.when(F.col("page_id") % 2 == 0, "Glossary: ").otherwise(""), F.regexp_extract("html", "<h1>(.*?)</h1>", 1))
    return found(spark, d, "reference", F.concat(F.lit("<html><body><h1>"), title, F.lit("</h1><p>what it is</p></body></html>"))).select("page_id", "term", F.size("examples").alias("n_examples"), F.col("last_updated").isNull().alias("no_date"))


@query("""SELECT page_id, CASE WHEN page_id % 4 = 0 THEN 1.0 * (1 + page_id % 7) WHEN page_id % 4 = 1 THEN 2.0 WHEN page_id % 4 = 2 THEN 2.0 END::DOUBLE AS delay FROM pages""")
def q_crawl_delay(spark, d):
    k = F.col("page_id") % 4
    own = F.when(k == 0, (1 + F.col("page_id") % 7).cast("double")).when(k == 1, 0.0)
    return table(spark, d, "pages").select("page_id", robots.crawl_delay(own, F.when(k < 3, 2.0)).alias("delay"))


@query("""SELECT doc_id FROM documents WHERE doc_id % 20 > 10""")
def q_payload_filter(spark, d):
    k = F.col("doc_id")
    records = table(spark, d, "documents").select("doc_id", F.when(k % 20 == 3, "no json").otherwise(F.to_json(F.struct(F.col("text").alias("body_md"), (k % 20).alias("code_block_count")))).alias("payload"))
    return reports.with_payload_field(records, "$.code_block_count", "int", lambda n: n > 10).select("doc_id")


@query("""SELECT c_custkey, c_custkey % 4 = 0 AS has_required FROM customer""")
def q_required_keys(spark, d):
    from granary.operators import fetch

    k = F.col("c_custkey")
    whole = F.to_json(F.struct(F.lit("c").alias("source"), k.cast("string").alias("source_id"), F.col("c_name").alias("source_url")))
    payload = F.when(k % 4 == 0, whole).when(k % 4 == 1, F.to_json(F.struct(F.lit("c").alias("source")))).when(k % 4 == 2, F.concat(F.lit("["), whole, F.lit("]")))
    return table(spark, d, "customer").select("c_custkey", fetch.has_required(payload).alias("has_required"))


@query("""SELECT date_trunc('month', o_orderdate)::DATE AS month, count(*) AS n_changes, (SELECT count(*) FROM customer) AS n_records, count(*) > 0.1 * (SELECT count(*) FROM customer) AS over_share FROM orders GROUP BY 1""")
def q_change_share(spark, d):
    return reports.change_share(table(spark, d, "orders").select(F.col("o_orderdate").alias("changed_at")), table(spark, d, "customer"))


@query("""SELECT event_type, count(*) AS n_spans, count(*) FILTER (WHERE event_type = 'error') AS n_errors, sum(event_id % 3 * 5)::BIGINT AS credits FROM events GROUP BY event_type""")
def q_trace_credits(spark, d):
    e = table(spark, d, "events").select("event_type", F.when(F.col("event_type") == "error", "error").otherwise("ok").alias("status"), F.col("event_id").alias("duration_ms"), (F.col("event_id") % 3 * 5).alias("credits"))
    return reports.trace_report(e, ["event_type"], credits=F.col("credits")).select("event_type", "n_spans", "n_errors", "credits")


@query("""SELECT c_custkey, 'https://dummyjson.com/products?limit=30&skip=' || (c_custkey * 30) AS url FROM customer""")
def q_listing_urls(spark, d):
    return table(spark, d, "customer").select("c_custkey", ids.listing_url(30, F.col("c_custkey") * 30).alias("url"))


@query("""SELECT page_id, page_id % 6 IN (0, 1) AS is_article FROM pages""")
def q_article_urls(spark, d):
    k = F.col("page_id") % 6
    tail = F.when(k == 0, "a-slug").when(k == 1, "slug/").when(k == 2, "").when(k == 3, "a/b").when(k == 4, "a?b").otherwise("a#b")
    return table(spark, d, "pages").select("page_id", ids.is_article_url(F.concat(F.lit("https://x.y/news/"), tail), "https://x.y/news/").alias("is_article"))


@query("""SELECT event_id, event_id % 4 <> 0 AS unsafe, CASE event_id % 4 WHEN 0 THEN 'a ' || event_type WHEN 1 THEN 'b' WHEN 2 THEN 'unparseable output: maybe' ELSE 'unparseable output: ' END AS reason FROM events""")
def q_guard_verdicts(spark, d):
    k = F.col("event_id") % 4
    answer = F.when(k == 0, F.concat(F.lit("SAFE: a "), "event_type")).when(k == 1, " unsafe: b ").when(k == 2, "maybe")
    v = text.verdict(answer)
    return table(spark, d, "events").select("event_id", v["unsafe"].alias("unsafe"), v["reason"].alias("reason"))


@query("""SELECT p_partkey, p_name AS term FROM part""")
def q_term_prefix(spark, d):
    k = F.col("p_partkey") % 3
    return table(spark, d, "part").select("p_partkey", text.term(F.concat(F.when(k == 0, "Glossary: ").when(k == 1, "faq:  ").otherwise(""), "p_name")).alias("term"))


@query("""SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 'Ann Smith' END AS author FROM customer""")
def q_author_byline(spark, d):
    md = F.when(F.col("c_custkey") % 2 == 0, F.concat(F.lit("# T\nBy  Ann Smith\n"), F.col("c_name"))).otherwise(F.concat(F.lit("by nobody, Byron "), F.col("c_name")))
    return table(spark, d, "customer").select("c_custkey", text.byline(md).alias("author"))


def seed_rows() -> str:
    from granary.sources.adapters import ADAPTERS

    return ", ".join(f"('{a.name}', {i}, '{u}')" for a in ADAPTERS.values() for i, u in enumerate(a.seeds))


@query(f"""SELECT page_id, source, url, CASE source WHEN 'docs_python_org' THEN regexp_extract(url, '^https://docs[.]python[.]org/3/(.*)[.]html$', 1) WHEN 'developer_mozilla_org' THEN regexp_extract(url, '/en-US/docs/(.*)$', 1)
 WHEN 'scrapethissite_com' THEN coalesce(nullif(regexp_extract(url, '/pages/([^/]*)/?$', 1), ''), 'index') ELSE regexp_extract(url, '/news/(.*)$', 1) END AS source_id
 FROM pages JOIN (SELECT *, count(*) OVER (PARTITION BY source) AS n FROM (VALUES {seed_rows()}) t(source, seq, url)) s ON page_id % n = seq""".replace("SELECT page_id, source, url", "SELECT page_id, source, s.url AS url").replace("(url,", "(s.url,"))
def q_seed_urls(spark, d):
    """A seed of each source for each page, in turn, with the id that the source gives it."""
    from functools import reduce

    from granary.sources.adapters import ADAPTERS

    seeds = reduce(DataFrame.unionByName, [a.ids(a.urls(spark)).withColumn("n", F.lit(len(a.seeds))) for a in ADAPTERS.values() if a.seeds])
    return table(spark, d, "pages").select("page_id").join(seeds, F.col("page_id") % F.col("n") == F.col("seq")).select("page_id", "source", "url", "source_id")


@query("""WITH h AS (SELECT page_id, regexp_replace(regexp_extract(url, '^[a-z]+://([^/?#]*)', 1), '^www\\.', '') AS host FROM pages), c AS (SELECT host, min(page_id) AS k FROM h GROUP BY host HAVING min(page_id) % 3 > 0)
SELECT page_id, k IS NOT NULL AS listed, (1 + k % 5)::DOUBLE AS rate_limit_rps, 'basis ' || k AS legal_basis FROM h LEFT JOIN c USING (host)""")
def q_config_lookup(spark, d):
    urls = table(spark, d, "pages").select("page_id", "url")
    hosts = urls.groupBy(ids.derived_source(F.col("url")).alias("domain")).agg(F.min("page_id").alias("k")).where("k % 3 > 0")
    configs = hosts.select("domain", (1 + F.col("k") % 5).cast("double").alias("rate_limit_rps"), F.concat(F.lit("basis "), F.col("k").cast("string")).alias("legal_basis"), F.lit("src/sources/x.py").alias("adapter"))
    return allow_list.configured(urls, configs).select("page_id", "listed", "rate_limit_rps", "legal_basis")


@query("""SELECT doc_id, concat_ws(',', CASE WHEN coalesce(length(text), 0) < 900 THEN 'text_min_length' END, CASE WHEN NOT coalesce(contains(lower(text), 'the') AND contains(lower(text), 'and'), false) THEN 'text_must_contain' END,
 CASE WHEN coalesce(n_chars, 0) < 400 THEN 'n_chars_min' END, CASE WHEN lang IS NULL THEN 'lang_min_length' END) AS failed FROM documents""")
def q_soft_checks(spark, d):
    rules = {"text_min_length": 900, "text_must_contain": ["The", "AND"], "n_chars_min": 400, "lang_min_length": 1}
    docs = table(spark, d, "documents")
    return docs.select("doc_id", F.array_join(text.soft_failures(rules, {c: F.col(c) for c in ("text", "n_chars", "lang")}), ",").alias("failed"))


@query("""SELECT c.event_id AS span_id, p.event_id AS root_id, p.event_type AS root_name FROM events c JOIN events p ON p.event_id = c.event_id - c.event_id % 10 AND p.event_id % 10 = 0 WHERE c.event_id % 10 > 0""")
def q_span_children(spark, d):
    from granary.sources import files

    e = table(spark, d, "events")
    spans = e.select(F.col("event_id").alias("span_id"), F.when(F.col("event_id") % 10 > 0, F.col("event_id") - F.col("event_id") % 10).alias("parent_id"), F.col("event_type").alias("name"))
    return files.children(spans).select("span_id", "root_id", "root_name")


@query("""SELECT o_orderkey FROM orders WHERE o_orderkey % 4 = 3""")
def q_real_changes(spark, d):
    k = F.col("o_orderkey") % 4
    old = F.when(k == 0, '{"a": 1, "b": 2}').when(k == 1, '"x"').when(k == 2, "1.0").otherwise('"x"')
    new = F.when(k == 0, '{"b":2,"a":1}').when(k == 1, '"x "').when(k == 2, "1").otherwise('"y"')
    return reports.real_changes(table(spark, d, "orders").select("o_orderkey", old.alias("old_value"), new.alias("new_value"))).select("o_orderkey")


@query("""SELECT event_id FROM events WHERE user_id = 7 AND ts >= (SELECT min(ts) FROM events) + INTERVAL 5 DAY""")
def q_records_since(spark, d):
    e = table(spark, d, "events").select("event_id", F.col("user_id").cast("string").alias("source"), F.col("ts").alias("valid_from"))
    first = e.agg(F.min("valid_from")).first()[0]
    import datetime as dt

    return reports.records_since(e, "7", F.lit(first + dt.timedelta(days=5)).cast("timestamp_ntz")).select("event_id")


@query("""SELECT doc_id AS id FROM documents WHERE doc_id % 3 = 0""")
def q_fixture_drift(spark, d):
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("id"), text.sha256(text.one_trailing_newline(F.col("text"))).alias("content_hash"))
    known = docs.withColumn("content_hash", F.when(F.col("id") % 3 == 0, "other").otherwise(F.col("content_hash")))
    return reports.drifted(docs, known)


@query("""SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN 'anti-bot' WHEN 1 THEN 'redirect' WHEN 2 THEN 'adapter-bug' WHEN 3 THEN 'structure-drift' ELSE 'schema-too-strict' END AS diagnosis FROM documents""")
def q_failure_diagnosis(spark, d):
    k = F.col("doc_id") % 5
    error = F.when(k == 0, "Are you a robot").when(k == 1, "page not found").when(k == 2, "source_id is required").when(k == 3, "title: is required").otherwise("currency: does not match")
    return table(spark, d, "documents").select("doc_id", reports.diagnosis(error).alias("diagnosis"))
