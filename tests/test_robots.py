"""Rules of robots.txt files against the standard library's parser, and latency sketches against exact quantiles."""

import datetime as dt
import random
from urllib.robotparser import RobotFileParser

from pyspark.sql import functions as F

from granary.operators import reports, robots

LINES = [
    "User-agent: *", "User-agent: granary", "user-agent: GRAN", "User-Agent : other # x", "User-agent:", "USER-AGENT: granary/1.0", "Disallow: /", "Disallow:", "Disallow: /a", "Allow: /a/b", "allow : /a%20b", "Disallow: /a b", "Allow: /*",
    "Disallow: *", "Disallow: /q?x=1", "Disallow: /p?", "Allow: /%zz", "Crawl-delay: 3", "Crawl-delay: 1.5", "crawl-delay: 0", "Crawl-delay:", "Request-rate: 1/5", "Sitemap: https://x/y", "nonsense", "# only a comment", "   ", "", "", "\t", "Disallow: /ü", "Disallow: /~u;v",
]
PATHS = ["", "/", "/a", "/a/b/c", "/a%20b", "/a b", "/q?x=1&y", "/q", "/p", "/p?", "/*", "/%zz", "/%C3%BC", "/ü/x", "/~u;v", "/other#top", "?x", "/a+b", "/%2A"]


def test_rules_equal_the_standard_parser(spark):
    rng = random.Random(12)
    bodies = ["\n".join(rng.choice(LINES) for _ in range(rng.randrange(0, 16))) for _ in range(250)]
    bodies += ["User-agent: *\r\nDisallow: /a\r\n\r\nUser-agent: granary\r\nAllow: /\r\n", "User-agent: *\rDisallow: /\x0bAllow: /a", "\ufeffUser-agent: *\nDisallow: /", "User-agent: *\nDisallow: /a\n" * 500]
    files = spark.createDataFrame([(f"https://h{i}.x/robots.txt", 200, b, dt.datetime(2026, 1, 9, 23, 30)) for i, b in enumerate(bodies)], "robots_url string, status int, body string, fetched_at timestamp")
    urls = spark.createDataFrame([(i, f"https://h{i}.x{p}") for i in range(len(bodies)) for p in PATHS], "host int, url string")
    got = {(r.host, r.url): (r.allowed, r.delay) for r in robots.decide(urls, files, F.to_timestamp(F.lit("2026-01-10 00:00:00"))).collect()}
    assert len(got) == len(bodies) * len(set(PATHS))
    for i, body in enumerate(bodies):
        p = RobotFileParser()
        p.parse(body.splitlines())
        delay = p.crawl_delay(robots.USER_AGENT) or p.crawl_delay("*")
        if delay is None:
            delay = p.crawl_delay(robots.USER_AGENT) if p.crawl_delay("*") is None else p.crawl_delay("*")
        for path in PATHS:
            url = f"https://h{i}.x{path}"
            allowed, said = got[i, url]
            assert allowed == p.can_fetch(robots.USER_AGENT, url), (body, url)
            assert (said or None) == (delay or None), body


def test_latest_answer_counts_and_python_stays_out(spark):
    rows = [("https://a.b/robots.txt", 200, "User-agent: *\nDisallow: /", dt.datetime(2026, 1, 9, 23, 10)), ("https://a.b/robots.txt", 404, None, dt.datetime(2026, 1, 9, 23, 40)), (None, 200, "", dt.datetime(2026, 1, 9, 23, 40))]
    files = spark.createDataFrame(rows, "robots_url string, status int, body string, fetched_at timestamp")
    urls = spark.createDataFrame([("https://a.b/x", 1), ("https://a.b/x", 2), (None, 3), ("no url", 4)], "url string, status int")
    out = robots.decide(urls, files, F.to_timestamp(F.lit("2026-01-10 00:00:00")))
    assert sorted((r.status, r.allowed) for r in out.collect()) == [(1, True), (2, True), (3, False), (4, False)] and out.columns == ["url", "status", "allowed", "delay"]
    assert "Python" not in out._jdf.queryExecution().executedPlan().toString()
    assert robots.decide(urls.limit(0), files.limit(0), F.current_timestamp()).count() == 0


def test_sketches_merge(spark):
    rng = random.Random(1)
    rows = [(rng.choice("ab"), dt.datetime(2026, 1, 1) + dt.timedelta(hours=rng.randrange(240)), rng.choice(["ok", "error"]), int(rng.expovariate(0.001))) for _ in range(20_000)]
    rows += [("a", dt.datetime(2026, 1, 1), "ok", None), ("none", dt.datetime(2026, 1, 1), "ok", None), ("one", None, "ok", 7)]
    spans = spark.createDataFrame(rows, "name string, at timestamp, status string, duration_ms long")
    kept = reports.latency_sketches(spans, ["name"], "at")
    assert kept.groupBy("name").count().where("count > 9").count() == 2 and kept.agg(F.max(F.length("sketch"))).first()[0] < 20_000
    got = {r.name: r for r in reports.report_of_sketches(kept, ["name"]).collect()}
    exact = {r.name: r for r in reports.trace_report(spans, ["name"]).collect()}
    for name, want in exact.items():
        assert (got[name].n_spans, got[name].n_errors, got[name].longest) == (want.n_spans, want.n_errors, want.longest)
        values = sorted(r[3] for r in rows if r[0] == name and r[3] is not None)
        for p, q in ((0.5, got[name].p50), (0.95, got[name].p95)):
            if not values:
                assert q is None
            else:
                assert sum(v < q for v in values) / len(values) - 0.02 <= p <= sum(v <= q for v in values) / len(values) + 0.02
    assert (got["one"].p50, got["one"].p95) == (7, 7)
