import datetime as dt

import pytest
from pyspark.sql import functions as F

from granary.operators import batch, gate, reports, robots, store
from granary.sources import adapters, allow_list, files, listing


def now():
    return F.to_timestamp(F.lit("2026-01-10 00:00:00"))



def test_dense_ids(spark):
    df = spark.range(0, 250_000, 3).withColumnRenamed("id", "seq")
    r = store.dense_ids(df, "seq", 10).agg(F.min("id"), F.max("id"), F.countDistinct("id")).first()
    assert tuple(r) == (11, 10 + 83_334, 83_334)
    assert store.dense_ids(df.limit(0), "seq").count() == 0


def test_changes(spark):
    rows = [("s", "a", "u", '{"t":"old","n":1,"x":null}', None, 1), ("s", "a", "u", '{"t":"new","n":1.0}', None, 2), ("s", "a", "u", '{"t":"new","n":"1"}', None, 3), ("s", "b", "u", '{"t":1}', None, 4)]
    df = spark.createDataFrame(rows, "source string, source_id string, url string, payload string, valid_from timestamp, raw_id long")
    got = {(r.raw_id, r.field, r.old_value, r.new_value) for r in store.changes(df.limit(0), df, now()).collect()}
    assert got == {(2, "t", '"old"', '"new"'), (3, "n", "1", '"1"')}
    assert {r.raw_id for r in store.upsert(df.limit(0), df).collect()} == {3, 4}


def test_resolve(spark):
    failed = spark.createDataFrame([(1, None, None), (2, dt.datetime(2026, 1, 1), "fixed")], "id long, resolved_at timestamp, resolution string")
    do = lambda *rows: {r.id: r.resolution for r in store.resolve(failed, spark.createDataFrame(rows, "id long, resolution string"), now()).collect()}
    assert do((1, "discarded")) == {1: "discarded", 2: "fixed"}
    for rows, message in ((((1, "maybe"),), "must be one of"), (((9, "fixed"),), "not found"), (((2, "fixed"),), "already resolved"), (((1, "fixed"), (1, "fixed")), "already resolved")):
        with pytest.raises(Exception, match=message):
            do(*rows)


def test_freshness(spark):
    urls = spark.createDataFrame([("s", str(i)) for i in range(4)], "source string, source_id string")
    seen = spark.createDataFrame([("s", "0", dt.datetime(2026, 1, 9)), ("s", "1", dt.datetime(2025, 12, 11)), ("s", "2", dt.datetime(2026, 1, 3))], "source string, source_id string, scraped_at timestamp")
    got = {r.source_id: r.is_fresh for r in store.freshness(urls, seen, now()).collect()}
    assert got == {"0": True, "1": False, "2": True, "3": False}
    assert not any(r.is_fresh for r in store.freshness(urls, seen, now(), force=True).collect())


def test_gate_matches_live_gate(spark):
    import random

    rng = random.Random(3)
    log = [("s", i, rng.choice(["scrape", "http"]), rng.random() < 0.7) for i in range(60)]
    for budget in (gate.Budget(), gate.Budget(credits=40), gate.Budget(http_calls=5), gate.Budget(iterations=9), gate.Budget(errors=2)):
        live, want, reason = gate.LiveGate(budget), [], None
        for _, i, kind, ok in log:
            try:
                live.check(kind)
            except RuntimeError as e:
                reason = str(e)
                break
            live.done(kind, ok)
            want.append(i)
        gated = gate.gate(spark.createDataFrame(log, "source string, seq long, kind string, ok boolean"), budget)
        assert sorted(r.seq for r in gate.admitted(gated).collect()) == want
        first = gated.where("tripped is not null").orderBy("seq").first()
        assert (first.tripped if first else None) == reason


def test_robots(spark):
    rows = [("https://a.b/robots.txt", 200, "User-agent: *\nDisallow: /private\nCrawl-delay: 2"), ("https://c.d/robots.txt", 404, None), ("https://e.f/robots.txt", 429, None), ("https://g.h/robots.txt", None, None)]
    known = spark.createDataFrame([(*r, dt.datetime(2026, 1, 9, 23, 30)) for r in rows], "robots_url string, status int, body string, fetched_at timestamp")
    urls = spark.createDataFrame([(i, u) for i, u in enumerate(("https://a.b/x", "https://a.b/private/x", "https://c.d/", "https://e.f/", "https://g.h/", "https://new.host/"))], "seq long, url string")
    got = {r.url: (r.allowed, r.delay) for r in robots.decide(urls, known, now()).collect()}
    assert list(got[u] for u in ("https://a.b/x", "https://a.b/private/x", "https://c.d/", "https://e.f/", "https://g.h/", "https://new.host/")) == [(True, 2.0), (False, 2.0), (True, None), (False, None), (False, None), (False, None)]
    assert all(r.allowed for r in robots.decide(urls.where("seq < 2"), known, now(), host_cached=True).collect())
    assert not any(r.allowed for r in robots.decide(urls, known, F.to_timestamp(F.lit("2026-01-10 02:00:00"))).collect())


def page(page, n, total=70, start=None):
    import json

    return page, json.dumps({"products": [{"id": (start if start is not None else page * 30) + i} for i in range(n)], "total": total})


def test_listing(spark):
    frame = lambda rows: spark.createDataFrame(rows, "page int, body string")
    assert listing.listed_urls(frame([page(0, 30), page(1, 30), page(2, 10), page(3, 30)])).count() == 70
    assert listing.listed_urls(frame([page(k, 30, 10_000) for k in range(5)]), max_pages=2).count() == 60
    assert listing.listed_urls(frame([page(0, 0)])).count() == 0
    assert listing.listed_urls(frame([(0, '{"products": [{"id": 1}, 7, "x"], "total": 3}'), page(1, 30)])).collect()[0].url.endswith("/products/1")
    with pytest.raises(Exception, match="integer id"):
        listing.listed_urls(frame([(0, '{"products": [{"id": "x"}]}')])).collect()


def test_data_source(spark):
    class Fake(listing.ListingSource):
        @staticmethod
        def fetch(url):
            import json
            import re

            limit, skip = map(int, re.findall(r"=(\d+)", url))
            return json.dumps({"products": [{"id": i} for i in range(skip, min(70, skip + limit))], "total": 70})

    class Endless(Fake):
        """Never says how many there are, and fails behind the end."""

        @classmethod
        def name(cls):
            return "endless"

        @staticmethod
        def fetch(url):
            import json
            import re

            limit, skip = map(int, re.findall(r"=(\d+)", url))
            if skip >= 90:
                raise RuntimeError("behind the end")
            return json.dumps({"products": [{"id": i} for i in range(skip, min(70, skip + limit))]})

    for source in (Fake, Endless):
        spark.dataSource.register(source)
        read = lambda: spark.read.format(source.name()).option("template", "https://x/p?limit={limit}&skip={skip}")  # noqa: B023, E731
        pages = read().option("rps", 5).load()
        assert pages.count() == 3 and listing.listed_urls(pages).count() == 70
        with pytest.raises(Exception, match="needs rps"):
            read().load().count()


def test_robots_are_fetched_once_a_host(spark):
    urls = spark.createDataFrame([("https://a.b/1",), ("https://a.b/2",), ("https://c.d/x",), ("https://e.f/x",), (None,)], "url string")
    known = spark.createDataFrame([("https://e.f/robots.txt", 200, "", dt.datetime(2026, 1, 9, 23, 30)), ("https://c.d/robots.txt", 200, "", dt.datetime(2026, 1, 9, 20))], "robots_url string, status int, body string, fetched_at timestamp")

    def get(url):
        return (200, "User-agent: *\nDisallow: /2") if "a.b" in url else (None, None)

    got = robots.fetched(urls, known, now(), get)
    assert sorted((r.robots_url, r.status, r.body is None) for r in got.collect()) == [("https://a.b/robots.txt", 200, False), ("https://c.d/robots.txt", None, True)]
    allowed = {r.url: r.allowed for r in robots.decide(urls.where("url is not null"), got.unionByName(known.where("robots_url like '%e.f%'")), now()).collect()}
    assert allowed == {"https://a.b/1": True, "https://a.b/2": False, "https://c.d/x": False, "https://e.f/x": True}


def test_guarded_calls():
    live = gate.LiveGate(gate.Budget(credits=10, errors=2))
    with live.guard("scrape"):
        pass
    for _ in range(2):
        with pytest.raises(KeyError), live.guard("scrape"):
            raise KeyError
    assert (live.credits, live.iterations, live.errors) == (5, 3, 2)
    with pytest.raises(RuntimeError, match="circuit breaker"), live.guard("scrape"):
        raise AssertionError("not reached")


def test_spans_nest(spark, tmp_path):
    tracer = files.Tracer(spark, str(tmp_path / "t"))
    with pytest.raises(ValueError), tracer.span("outer", batch_id="b"):
        with tracer.span("inner", credits=5) as attrs:
            attrs["more"] = 1
        raise ValueError("x")
    spans = files.traces(spark, str(tmp_path / "t"))
    inner, outer = spans.where("name = 'inner'").first(), spans.where("name = 'outer'").first()
    assert inner.parent_id == outer.span_id and outer.parent_id is None and (inner.status, outer.status) == ("ok", "error") and "ValueError" in outer.error
    assert inner.attrs == {"credits": "5", "more": "1"} and 0 <= inner.duration_ms <= outer.duration_ms
    report = reports.trace_report(spans, ["name"], credits=F.col("attrs")["credits"].cast("long"))
    assert {r.name: (r.n_errors, r.credits) for r in report.collect()} == {"inner": (0, 5), "outer": (1, 0)}


def test_reports(spark):
    runs = spark.createDataFrame([(1, True), (1, False), (2, True), (3, False)], "k int, ok boolean")
    verdict = lambda k: reports.run_summary(runs.where(F.col("k") == k), F.col("ok")).first().verdict
    assert [verdict(k) for k in (1, 2, 3)] == ["intermittent", "stable", "broken"]
    records = spark.createDataFrame([(i, '{"code_block_count": %d}' % i) for i in range(20)] + [(30, None), (31, "no json")], "id int, payload string")
    assert sorted(r.id for r in reports.with_payload_field(records, "$.code_block_count", "int", lambda n: n > 10).collect()) == list(range(11, 20))
    changed = spark.createDataFrame([(dt.datetime(2026, 1, 1),)] * 3 + [(dt.datetime(2026, 2, 1),)] * 2, "changed_at timestamp")
    assert {r.month.month: r.over_share for r in reports.change_share(changed, records).collect()} == {1: True, 2: False}


def test_payloads_need_their_names(spark):
    from granary.operators import fetch

    whole = '{"source": "s", "source_id": "1", "source_url": "u"}'
    rows = [(whole, True), ('{"source": "s", "source_id": "1"}', False), ("{}", False), ("[1]", False), ("no json", False), (None, False)]
    df = spark.createDataFrame(rows, "payload string, want boolean")
    assert all(r.got == r.want for r in df.withColumn("got", fetch.has_required(F.col("payload"))).collect())


def test_command_line(spark, tmp_path, capsys, monkeypatch):
    from granary import cli

    monkeypatch.setattr(cli, "session", lambda: spark)
    source, root = adapters.adapter("scrapethissite_com"), f"file://{tmp_path}/store"
    assert cli.main(["state", "--store", root]) == 1 and "migrate" in capsys.readouterr().err
    spark.createDataFrame([("https://www.scrapethissite.com/robots.txt", 404, None, dt.datetime.now())], "robots_url string, status int, body string, fetched_at timestamp").write.parquet(str(tmp_path / "robots"))
    good = '{"term": "t", "definition": "a definition of it"}'
    spark.createDataFrame([(u, good if i else '{"term": "t"}', True) for i, u in enumerate(source.seeds)], "url string, payload string, ok boolean").write.parquet(str(tmp_path / "answers"))
    assert cli.main(["run", "--source", source.name, "--store", root, "--robots", str(tmp_path / "robots"), "--answers", str(tmp_path / "answers")]) == 0
    assert "canonical=5 validation_failed=1" in (out := capsys.readouterr().out) and "credits=25" in out
    assert cli.main(["resolve", "--store", root, "--id", "1", "--resolution", "discarded", "--reason", "thin page"]) == 0
    assert cli.main(["state", "--store", root, "--source", source.name]) == 0 and f"| {source.name} | 5 | 0 |" in capsys.readouterr().out
    spans = {r.name: r.attrs for r in files.traces(spark, f"{root}/traces").collect()}
    assert spans["resolve"]["reason"] == "thin page" and spans["batch"]["credits"] == "25"
    (tmp_path / "links").write_text("https://x.y/news/a\nhttps://x.y/news/b\nhttps://x.y/other\n")
    (tmp_path / "seeds").write_text("https://x.y/news/a\n")
    assert cli.main(["discover", "--links", str(tmp_path / "links"), "--seeds", str(tmp_path / "seeds"), "--prefix", "https://x.y/news/"]) == 0
    assert "| 3 | 2 | 1 |" in capsys.readouterr().out


def test_batch_twice(spark, tmp_path):
    tables = store.Store(spark, f"file://{tmp_path}/store")
    tables.migrate()
    tables.migrate()
    source = adapters.adapter("scrapethissite_com")
    urls = source.urls(spark).select("seq", "url")
    known = spark.createDataFrame([("https://www.scrapethissite.com/robots.txt", 200, "User-agent: *\nDisallow: /pages/frames/", dt.datetime(2026, 1, 10))], "robots_url string, status int, body string, fetched_at timestamp")

    def answers(word):
        good = lambda u: (u, '{"source": "wrong", "term": "%s", "definition": "a definition of it"}' % word, True)
        rows = [good(u) for u in source.seeds[:3]] + [(source.seeds[3], '{"term": "x"}', True), (source.seeds[5], None, False)]
        return spark.createDataFrame(rows, "url string, payload string, ok boolean")

    first = batch.run(tables, source, urls, known, answers("one"), now(), "first")
    assert first.counts == {"canonical": 3, "validation_failed": 1, "skipped_robots": 1, "errors": 1, "skipped_fresh": 0} and first.exit_code == 1 and first.tripped is None
    assert first.credits == 15
    again = batch.run(tables, source, urls, known, answers("one"), now(), "first")
    assert again.counts == first.counts and tables.read("raw_content").count() == 4
    assert tables.read("raw_content").count() == 4 and tables.read("validation_failed").count() == 1 and tables.read("change_history").count() == 0
    assert {r.source for r in tables.read("canonical_records").collect()} == {"scrapethissite_com"}
    later = F.to_timestamp(F.lit("2026-01-10 00:30:00"))
    second = batch.run(tables, source, urls, known, answers("two"), later, "second")
    assert second.counts["skipped_fresh"] == 3 and second.counts["validation_failed"] == 1
    forced = batch.run(tables, source, urls, known, answers("three"), later, "third", force=True)
    assert forced.counts["canonical"] == 3
    changed = tables.read("change_history").collect()
    assert {(r.field, r.old_value, r.new_value) for r in changed} == {("term", '"one"', '"three"')} and sorted(r.id for r in changed) == [1, 2, 3]
    assert reports.state_counts(tables.read("canonical_records"), tables.read("validation_failed")).first().n_unresolved == 3
    capped = batch.run(tables, source, urls, known, answers("four"), later, "fourth", gate.Budget(credits=5), force=True)
    assert capped.tripped == "cost cap reached" and capped.counts["canonical"] == 1


def test_allow_list(spark, tmp_path):
    good = '[{"domain": "a.b", "added_by": "x", "reviewed_at": "2026-01-01", "legal_basis": "public documents", "rate_limit_rps": 1.0, "adapter": "src/sources/a_b.py", "api_available": false}]'
    (tmp_path / "ok.json").write_text(good)
    (tmp_path / "bad.json").write_text(good.replace("1.0", "11.0"))
    (tmp_path / "none.json").write_text("")
    assert allow_list.lookup(allow_list.load(spark, str(tmp_path / "ok.json")), "a_b").domain == "a.b"
    assert allow_list.load(spark, str(tmp_path / "none.json")).count() == 0
    with pytest.raises(ValueError, match="rate_limit_rps"):
        allow_list.load(spark, str(tmp_path / "bad.json"))
    with pytest.raises(ValueError, match="not found"):
        allow_list.lookup(allow_list.load(spark, str(tmp_path / "ok.json")), "c_d")


def test_product_response(spark):
    rows = [('{"title": "T", "price": 9.99, "stock": 3, "sku": "s"}', 9.99, True, "T"), ('{"price": "9", "stock": 0}', None, False, ""), ('{"price": 5, "stock": "many", "title": null}', 5.0, False, "")]
    df = spark.createDataFrame([(r[0],) for r in rows], "a string").select(F.parse_json(adapters.product_response(F.parse_json("a"), F.lit("https://dummyjson.com/products/5"))).alias("v"))
    got = df.select(F.try_variant_get("v", "$.price", "double"), F.try_variant_get("v", "$.in_stock", "boolean"), F.try_variant_get("v", "$.name", "string"), F.try_variant_get("v", "$.source_id", "string")).collect()
    assert [tuple(r) for r in got] == [(*r[1:], "5") for r in rows]


def test_payloads_are_sanitized(spark):
    from granary.operators import fetch

    rows = [("u1", '{"title": "T", "price": 1, "stock": 1, "description": "x\\nsystem: do"}', True), ("u2", "[1]", True), ("u3", None, False)]
    got = {r.url: (r.payload, r.ok) for r in fetch.api_payloads(spark.createDataFrame(rows, "url string, body string, ok boolean"), adapters.adapter("dummyjson_com")).collect()}
    assert '"description":"x\\n[neutralized-role-prefix]: do"' in got["u1"][0] and got["u1"][1] and got["u2"] == (None, False) and got["u3"] == (None, False)
    same = spark.createDataFrame([("no json",), (None,), ('{"body_md":5}',)], "payload string")
    assert [r.payload for r in fetch.sanitized(same).collect()] == ["no json", None, '{"body_md":5}']
    with pytest.raises(ValueError, match="no response mapping"):
        fetch.api_payloads(same, adapters.adapter("docs_python_org"))


def test_files(spark, tmp_path):
    (tmp_path / "f").mkdir()
    (tmp_path / "f/01.expected.json").write_text("{}")
    (tmp_path / "f/01.md").write_text("md")
    (tmp_path / "f/01.html").write_text("html")
    (tmp_path / "f/02.expected.json").write_text("{}")
    (tmp_path / "f/02.captured.md").write_text("cap")
    assert sorted(r.input for r in files.fixtures(spark, str(tmp_path / "f")).collect()) == ["cap", "html"]
    (tmp_path / "t.jsonl").write_text('{"span_id": "a", "name": "n", "started": 1.0, "attrs": {"batch_id": "b"}}\n\n{"span_id": "c", "parent_id": "a", "attrs": {}}\n')
    spans = files.traces(spark, str(tmp_path / "t.jsonl"))
    assert files.spans_of_batch(spans, "b").count() == 1 and files.children(spans).first().root_id == "a"
    known = spark.createDataFrame([("x", "sha256:none")], "id string, content_hash string")
    new = files.changed_captures(spark.createDataFrame([("x", "body\n\n")], "id string, body string"), known)
    assert new.first().body == "body\n" and files.changed_captures(new.select("id", "body"), new).count() == 0


def test_read_only_sql(spark):
    import os

    spark.range(100).createOrReplaceTempView("numbers_for_sql")
    spark.sql("CREATE TABLE IF NOT EXISTS default.numbers_for_table USING parquet AS SELECT 1L AS id")
    spark.udf.register("own_code", lambda x: x)
    open("secretfile", "w").write("secret")
    assert store.read_only_sql(spark, "SELECT * FROM numbers_for_sql").count() == 50
    for bad in ("DROP VIEW numbers_for_sql", "CREATE TABLE x AS SELECT 1", "INSERT INTO numbers_for_sql VALUES (1)", "SET a = b", "EXECUTE IMMEDIATE 'DROP VIEW numbers_for_sql'", "BEGIN DROP VIEW numbers_for_sql; END", "CALL x.y()",
                "SELECT reflect('java.lang.System', 'nanoTime')", "SELECT * FROM numbers_for_sql WHERE id = (SELECT max(java_method('java.lang.Math', 'abs', 1)) FROM numbers_for_sql)",
                "SELECT * FROM parquet.`/root/testdata`", "WITH a AS (SELECT * FROM text.`/etc/passwd`) SELECT * FROM a", "EXPLAIN SELECT 1", "SHOW TABLES", "DESCRIBE numbers_for_sql", "CACHE TABLE numbers_for_sql",
                "MERGE INTO numbers_for_sql USING numbers_for_sql b ON true WHEN MATCHED THEN DELETE", "USE x", "REFRESH TABLE numbers_for_sql",
                "SELECT * FROM text.secretfile", "SELECT * FROM numbers_for_sql WHERE id IN (SELECT length(value) FROM text.secretfile)", "SELECT (SELECT max(value) FROM text.`secretfile`)", "SELECT own_code(id) FROM numbers_for_sql",
                "SELECT id FROM numbers_for_sql WHERE EXISTS (SELECT own_code(1))", "SELECT try_reflect('java.lang.System', 'nanoTime')"):
        with pytest.raises(Exception) as e:
            store.read_only_sql(spark, bad).collect()
        assert e.type is PermissionError, bad
    for good in ("SELECT 1 AS reflect", "SELECT 'reflect' AS x, 'java_method(1)' AS y", "SELECT id AS java_method FROM default.numbers_for_table", "SELECT id % 3 AS k, count(*) AS n FROM numbers_for_sql GROUP BY 1 HAVING n > 1 ORDER BY k LIMIT 2", "WITH a AS (SELECT id FROM numbers_for_sql) SELECT a.id, sum(b.id) OVER (PARTITION BY a.id) FROM a JOIN numbers_for_sql b USING (id) UNION ALL SELECT 1, 2",
                 "SELECT * FROM numbers_for_sql WHERE id IN (SELECT id FROM numbers_for_sql WHERE id > 3) EXCEPT SELECT 5", "SELECT x FROM VALUES (1), (2) t(x) LATERAL VIEW explode(array(1, 2)) e AS y", "SELECT DISTINCT id FROM numbers_for_sql TABLESAMPLE (50 PERCENT) AS n LIMIT 3 OFFSET 1"):
        store.read_only_sql(spark, good).collect()
    os.unlink("secretfile")
    spark.sql("DROP TABLE default.numbers_for_table")


RECORDS = [(k, "s", "ab"[k % 2], "https://u.v/x", '{"source": "s", "source_id": "%s", "source_url": "https://u.v/x", "term": "t%d", "definition": "a definition of it"}' % ("ab"[k % 2], k)) for k in range(5)] + [(5, "s", "c", "https://u.v/y", '{"term": "x"}')]


def show(tables):
    return {name: sorted(map(str, tables.read(name).collect())) for name in store.TABLES}


def test_crash_between_any_two_steps(spark, tmp_path):
    """A crash before any write, after its data but before it is in its place, and after it: the same call again gives the same tables."""
    from granary.functions.validate import validate
    from granary.streaming import upserts

    checked = validate(spark.createDataFrame(RECORDS, upserts.INCOMING), "reference")
    whole = store.Store(spark, f"file://{tmp_path}/whole")
    whole.migrate()
    store.commit(whole, checked, now(), "one")
    want = show(whole)
    assert [len(want[n]) for n in ("raw_content", "validation_failed", "change_history", "canonical_records")] == [6, 1, 3, 2]

    class Crashing(store.Store):
        left = 10**6

        def step(self):
            self.left -= 1
            if self.left < 0:
                raise KeyboardInterrupt

        def _write(self, *args):
            self.step()
            folder = super()._write(*args)
            self.step()
            return folder

        def _publish(self, *args):
            super()._publish(*args)
            self.step()

    for k in (1, 4, 5, 7, 10):  # of each of the four writes: its data is there, or (5) it is named
        tables = Crashing(spark, f"file://{tmp_path}/crash{k}")
        tables.migrate()
        tables.left = k
        with pytest.raises(KeyboardInterrupt):
            store.commit(tables, checked, now(), "one")
        tables.left = 10**6
        store.commit(tables, checked, now(), "one")
        store.commit(tables, checked, now(), "one")
        assert show(tables) == want


def test_only_touched_partitions_are_read_and_written(spark, tmp_path):
    """Files of the other partitions are made unreadable: a batch does not notice."""
    from granary.functions.validate import validate
    from granary.streaming import upserts

    def record(k, key, term):
        return (k, "s", key, "https://u.v/x", '{"source": "s", "source_id": "%s", "source_url": "https://u.v/x", "term": "%s", "definition": "a definition of it"}' % (key, term))

    tables = store.Store(spark, f"file://{tmp_path}/s", parts=16)
    tables.migrate()
    write = lambda rows, label: store.commit(tables, validate(spark.createDataFrame(rows, upserts.INCOMING), "reference"), now(), label)
    write([record(k, f"key{k}", "old") for k in range(40)], "one")
    folders = sorted(p.name for p in (tmp_path / "s/canonical_records").glob("part=*"))
    touched = spark.createDataFrame([("s", "key7")], "source string, source_id string").select(tables.part()).first()[0]
    assert len(folders) > 8 and f"part={touched}" in folders
    before = tables.read("canonical_records").count()
    for f in (tmp_path / "s/canonical_records").glob("part=*/*.parquet"):
        if f.parent.name != f"part={touched}":
            (f.parent / f".{f.name}.crc").unlink(missing_ok=True)
            f.rename(f.with_suffix(".kept"))
            f.write_bytes(b"not parquet")
    write([record(0, "key7", "new"), record(1, "key7", "newer")], "two")
    plan = tables.touched(spark.createDataFrame([("s", "key7")], "source string, source_id string"))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(part" in plan
    for f in (tmp_path / "s/canonical_records").glob("part=*/*.kept"):
        f.rename(f.with_suffix(".parquet"))
    found = {r.source_id: r.payload for r in tables.read("canonical_records").collect()}
    assert len(found) == before and '"newer"' in found["key7"] and '"old"' in found["key8"]
    assert [(r.old_value, r.new_value) for r in tables.read("change_history").orderBy("id").collect()] == [('"old"', '"new"'), ('"new"', '"newer"')]
    assert tables.last_id("raw_content") == 42 and tables.last_id("validation_failed") == 0 and not (list((tmp_path / "s/pending").glob("*")))


def test_resolving_touches_its_batch(spark, tmp_path):
    from granary.functions.validate import validate
    from granary.streaming import upserts

    tables = store.Store(spark, f"file://{tmp_path}/s")
    tables.migrate()
    bad = validate(spark.createDataFrame([RECORDS[5]], upserts.INCOMING), "reference")
    for label in ("a/b", "c=d", "e f"):
        store.commit(tables, bad, now(), label)
        assert tables.has("raw_content", label) and not tables.has("raw_content", label + "x")
    wanted = spark.createDataFrame([(2, "fixed")], "id long, resolution string")
    held = tables.holding("validation_failed", 2)
    assert held.count() == 1 and tables.holding("validation_failed", 9).count() == 0
    tables.overwrite("validation_failed", store.resolve(held, wanted, now()), tables.BATCH)
    assert {r.id: r.resolution for r in tables.read("validation_failed").collect()} == {1: None, 2: "fixed", 3: None}


def test_streams(spark, tmp_path):
    from granary.streaming import upserts

    (tmp_path / "in").mkdir()
    tables = store.Store(spark, f"file://{tmp_path}/s")
    tables.migrate()
    spark.createDataFrame(RECORDS, upserts.INCOMING).write.mode("append").json(str(tmp_path / "in"))
    stream = spark.readStream.schema(upserts.INCOMING).json(str(tmp_path / "in"))
    upserts.upsert_stream(stream, tables, str(tmp_path / "cp"), "reference", now()).awaitTermination(120)
    assert {(r.source_id, r.raw_id) for r in tables.read("canonical_records").collect()} == {("a", 5), ("b", 4)} and tables.read("change_history").count() == 3
    assert tables.read("raw_content").count() == 6 and [r.raw_id for r in tables.read("validation_failed").collect()] == [6]
    spark.createDataFrame([("s", i, ok) for i, ok in enumerate((False, False, False, True))], "source string, seq long, ok boolean").write.json(str(tmp_path / "log"))
    log = spark.readStream.schema("source string, seq long, ok boolean").json(str(tmp_path / "log"))
    q = upserts.breaker_stream(log).writeStream.format("memory").queryName("breaker").option("checkpointLocation", str(tmp_path / "cp2")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert [r.tripped for r in spark.sql("select * from breaker order by seq").collect()] == [False, False, False, True]
