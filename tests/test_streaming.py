"""Streams with state that expires, listings read as streams, and calls that keep their distance."""

import datetime as dt
import json
import re
import time

import pytest
from pyspark.sql import functions as F

from granary.operators import batch, fetch, gate, store
from granary.sources import adapters, listing
from granary.streaming import verdicts


def once(stream, folder):
    """One micro-batch with all that is there; what availableNow adds, batches without data as long as time goes on, never ends."""
    stream.writeStream.format("json").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/cp").trigger(once=True).start().awaitTermination(120)


EVENT = "robots_url string, seq long, url string, allowed boolean, delay double, cached boolean"


def test_verdicts_expire(spark, tmp_path):
    """Three runs of one query: verdicts answer until they expire, and those of errors only beside them."""
    verdicts.use_state_store(spark)
    (tmp_path / "in").mkdir()
    add = lambda *rows: spark.createDataFrame(rows, EVENT).coalesce(1).write.mode("append").json(str(tmp_path / "in"))

    def answers(k):
        stream = verdicts.verdict_stream(spark.readStream.schema(EVENT).json(str(tmp_path / "in")), ttl_seconds=20)
        once(stream, tmp_path)
        return {r.seq: (r.allowed, r.delay, r.fetch) for r in spark.read.schema(verdicts.VERDICTS).json(str(tmp_path / "out")).collect() if r.seq >= k}

    add(("a", 1, "u", None, None, None), ("a", 2, None, True, 2.0, True), ("a", 3, "v", None, None, None), ("b", 4, None, False, None, False), ("b", 5, "w", None, None, None))
    began = time.time()
    assert answers(0) == {1: (None, None, True), 3: (True, 2.0, False), 5: (False, None, False)}
    add(("a", 10, "u", None, None, None), ("b", 11, "w", None, None, None))
    got = answers(10)
    if time.time() - began < 19:  # a slow machine may have let it expire
        assert got[10] == (True, 2.0, False)
    assert got[11] == (None, None, True)
    time.sleep(max(0.0, 21 - (time.time() - began)))
    add(("a", 20, "u", None, None, None))
    assert answers(20) == {20: (None, None, True)}


def test_breaker_rests(spark, tmp_path):
    verdicts.use_state_store(spark)
    (tmp_path / "in").mkdir()
    schema = "source string, seq long, ok boolean"
    add = lambda *rows: spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").json(str(tmp_path / "in"))

    def out():
        stream = verdicts.resting_breaker_stream(spark.readStream.schema(schema).json(str(tmp_path / "in")), 2, rest_seconds=1)
        once(stream, tmp_path)
        return {(r.source, r.seq): (r.consecutive_errors, r.tripped) for r in spark.read.schema(verdicts.BREAKER).json(str(tmp_path / "out")).collect()}

    add(("a", 1, False), ("a", 2, False), ("a", 3, True), ("b", 1, False), ("b", 2, False))
    assert out() == {("a", 1): (0, False), ("a", 2): (1, False), ("a", 3): (2, True), ("b", 1): (0, False), ("b", 2): (1, False)}
    time.sleep(2)
    add(("c", 9, True))
    assert out()["b", None] == (0, False)
    add(("b", 3, True), ("a", 4, False))
    got = out()
    assert got["b", 3] == (0, False) and got["a", 4] == (0, False)


def products(calls, total=70):
    """A source of `total` items that notes when and for what it is called."""

    class Listed(listing.ListingSource):
        @classmethod
        def name(cls):
            return "listed"

        @staticmethod
        def fetch(url):
            limit, skip = map(int, re.findall(r"=(\d+)", url))
            with open(calls, "a") as f:
                f.write(f"{time.time()} {skip // limit}\n")
            return json.dumps({"products": [{"id": i} for i in range(skip, min(total, skip + limit))], "total": total})

    return Listed


def noted(calls):
    return [(float(t), int(p)) for t, p in (x.split() for x in open(calls))]


def test_calls_keep_their_distance(spark, tmp_path):
    calls = str(tmp_path / "calls")
    spark.dataSource.register(products(calls, 300))
    pages = spark.read.format("listed").option("template", "https://x/p?limit={limit}&skip={skip}").option("rps", 4).load()
    assert listing.listed_urls(spark.createDataFrame(pages.collect(), "page int, body string")).count() == 300
    times = sorted(t for t, _ in noted(calls))
    assert sorted(p for _, p in noted(calls)) == list(range(10)) and min(b - a for a, b in zip(times, times[1:])) > 0.2

    def get(url):
        with open(calls + "2", "a") as f:
            f.write(f"{time.time()} 0\n")
        if "bad" in url:
            raise KeyError("no key") if "key" in url else TimeoutError
        return url

    urls = spark.createDataFrame([(f"https://x/{k}",) for k in range(8)] + [("https://x/bad",)], "url string")
    got = {r.url: (r.ok, r.error) for r in fetch.fetched(urls, get, 5.0, tasks=4).collect()}
    assert got.pop("https://x/bad") == (False, "TimeoutError") and set(got.values()) == {(True, None)} and len(got) == 8
    times = sorted(t for t, _ in noted(calls + "2"))
    assert min(b - a for a, b in zip(times, times[1:])) > 0.15


def test_slots():
    for pages, rps in ((1, 1.0), (7, 3.0)):
        taken = [listing.next_slot(p, pages, 100.0, rps, now) for p in range(pages) for now in (90.0, 100.0, 104.2, 117.0)]
        ticks = {round((t - 100.0) * rps, 6) for t in taken}
        assert all(abs(x - round(x)) < 1e-6 for x in ticks)
        assert all(listing.next_slot(p, pages, 100.0, rps, now) >= now for p in range(pages) for now in (90.0, 100.0, 104.2))


def test_listing_stream_goes_on_behind_a_crash(spark, tmp_path):
    calls = str(tmp_path / "calls")
    spark.dataSource.register(products(calls, 200))
    (tmp_path / "state").write_text("crash")

    def start():
        stream = spark.readStream.format("listed").option("template", "https://x/p?limit={limit}&skip={skip}").option("rps", 50).option("pages_a_batch", 2).load()
        seen = []

        def keep(batch, epoch):
            if epoch == 2 and (tmp_path / "state").read_text() == "crash":
                raise RuntimeError("crash")
            seen.extend(r.page for r in batch.collect())

        q = stream.writeStream.foreachBatch(keep).option("checkpointLocation", str(tmp_path / "cp")).trigger(processingTime="0 seconds").start()
        return q, seen

    q, seen = start()
    with pytest.raises(Exception, match="crash"):
        q.awaitTermination(120)
    assert sorted(seen) == [0, 1, 2, 3]
    (tmp_path / "state").write_text("go on")
    before = len(noted(calls))
    q, more = start()
    for _ in range(200):
        if len(more) >= 3:
            break
        time.sleep(0.3)
    q.stop()
    assert sorted(more) == [4, 5, 6]
    again = sorted(p for _, p in noted(calls)[before:])
    assert again.count(0) <= 1 and not {1, 2, 3} & set(again) and {4, 5, 6} <= set(again)  # page 0 tells the total


def test_listing_pages_cost_calls(spark, tmp_path):
    tables = store.Store(spark, f"file://{tmp_path}/s")
    tables.migrate()
    source = adapters.adapter("dummyjson_com")
    urls = spark.createDataFrame([(k, f"https://dummyjson.com/products/{k}") for k in range(5)], "seq long, url string")
    known = spark.createDataFrame([("https://dummyjson.com/robots.txt", 404, None, dt.datetime(2026, 1, 10))], "robots_url string, status int, body string, fetched_at timestamp")
    good = lambda k: json.dumps({"name": f"n{k}", "in_stock": True, "description": "a thing"})
    answers = spark.createDataFrame([(f"https://dummyjson.com/products/{k}", good(k), True, None) for k in range(5)], "url string, payload string, ok boolean, error string")
    now, pages = F.to_timestamp(F.lit("2026-01-10 00:00:00")), spark.createDataFrame([(0, True)], "page int, ok boolean")
    go = lambda trace, **more: batch.run(tables, source, urls, known, answers, now, trace, gate.Budget(http_calls=3), force=True, **more)
    free, paid = go("free"), go("paid", pages=pages)
    assert (free.counts["canonical"], paid.counts["canonical"]) == (3, 2) and free.tripped == paid.tripped == "HTTP cap reached"
    wrong = answers.withColumn("error", F.when(F.col("url").endswith("4"), "ModuleNotFoundError"))
    before = tables.read("raw_content").count()
    with pytest.raises(Exception, match="configuration error: ModuleNotFoundError"):
        batch.run(tables, source, urls, known, wrong, now, "wrong", force=True)
    assert tables.read("raw_content").count() == before
    slow = answers.withColumn("error", F.when(F.col("url").endswith("1"), "TimeoutError"))
    assert batch.run(tables, source, urls, known, slow, now, "slow", force=True).counts["errors"] == 1
