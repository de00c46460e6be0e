"""A whole batch: robots, freshness, gate, raw log, validation, upsert with change log, failure queue, counts.

Fetching is a connector's business: a batch gets `answers` (url, payload JSON or null, ok), from a replay table or from a
fetch that ran before. Each URL ends in exactly one bucket, unless the gate trips: then the batch ends before it.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.functions.validate import validate
from granary.operators import fetch
from granary.operators import gate as gates
from granary.operators import robots as rules
from granary.operators import store as stores
from granary.sources.adapters import SCRAPE, Adapter
from granary.sources.listing import LIMIT

BUCKETS = ("canonical", "validation_failed", "skipped_robots", "errors", "skipped_fresh")


@dataclass
class Outcome:
    counts: dict[str, int]
    tripped: str | None
    batch: DataFrame
    credits: int = 0

    @property
    def exit_code(self) -> int:
        return int(self.counts["errors"] > 0)


def classify(urls: DataFrame, robots: DataFrame, scraped: DataFrame, answers: DataFrame, adapter: Adapter, now, max_age_days: int = 7, force: bool = False) -> DataFrame:
    """urls(seq, url) with source, source_id, payload, errors, record_json and bucket. The cheap checks come first: only answers to
    URLs that robots and freshness let pass are sanitized and validated. Of several answers to a URL, the greatest that is ok counts. Where answers name the error's class, one of configuration
    stops the batch before anything is written."""
    found = adapter.ids(urls.withColumn("source", F.lit(adapter.name)))
    allowed = rules.decide(found, robots, now)
    fresh = stores.freshness(allowed, scraped, now, max_age_days, force)
    asked = fresh.where(F.col("allowed") & ~F.col("is_fresh")).select("url").distinct()
    if "error" in answers.columns:
        answers = answers.withColumn("ok", fetch.transient(F.col("ok"), F.col("error")))
    one = answers.join(asked, "url", "left_semi").groupBy("url").agg(F.max(F.struct("ok", "payload")).alias("a")).select("url", "a.payload", "a.ok")
    doc = F.try_parse_json("payload")
    named = F.to_json(F.map_concat(F.map_filter(F.from_json("payload", "map<string,variant>"), lambda k, v: ~k.isin("source", "source_id", "source_url")), F.from_json(F.to_json(F.struct("source", "source_id", F.col("url").alias("source_url"))), "map<string,variant>")))
    answered = fresh.join(fetch.sanitized(one), "url", "left").withColumn("payload", F.when(doc.isNotNull(), named))
    checked = validate(answered, adapter.page_type)
    bucket = (
        F.when(~F.col("allowed"), "skipped_robots")
        .when(F.col("is_fresh"), "skipped_fresh")
        .when(~F.coalesce("ok", F.lit(False)) | F.col("payload").isNull(), "errors")
        .when(F.size("errors") > 0, "validation_failed")
        .otherwise("canonical")
    )
    return checked.withColumn("bucket", bucket).drop("record")


def attempts(classified: DataFrame, adapter: Adapter, pages: DataFrame | None = None, limit: int = LIMIT) -> DataFrame:
    """The log of what fetches: source, seq (2 n + 1 for the URL n), kind, ok. A listing's pages(page, ok) are calls that come right before
    their first URL."""
    log = classified.where(F.col("bucket").isin("canonical", "validation_failed", "errors"))
    log = log.select("source", (2 * F.col("seq") + 1).alias("seq"), F.lit(adapter.kind).alias("kind"), (F.col("bucket") == "canonical").alias("ok"))
    if pages is None:
        return log
    return log.unionByName(pages.select(F.lit(adapter.name).alias("source"), (2 * limit * F.col("page")).cast("long").alias("seq"), F.lit("listing").alias("kind"), "ok"))


def run(store: stores.Store, adapter: Adapter, urls: DataFrame, robots: DataFrame, answers: DataFrame, now=None, trace_id: str | None = None, budget: gates.Budget = gates.Budget(), max_age_days: int = 7, force: bool = False, pages: DataFrame | None = None) -> Outcome:
    """One batch. pages(page, ok) are the calls of the listing that the URLs are from, if it cost any. With the trace id of a batch that crashed, it goes on where that stopped, with what that had classified."""
    spark, trace_id = store.spark, trace_id or uuid.uuid4().hex
    now = F.lit(spark.sql("select current_timestamp() as t").first()["t"]) if now is None else now
    path = f"{store.root}/batches/{trace_id}"
    if not store.fs.exists(store._path("batches", trace_id, "_SUCCESS")):
        canonical, raw = store.read("canonical_records"), store.read("raw_content")
        classify(urls, robots, stores.last_scraped(canonical, raw), answers, adapter, now, max_age_days, force).write.mode("overwrite").parquet(path)
    rows = spark.read.parquet(path)
    trip = gates.gate(attempts(rows.where(F.col("seq") < budget.iterations), adapter, pages), budget).where("tripped is not null").agg(F.min("seq").alias("seq"), F.min_by("tripped", "seq").alias("why")).first()
    stop = budget.iterations if trip["seq"] is None else min(trip["seq"] // 2, budget.iterations)
    batch = rows.where(F.col("seq") < stop)  # what happens before the gate trips; rows that fetch nothing pass it by
    stores.commit(store, batch.where(F.col("bucket").isin("canonical", "validation_failed")), now, trace_id)
    found = {r["bucket"]: r["count"] for r in batch.groupBy("bucket").count().collect()}  # five buckets
    counts = {b: found.get(b, 0) for b in BUCKETS}
    conserved(counts, urls.where(F.col("seq") < stop).count())
    return Outcome(counts, trip["why"], batch, counts["canonical"] * budget.scrape_cost * (adapter.kind == SCRAPE))


def conserved(counts: dict[str, int], iterated: int) -> None:
    """Raises unless the buckets hold all URLs that were iterated."""
    if sum(counts.values()) != iterated:
        raise AssertionError(f"{sum(counts.values())} URLs in buckets, {iterated} iterated")
