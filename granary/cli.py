"""Command line: python -m granary.cli run | state | resolve | discover."""

from __future__ import annotations

import argparse
import sys
import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from granary.operators import batch, gate, reports, store
from granary.sources import adapters, files


def session() -> SparkSession:
    return SparkSession.builder.appName("granary").config("spark.sql.session.timeZone", "UTC").getOrCreate()


def run(a: argparse.Namespace) -> int:
    """Replays fetched answers (Parquet: url, payload, ok) and robots results (robots_url, status, body, fetched_at)."""
    spark, source = session(), adapters.adapter(a.source)
    tables = store.Store(spark, a.store)
    tables.migrate()
    urls = source.urls(spark, a.seeds).select("seq", "url")
    budget = gate.Budget(a.max_credits, a.max_iterations, 3, a.max_http_calls)
    trace_id = a.trace_id or uuid.uuid4().hex
    with files.Tracer(spark, f"{a.store}/traces").span("batch", batch_id=trace_id, source=source.name) as attrs:
        out = batch.run(tables, source, urls, spark.read.parquet(a.robots), spark.read.parquet(a.answers), trace_id=trace_id, budget=budget, max_age_days=a.max_age_days, force=a.force)
        attrs |= out.counts | {"credits": out.credits}
    print(" ".join(f"{k}={v}" for k, v in out.counts.items()), f"credits={out.credits} tripped={out.tripped} trace={trace_id}")
    return out.exit_code


def state(a: argparse.Namespace) -> int:
    tables = store.Store(session(), a.store)
    try:
        canonical, failed = tables.read("canonical_records"), tables.read("validation_failed")
    except FileNotFoundError as e:
        print(e, file=sys.stderr)
        return 1
    print(reports.markdown_table(reports.state_counts(canonical, failed).orderBy("source")))
    if a.source:
        print(reports.markdown_table(canonical.where(F.col("source") == a.source).select("source_id").orderBy("source_id")))
    return 0


def resolve(a: argparse.Namespace) -> int:
    spark = session()
    tables = store.Store(spark, a.store)
    wanted = spark.createDataFrame([(a.id, a.resolution)], "id long, resolution string")
    held = tables.holding("validation_failed", a.id)
    out = store.resolve(held, wanted, F.current_timestamp())
    with files.Tracer(spark, f"{a.store}/traces").span("resolve", id=a.id, resolution=a.resolution, reason=a.reason or "", dry_run=a.dry_run):
        print(out.where(F.col("id") == a.id).first())
        if not a.dry_run:
            tables.recover()
            tables.overwrite("validation_failed", out, tables.BATCH)
    return 0


def discover(a: argparse.Namespace) -> int:
    """New article links of a list (one URL a line) against the known seeds."""
    from granary.functions.ids import is_article_url

    spark = session()
    read = lambda p: spark.read.text(p).select(F.trim("value").alias("url")).where("url != ''")
    links, known = read(a.links), read(a.seeds)
    keep = is_article_url(F.col("url"), a.prefix)
    print(reports.markdown_table(files.discovered(links, known, keep)))
    if a.out:
        files.write_seeds(store.unseen(links.where(keep), known, ["url"]), a.out)
    return 0


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="granary")
    sub = p.add_subparsers(required=True)
    r = sub.add_parser("run")
    for name, kind, default in (("source", str, None), ("store", str, None), ("robots", str, None), ("answers", str, None), ("seeds", str, ""), ("trace-id", str, ""), ("since", str, ""), ("max-credits", int, 100), ("max-iterations", int, 200), ("max-http-calls", int, 200), ("max-age-days", int, 7)):
        r.add_argument(f"--{name}", type=kind, default=default or None, required=default is None)
    r.add_argument("--force", action="store_true")
    r.set_defaults(do=run)
    s = sub.add_parser("state")
    s.add_argument("--store", required=True)
    s.add_argument("--source")
    s.set_defaults(do=state)
    v = sub.add_parser("resolve")
    v.add_argument("--store", required=True)
    v.add_argument("--id", type=int, required=True)
    v.add_argument("--resolution", choices=sorted(store.RESOLUTIONS), required=True)
    v.add_argument("--reason")
    v.add_argument("--dry-run", action="store_true")
    v.set_defaults(do=resolve)
    d = sub.add_parser("discover")
    for name in ("links", "seeds", "prefix"):
        d.add_argument(f"--{name}", required=True)
    d.add_argument("--out")
    d.set_defaults(do=discover)
    return p


def main(argv: list[str] | None = None) -> int:
    a = parser().parse_args(argv)
    return a.do(a)


if __name__ == "__main__":
    sys.exit(main())
