"""Reports over the store and the traces."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from granary.operators import scan

DIAGNOSES = ("structure-drift", "anti-bot", "redirect", "adapter-bug", "schema-too-strict")


def state_counts(canonical: DataFrame, failed: DataFrame) -> DataFrame:
    """source, n_canonical, n_unresolved."""
    ok = canonical.groupBy("source").agg(F.count("*").alias("n_canonical"))
    open_ = failed.groupBy("source").agg(F.count_if(F.col("resolution").isNull()).alias("n_unresolved"))
    return ok.join(open_, "source", "full_outer").select("source", F.coalesce("n_canonical", F.lit(0)).alias("n_canonical"), F.coalesce("n_unresolved", F.lit(0)).alias("n_unresolved"))


def bucket_counts(batch: DataFrame, by: list[str], buckets: list[str], bucket: str = "bucket") -> DataFrame:
    """A count for each bucket, and the sum that must be all of them."""
    counts = [F.count_if(F.col(bucket) == b).alias(b) for b in buckets]
    return batch.groupBy(*by).agg(*counts, F.count("*").alias("iterated"))


def change_rollup(changes: DataFrame) -> DataFrame:
    """Changes by source, id and field, with the totals of each level."""
    return changes.rollup("source", "source_id", "field").agg(F.count("*").alias("n_changes"), F.grouping_id().alias("level"))


def change_rate(changes: DataFrame) -> DataFrame:
    """Changes by month, and whether they are more than 50."""
    return changes.groupBy(F.trunc("changed_at", "month").alias("month")).agg(F.count("*").alias("n_changes")).withColumn("over_limit", F.col("n_changes") > 50)


def change_share(changes: DataFrame, canonical: DataFrame) -> DataFrame:
    """Changes by month, the records there are, and whether more than a tenth of as many changed."""
    size = canonical.agg(F.count("*").alias("n_records"))  # one row
    share = F.col("n_changes") > 0.1 * F.col("n_records")
    return change_rate(changes).drop("over_limit").join(F.broadcast(size)).withColumn("over_share", share)


def with_payload_field(canonical: DataFrame, path: str, kind: str, test: Callable[[Column], Column]) -> DataFrame:
    """Records whose payload has a value of that type at a path for which the test holds."""
    return canonical.where(F.coalesce(test(F.try_variant_get(F.try_parse_json("payload"), path, kind)), F.lit(False)))


def real_changes(changes: DataFrame) -> DataFrame:
    """Without changes that are noise: equal when read as JSON, or as text without outer white space."""
    same = F.try_parse_json("old_value").cast("string").eqNullSafe(F.try_parse_json("new_value").cast("string"))
    return changes.where(~(same | (F.trim(F.regexp_replace("old_value", '^"|"$', "")) == F.trim(F.regexp_replace("new_value", '^"|"$', "")))))


def trace_report(spans: DataFrame, by: list[str], duration: str = "duration_ms", credits: Column | None = None) -> DataFrame:
    """Spans, errors, exact latency quantiles and, if given, the sum of credits."""
    q = lambda p: F.percentile(duration, p)
    return spans.groupBy(*by).agg(F.count("*").alias("n_spans"), F.count_if(F.col("status") == "error").alias("n_errors"), q(0.5).alias("p50"), q(0.95).alias("p95"), F.max(duration).alias("longest"), *([] if credits is None else [F.coalesce(F.sum(credits), F.lit(0)).cast("long").alias("credits")]))


def latency_sketches(spans: DataFrame, by: list[str], at: str, duration: str = "duration_ms", k: int = 400) -> DataFrame:
    """A row for each group and day: spans, errors, the longest, and a mergeable quantile sketch of durations, of bounded size."""
    day = F.col(at).cast("date").alias("day")
    return spans.groupBy(*by, day).agg(F.count("*").alias("n_spans"), F.count_if(F.col("status") == "error").alias("n_errors"), F.max(duration).alias("longest"), F.kll_sketch_agg_double(F.col(duration).cast("double"), k).alias("sketch"))


def report_of_sketches(sketches: DataFrame, by: list[str]) -> DataFrame:
    """trace_report of days that latency_sketches has kept: the same, but for quantiles whose ranks are within some 1.5 % (k = 400)."""
    merged = sketches.groupBy(*by).agg(F.sum("n_spans").alias("n_spans"), F.sum("n_errors").alias("n_errors"), F.max("longest").alias("longest"), F.kll_merge_agg_double("sketch").alias("sketch"))
    known = F.kll_sketch_get_n_double("sketch") > 0  # an empty sketch has no quantiles
    q = lambda p: F.when(known, F.kll_sketch_get_quantile_double("sketch", F.lit(p)))
    return merged.select(*by, "n_spans", "n_errors", q(0.5).alias("p50"), q(0.95).alias("p95"), "longest")


def failures_with_raw(failed: DataFrame, raw: DataFrame, n: int = 10) -> DataFrame:
    """The latest failures with what was fetched."""
    last = failed.orderBy(F.col("detected_at").desc(), F.col("id").desc()).limit(n)
    return F.broadcast(last).join(raw.select(F.col("id").alias("raw_id"), "source_id", "raw_payload"), "raw_id")  # n rows


def failure_ratio(attempts: DataFrame, at: str, failed: Column, by: list[str], hours: int = 24, rows: int = scan.ROWS) -> DataFrame:
    """attempts with the share of failures in the trailing hours, those of the same moment and of exactly so many hours ago included.

    An attempt enters the count at its time and leaves it just after the hours have passed; both are brought together by moment, and the
    share at a moment is a running sum, which runs in blocks. An attempt without a time has no ratio."""
    us, bad = F.unix_micros(F.col(at).cast("timestamp")), F.coalesce(failed, F.lit(False)).cast("long")
    moves = attempts.where(F.col(at).isNotNull()).select(*by, us.alias("_us"), bad.alias("_bad"))
    stay = hours * 3_600_000_000 + 1
    both = F.inline(F.array(F.struct(F.col("_us").alias("_t"), F.lit(1).alias("_n"), F.col("_bad").alias("_f"), F.lit(1).alias("_enter")), F.struct((F.col("_us") + stay).alias("_t"), F.lit(-1).alias("_n"), (-F.col("_bad")).alias("_f"), F.lit(0).alias("_enter"))))
    moments = moves.select(*by, both).groupBy(*by, "_t").agg(F.sum("_n").alias("_n"), F.sum("_f").alias("_f"), F.max("_enter").alias("_enter"))
    upto = scan.inside(by, "_t").rowsBetween(W.Window.unboundedPreceding, 0)
    own = scan.blocks(moments, by, ["_t"], rows)
    carry = scan.carried(own, by, n=F.sum("_n"), f=F.sum("_f")).select(*by, scan.BLOCK, "n_before", "f_before")
    own = own.withColumns({"_n": F.sum("_n").over(upto), "_f": F.sum("_f").over(upto)}).where("_enter = 1")
    share = (F.col("f_before") + F.col("_f")) / (F.col("n_before") + F.col("_n"))
    ratios = scan.joined(own, carry, by).select(*[F.col(c).alias(f"_of_{c}") for c in by], "_t", share.alias("ratio"))
    same = [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in by]
    return attempts.join(ratios, [*same, us == F.col("_t")], "left").select(*attempts.columns, "ratio")


def timeout_escalation(batches: DataFrame, window: int = 3) -> DataFrame:
    """batches(source, batch, is_timeout) with escalate: more than a third of the last batches had a timeout."""
    per = batches.groupBy("source", "batch").agg(F.max(F.col("is_timeout").cast("int")).alias("had"))
    return per.withColumn("escalate", F.avg("had").over(W.Window.partitionBy("source").orderBy("batch").rowsBetween(1 - window, 0)) > 1 / 3)


def run_summary(runs: DataFrame, ok: Column) -> DataFrame:
    n = F.count_if(ok)
    return runs.agg(F.count("*").alias("runs"), n.alias("succeeded"), F.when(n == F.count("*"), "stable").when(n == 0, "broken").otherwise("intermittent").alias("verdict"))


def diagnosis(error: Column) -> Column:
    """A failure's likely class by its message."""
    low = F.lower(error)
    return (
        F.when(low.rlike("robot|access denied|forbidden"), DIAGNOSES[1]).when(low.rlike("not found|redirect"), DIAGNOSES[2])
        .when(low.rlike("source_id|source_url"), DIAGNOSES[3]).when(low.rlike("required|at least"), DIAGNOSES[0]).otherwise(DIAGNOSES[4])
    )


def records_since(canonical: DataFrame, source: str, since: Column) -> DataFrame:
    return canonical.where((F.col("source") == source) & (F.col("valid_from") >= since))


def drifted(captured: DataFrame, known: DataFrame) -> DataFrame:
    """ids whose content hash is another than the known one."""
    return captured.join(known.select("id", F.col("content_hash").alias("_known")), "id").where(F.col("content_hash") != F.col("_known")).select("id")


def markdown_table(rows: DataFrame, n: int = 50) -> str:
    """The first n rows as a Markdown table."""
    head, found = rows.columns, rows.limit(n).collect()
    line = lambda xs: "| " + " | ".join(str(x).replace("|", "\\|").replace("\n", " ") for x in xs) + " |"
    return "\n".join([line(head), line(["---"] * len(head)), *(line(r) for r in found)])
