"""Budget gate, circuit breaker and rate schedule over an attempt log.

The log has one row per attempt: source, seq (its order), kind ('scrape', 'http', or 'listing' for a page of a listing, which is an HTTP
call but no iteration), ok. What the gate knows before
an attempt is what the source's earlier attempts have left. A source's log runs in blocks (scan), so that a source with most of the
attempts is many tasks: what a block hands on is its credits, calls and attempts, and where its last success was.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from granary.operators import scan


@dataclass(frozen=True)
class Budget:
    credits: int = 100
    iterations: int = 200
    errors: int = 3
    http_calls: int = 200
    scrape_cost: int = 5


def gate(log: DataFrame, budget: Budget = Budget(), by: list[str] | None = None, order: str = "seq", rows: int = scan.ROWS) -> DataFrame:
    """log with credits_used, http_used, iterations, consecutive_errors (before each attempt) and tripped (the reason, or null).
    The order is unique in a source."""
    by = by or ["source"]
    ok, scrape = F.coalesce(F.col("ok"), F.lit(False)), F.coalesce(F.col("kind") == "scrape", F.lit(False))
    w = scan.inside(by, order)
    earlier, since = w.rowsBetween(W.Window.unboundedPreceding, -1), lambda c: F.coalesce(c, F.lit(0))
    turn = F.when(F.col("kind").eqNullSafe("listing"), 0).otherwise(1)
    paid, called = F.when(ok & scrape, budget.scrape_cost).otherwise(0), F.when(ok & ~scrape, 1).otherwise(0)
    own = scan.blocks(log, by, [order], rows).withColumn("_at", F.row_number().over(w))
    own = own.withColumns({"_paid": since(F.sum(paid).over(earlier)), "_called": since(F.sum(called).over(earlier)), "_turns": since(F.sum(turn).over(earlier)), "_ok": F.max(F.when(ok, F.col("_at"))).over(earlier)})
    carry = scan.carried(own, by, n=F.count("*"), paid=F.sum(paid), called=F.sum(called), turns=F.sum(turn))
    good = own.where(ok).groupBy(*by, scan.BLOCK).agg(F.max("_at").alias("last"))
    last = scan.joined(carry, good, by).select(*by, scan.BLOCK, (F.col("n_before") + F.col("last")).alias("last"))
    names = {c: f"_of_{c}" for c in (*by, scan.BLOCK)}
    carry = carry.join(last.withColumnsRenamed(names), [carry[c].eqNullSafe(F.col(x)) for c, x in names.items()], "left").drop(*names.values())
    carry = carry.withColumn("last_before", since(F.max("last").over(scan.before(by)))).select(*by, scan.BLOCK, "n_before", "paid_before", "called_before", "turns_before", "last_before")
    used = scan.joined(own, carry, by).withColumns({
        "credits_used": (F.col("paid_before") + F.col("_paid")).cast("long"),
        "http_used": (F.col("called_before") + F.col("_called")).cast("long"),
        "iterations": (F.col("turns_before") + F.col("_turns")).cast("long"),
        "consecutive_errors": (F.col("n_before") + F.col("_at") - 1 - F.greatest(F.col("last_before"), since(F.col("n_before") + F.col("_ok")))).cast("long"),
    })
    reason = (
        F.when(scrape & (F.col("credits_used") + budget.scrape_cost > budget.credits), "cost cap reached")
        .when(~scrape & (F.col("http_used") + 1 > budget.http_calls), "HTTP cap reached")
        .when((turn == 1) & (F.col("iterations") >= budget.iterations), "iteration cap reached")
        .when(F.col("consecutive_errors") >= budget.errors, "circuit breaker tripped")
    )
    return used.select(*log.columns, "credits_used", "http_used", "iterations", "consecutive_errors", reason.alias("tripped"))


def admitted(gated: DataFrame, by: list[str] | None = None, order: str = "seq") -> DataFrame:
    """The attempts before the first trip of each source; that of the trip and all later ones never happen."""
    by = by or ["source"]
    first = gated.where(F.col("tripped").isNotNull()).groupBy(*by).agg(F.min(order).alias("_first"))
    names = {c: f"_of_{c}" for c in by}
    stop = first.withColumnsRenamed(names)
    out = gated.join(stop, [gated[c].eqNullSafe(stop[x]) for c, x in names.items()], "left")
    return out.where(F.col("_first").isNull() | (F.col(order) < F.col("_first"))).select(*gated.columns)


def required_wait(log: DataFrame, rps: float, at: str = "ts", by: list[str] | None = None) -> DataFrame:
    """log with wait_s: how long each call of a source would have to wait to keep 1 / rps seconds after the last one's start."""
    last = F.lag(at).over(W.Window.partitionBy(*(by or ["source"])).orderBy(at, *[c for c in ("event_id", "seq") if c in log.columns]))
    gap = (F.unix_micros(F.col(at).cast("timestamp")) - F.unix_micros(last.cast("timestamp"))) / 1e6
    return log.withColumn("wait_s", F.when(gap.isNull(), 0.0).otherwise(F.greatest(F.lit(0.0), 1.0 / rps - gap)))


def schedule(log: DataFrame, rps: float, at: str = "ts", by: list[str] | None = None, order: list[str] | None = None, rows: int = scan.ROWS) -> DataFrame:
    """log with start (a timestamp) and wait_s: when each call of a source may begin if calls begin at least 1 / rps seconds apart, in
    the order of the times they were asked at (and of `order`, which tells calls of one time apart).

    start(i) = max(t(i), start(i - 1) + gap) = i * gap + max over j <= i of (t(j) - j * gap), a running maximum: waits add up over a
    burst, and a pause makes them vanish. Calls without a time have no start and keep no other waiting."""
    by, gap = by or ["source"], round(1_000_000 / rps)
    order = order or [c for c in ("event_id", "seq") if c in log.columns]
    timed = log.where(F.col(at).isNotNull())
    w = scan.inside(by, at, *order)
    own = scan.blocks(timed, by, [at, *order], rows).withColumn("_at", F.row_number().over(w).cast("long"))
    own = own.withColumn("_us", F.unix_micros(F.col(at).cast("timestamp")))
    own = own.withColumn("_peak", F.max(F.col("_us") - F.col("_at") * gap).over(w.rowsBetween(W.Window.unboundedPreceding, 0)))
    carry = scan.carried(own, by, n=F.count("*"))
    peaks = scan.joined(carry, own.groupBy(*by, scan.BLOCK).agg(F.max("_peak").alias("peak")), by)
    peaks = peaks.withColumn("peak_before", F.max(F.col("peak") - F.col("n_before") * gap).over(scan.before(by))).select(*by, scan.BLOCK, "n_before", "peak_before")
    start = F.greatest(F.col("_peak") + F.col("_at") * gap, F.col("peak_before") + (F.col("n_before") + F.col("_at")) * gap)
    done = scan.joined(own, peaks, by).withColumn("_start", start)
    out = done.select(*log.columns, F.timestamp_micros("_start").alias("start"), ((F.col("_start") - F.col("_us")) / 1e6).alias("wait_s"))
    none = log.where(F.col(at).isNull()).select(*log.columns, F.lit(None).cast("timestamp").alias("start"), F.lit(None).cast("double").alias("wait_s"))
    return out.unionAll(none)


class LiveGate:
    """The same rules for a driver that fetches as it goes: check() before a call, done() after it."""

    def __init__(self, budget: Budget = Budget()):
        self.budget = budget
        self.credits = self.http = self.iterations = self.errors = 0

    def check(self, kind: str) -> None:
        b = self.budget
        if kind == "scrape" and self.credits + b.scrape_cost > b.credits:
            raise RuntimeError("cost cap reached")
        if kind == "http" and self.http + 1 > b.http_calls:
            raise RuntimeError("HTTP cap reached")
        if self.iterations >= b.iterations:
            raise RuntimeError("iteration cap reached")
        if self.errors >= b.errors:
            raise RuntimeError("circuit breaker tripped")

    def done(self, kind: str, ok: bool) -> None:
        self.iterations += 1
        self.errors = 0 if ok else self.errors + 1
        if ok:
            self.credits += self.budget.scrape_cost * (kind == "scrape")
            self.http += kind == "http"

    @contextmanager
    def guard(self, kind: str) -> Iterator[None]:
        """A call: refused before it if the gate trips, counted after it as it went. The rate is the caller's business."""
        self.check(kind)
        ok = False
        try:
            yield
            ok = True
        finally:
            self.done(kind, ok)
