"""Running values in blocks against one pass over each key."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from granary.operators import gate, reports, scan, store


@pytest.fixture(scope="module")
def log(spark):
    rng = random.Random(9)
    rows = [(rng.choice(["hot"] * 6 + ["cold", None]), k, rng.choice(["scrape", "http", None]), rng.choice([True, True, False, None])) for k in range(900)]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "source string, seq long, kind string, ok boolean")


def rows_of(df):
    return sorted(map(repr, map(tuple, df.collect())))


def test_gate_in_blocks(log):
    for budget in (gate.Budget(), gate.Budget(credits=200, errors=2), gate.Budget(errors=6, http_calls=10)):
        whole, parts = gate.gate(log, budget), gate.gate(log, budget, rows=40)
        assert rows_of(whole) == rows_of(parts)
        assert rows_of(gate.admitted(whole)) == rows_of(gate.admitted(parts))


def test_gate_counts_as_a_loop_does(log):
    state, want = {}, []
    for r in sorted(log.collect(), key=lambda r: r.seq):
        credits, http, n, errors = state.get(r.source, (0, 0, 0, 0))
        want.append((r.seq, credits, http, n, errors))
        state[r.source] = (credits + 5 * bool(r.ok and r.kind == "scrape"), http + bool(r.ok and r.kind != "scrape"), n + 1, 0 if r.ok else errors + 1)
    got = [(r.seq, r.credits_used, r.http_used, r.iterations, r.consecutive_errors) for r in gate.gate(log, rows=40).collect()]
    assert sorted(got) == want


def test_schedule(spark):
    """Bursts queue up, pauses free the source, and blocks hand on what waits."""
    rng, rows, want = random.Random(3), [], {}
    for source, n in (("hot", 400), ("cold", 20), (None, 5)):
        t = 0
        for k in range(n):
            t += rng.choice([0, 0, 0, 100_000, 700_000, 3_000_000]) if k != n // 2 else 60_000_000
            rows.append((source, k, dt.datetime(2026, 1, 1) + dt.timedelta(microseconds=t)))
    last = {}
    for source, k, at in rows:
        last[source] = max(at, last[source] + dt.timedelta(seconds=0.5)) if source in last else at
        want[source, k] = (last[source] - at).total_seconds()
    df = spark.createDataFrame([*rows, ("hot", 999, None)], "source string, seq long, ts timestamp")
    for size in (scan.ROWS, 30):
        got = {(r.source, r.seq): r.wait_s for r in gate.schedule(df, 2.0, rows=size).collect()}
        assert got.pop(("hot", 999)) is None and got.keys() == want.keys()
        assert all(abs(got[k] - want[k]) < 1e-9 for k in want)
    assert max(want.values()) > 10
    three = spark.createDataFrame([("s", k, dt.datetime(2026, 1, 1)) for k in range(3)], "source string, seq long, ts timestamp")
    assert sorted(r.wait_s for r in gate.schedule(three, 1.0).collect()) == [0.0, 1.0, 2.0]
    assert gate.schedule(three.limit(0), 1.0).count() == 0


def test_failure_ratio(spark):
    rng = random.Random(5)
    start = dt.datetime(2026, 1, 1)
    times = [start + dt.timedelta(hours=rng.randrange(0, 200), minutes=rng.choice([0, 0, 7])) for _ in range(500)]
    rows = [(k, rng.choice(["hot"] * 5 + ["cold", None]), t, rng.choice([True, False, None])) for k, t in enumerate(times)] + [(900, "hot", None, True)]
    df = spark.createDataFrame(rows, "k long, source string, at timestamp, bad boolean")
    want = {}
    for k, s, t, _ in rows[:-1]:
        inside = [bool(b) for _, z, u, b in rows[:-1] if z == s and t - dt.timedelta(hours=24) <= u <= t]
        want[k] = sum(inside) / len(inside)
    for size in (scan.ROWS, 25):
        out = reports.failure_ratio(df, "at", F.col("bad"), ["source"], rows=size)
        got = {r.k: r.ratio for r in out.collect()}
        assert got.pop(900) is None and got == want
        assert "SinglePartition" not in out._jdf.queryExecution().executedPlan().toString()


def test_blocks_stay_small(spark):
    """One row far from all others, a source with nearly all rows, and ties."""
    df = spark.range(299_999).select("id", (F.col("id") % 1000).alias("tie")).union(spark.createDataFrame([(10**15, 0)], "id long, tie long")).withColumn("source", F.when(F.col("id") % 100 == 0, "other").otherwise("hot"))
    blocked = scan.blocks(df.repartition(6), ["source"], ["id"], 10_000)
    sizes = [r["count"] for r in blocked.groupBy("source", scan.BLOCK).count().collect()]
    assert len(sizes) > 20 and max(sizes) <= 20_000
    ids = store.dense_ids(df.select("id"), "id", 7, name="n", rows=10_000)
    wrong = ids.where(F.col("n") != F.when(F.col("id") < 10**12, F.col("id") + 8).otherwise(300_007))
    assert ids.count() == 300_000 and wrong.count() == 0
    tied = store.dense_ids(df, "tie", name="n", ties=("id",), rows=10_000)
    r = tied.agg(F.min("n"), F.max("n"), F.countDistinct("n")).first()
    assert tuple(r) == (1, 300_000, 300_000)
