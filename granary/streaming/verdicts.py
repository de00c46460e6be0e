"""Stateful streams with a time to live: robots verdicts by host, and the circuit breaker.

Both keep their state by key in Spark's state store (RocksDB): `use_state_store` sets it for a session. Rows of a key are taken in the order of
seq in each of the batches that Spark hands over.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from granary.operators.robots import TTL_SECONDS

VERDICTS = "robots_url string, seq long, url string, allowed boolean, delay double, fetch boolean"
BREAKER = "source string, seq long, consecutive_errors int, tripped boolean"


def use_state_store(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


class _Verdicts(StatefulProcessor):
    def __init__(self, ttl_ms: int):
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.kept = handle.getValueState("verdict", "allowed boolean, delay double", self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        known = self.kept.get() if self.kept.exists() else None
        for frame in rows:
            out = []
            for r in frame.sort_values("seq", kind="stable").itertuples(index=False):
                if r.allowed is not None and r.allowed == r.allowed:  # what a fetch has found
                    delay = None if r.delay is None or r.delay != r.delay else float(r.delay)
                    known = (bool(r.allowed), delay)
                    if r.cached:
                        self.kept.update(known)
                    elif self.kept.exists():
                        self.kept.clear()
                else:
                    out.append((key[0], r.seq, r.url, None if known is None else known[0], None if known is None else known[1], known is None))
            yield pd.DataFrame(out, columns=["robots_url", "seq", "url", "allowed", "delay", "fetch"]).astype({"allowed": "object", "seq": "int64", "fetch": "bool"})

    def close(self) -> None:
        pass


def verdict_stream(events: DataFrame, ttl_seconds: float = TTL_SECONDS) -> DataFrame:
    """robots_url, seq, url, allowed, delay, fetch for each question in a stream of events(robots_url, seq, url, allowed, delay, cached).

    A row with `allowed` is what a fetch of the host's file has found, one without asks. A verdict answers the questions behind it for
    the time to live; one that is not `cached` (a server's error, no answer) only those of its own micro-batch. What no verdict
    answers has fetch = true."""
    return events.groupBy("robots_url").transformWithStateInPandas(_Verdicts(int(ttl_seconds * 1000)), VERDICTS, "Append", "ProcessingTime")


class _Breaker(StatefulProcessor):
    def __init__(self, errors: int, rest_ms: int):
        self.errors, self.rest_ms = errors, rest_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.run = handle.getValueState("run", "n int")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        run = self.run.get()[0] if self.run.exists() else 0
        before = run
        for frame in rows:
            out = []
            for r in frame.sort_values("seq", kind="stable").itertuples(index=False):
                out.append((key[0], int(r.seq), run, run >= self.errors))
                run = 0 if r.ok else run + 1
            yield pd.DataFrame(out, columns=["source", "seq", "consecutive_errors", "tripped"])
        self.run.update((run,))
        if run >= self.errors > before:
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.rest_ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        self.run.clear()
        yield pd.DataFrame({"source": [key[0]], "seq": pd.array([None], "Int64"), "consecutive_errors": [0], "tripped": [False]})

    def close(self) -> None:
        pass


def resting_breaker_stream(attempts: DataFrame, errors: int = 3, rest_seconds: float = 600) -> DataFrame:
    """source, seq, consecutive_errors, tripped of a stream of attempts(source, seq, ok). A breaker that trips closes again after the
    rest, by a timer, which gives a row without seq."""
    return attempts.groupBy("source").transformWithStateInPandas(_Breaker(errors, int(rest_seconds * 1000)), BREAKER, "Append", "ProcessingTime")
