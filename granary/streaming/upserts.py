"""Structured Streaming forms of the store's operators: files of fetched payloads in, versions and changes out."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from granary.functions.validate import validate
from granary.operators import store as stores

INCOMING = "seq long, source string, source_id string, url string, payload string"


def upsert_stream(incoming: DataFrame, store: stores.Store, checkpoint: str, page_type: str, now: Column | None = None, once: bool = True, name: str = "stream") -> StreamingQuery:
    """Writes each micro-batch as a batch does: all payloads to the raw log, invalid ones to the failure queue, the changes and
    versions of valid ones. A micro-batch that is replayed after a crash does what is left (store.commit)."""
    now = F.current_timestamp() if now is None else now

    def write(batch: DataFrame, epoch: int) -> None:
        stores.commit(store, validate(batch, page_type), now, f"{name}-{epoch}")

    writer = incoming.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def distinct_content(incoming: DataFrame, at: str, delay: str = "1 hour") -> DataFrame:
    """The first arrival of each content hash within the watermark."""
    hashed = incoming.withColumn("content_hash", F.sha2(stores.canonical_json(F.col("payload")).cast("binary"), 256))
    return hashed.withWatermark(at, delay).dropDuplicatesWithinWatermark(["content_hash"])


def breaker_stream(attempts: DataFrame, errors: int = 3) -> DataFrame:
    """source, seq, consecutive_errors, tripped of a stream of attempts(source, seq, ok): the circuit breaker with its state per source."""

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        run = state.get[0] if state.exists else 0
        rows = pd.concat(list(frames)).sort_values("seq")
        out = []
        for seq, ok in zip(rows["seq"], rows["ok"]):
            out.append((key[0], int(seq), run, run >= errors))
            run = 0 if ok else run + 1
        state.update((run,))
        yield pd.DataFrame(out, columns=["source", "seq", "consecutive_errors", "tripped"])

    return attempts.groupBy("source").applyInPandasWithState(step, "source string, seq long, consecutive_errors int, tripped boolean", "run int", "append", GroupStateTimeout.NoTimeout)
