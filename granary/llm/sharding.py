"""Sharding by a two-pass external shuffle, in DataFrame functions alone.

The first pass scatters records uniformly over buckets by a seeded hash; a bucket fits in memory. The
second takes each bucket by itself, shuffles it (Spark's shuffle() is a Fisher-Yates shuffle) and gives
its records the next places. Shards are equal runs of these places, so that their counts of rows are at
most one apart.
"""

from __future__ import annotations

import functools
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import window as W

from granary.llm.common import by_position, unused

#: Bytes of records that are shuffled in memory together, and how many records with equal keys one bucket may get.
BUCKET_BYTES, EQUAL_ROWS = 8 << 20, 10_000


def record_bytes(df: DataFrame) -> Column:
    """What a record weighs, by its values."""
    weights = [F.lit(16)]
    for f in df.schema.fields:
        kind, c = f.dataType.typeName(), F.col(f"`{f.name}`")
        if kind in ("string", "binary"):
            weights.append(F.octet_length(c))
        else:
            weights.append(F.octet_length(F.to_json(F.struct(c))) if kind in ("array", "struct", "map") else F.lit(16))
    return functools.reduce(lambda a, b: a + b, [F.coalesce(w, F.lit(0)) for w in weights])


def orderable(field: T.StructField) -> bool:
    """Whether Spark can compare values of a column: not where they hold maps or variants."""
    return not any(x in field.dataType.simpleString() for x in ("map<", "variant", "interval"))


def two_pass_shuffle(df: DataFrame, key: list[str], n_shards: int = 8, row_bytes: Column | None = None, bucket_bytes: int = BUCKET_BYTES, seed: int = 29) -> DataFrame:
    """df with shard (0 to n_shards - 1) and slot (from 0, without gaps). The same rows and seed give the same result.

    key: columns that tell records apart; rows that are equal in them are equal to us, and land in one bucket. Only of a key that
    more than EQUAL_ROWS rows have, rows are dealt over all buckets by where they stand in the input, and then the same result needs
    the same input files, too. row_bytes: what a record weighs (by default, its values' bytes). Nulls in any column are values like
    others; an empty table gives an empty one. Columns may have any name and type; where df has one that is called shard or slot, it
    stays, and ours is called _shard or _slot.
    """
    asked, shard_name, slot_name = df, unused(df, "shard"), unused(df, "slot")
    df, key = by_position(asked, *key)
    weigh = (row_bytes if row_bytes is not None else record_bytes(df)).cast("double")
    total = (df if row_bytes is None else asked).agg(F.sum(weigh).alias("bytes"), F.count("*").alias("n")).first()
    n = int(total["n"])
    n_buckets = max(1, math.ceil((total["bytes"] or 0) / bucket_bytes))
    rest = [c for c in df.columns if c not in key]  # a record holds each column once
    tie = F.xxhash64(*key, F.lit(seed))
    ordered = all(map(orderable, df.schema))
    stands = F.lit(0) if ordered else F.xxhash64(*[F.col(f.name) if orderable(f) else F.to_json(F.struct(f.name)) for f in df.schema])
    fields = [tie.alias("_tie"), stands.alias("_order"), *[F.col(c).alias(f"_key{k}") for k, c in enumerate(key)], F.struct(*rest, F.lit(0).alias("_")).alias("_row")]
    # a row's place in the input is read where it is read, so that both uses below deal it alike
    records = df.select(F.struct(*fields).alias("_record"), tie.alias("_tie"), F.monotonically_increasing_id().alias("_at"))
    hot = df.groupBy(tie.alias("_tie")).count().where(F.col("count") > EQUAL_ROWS).select("_tie", F.lit(True).alias("_hot"))
    salt = F.when(F.col("_hot"), F.col("_at")).otherwise(F.lit(0))
    if n > EQUAL_ROWS:  # at most n / EQUAL_ROWS keys are hot, of 8 bytes each: 8 MB for 10**10 rows
        records = records.join(F.broadcast(hot) if n <= EQUAL_ROWS * 10**6 else hot, "_tie", "left")
    else:
        records = records.withColumn("_hot", F.lit(False))
    scattered = records.select("_record", F.pmod(F.xxhash64("_tie", salt, F.lit(seed + 1)), F.lit(n_buckets)).alias("_bucket"))
    buckets = scattered.repartition(n_buckets, "_bucket").groupBy("_bucket").agg(F.collect_list("_record").alias("_records"))
    # shuffle() draws from one generator a partition: with its buckets in order, they get the same draws again
    by_hash = lambda a, b: F.when((a["_tie"] < b["_tie"]) | ((a["_tie"] == b["_tie"]) & (a["_order"] < b["_order"])), -1).when((a["_tie"] == b["_tie"]) & (a["_order"] == b["_order"]), 0).otherwise(1)
    in_order = F.array_sort("_records") if ordered else F.array_sort("_records", by_hash)
    buckets = buckets.withColumn("_records", in_order).sortWithinPartitions("_bucket").select("_bucket", F.shuffle("_records", seed).alias("_records"))
    before = scattered.groupBy("_bucket").agg(F.count("*").alias("_n")).withColumn("_before", F.coalesce(F.sum("_n").over(W.Window.orderBy("_bucket").rowsBetween(W.Window.unboundedPreceding, -1)), F.lit(0)))
    placed = buckets.join(before.select("_bucket", "_before"), "_bucket").select("_before", F.posexplode("_records").alias("_i", "_record"))
    placed = placed.select(*[F.col(f"_record._key{key.index(c)}" if c in key else f"_record._row.{c}").alias(c) for c in df.columns], (F.col("_before") + F.col("_i")).cast("long").alias("_place"))
    small, large = divmod(n, n_shards)[0], divmod(n, n_shards)[1]  # the first `large` shards have one row more
    edge = large * (small + 1)
    shard = F.when(F.col("_place") < edge, F.expr(f"_place div {small + 1}")).otherwise(large + F.expr(f"(_place - {edge}) div {max(small, 1)}")).cast("int")
    start = F.when(F.col("shard") <= large, F.col("shard") * (small + 1)).otherwise(edge + (F.col("shard") - large) * small)
    return placed.withColumn("shard", shard).withColumn("slot", (F.col("_place") - start).cast("long")).drop("_place").toDF(*asked.columns, shard_name, slot_name)


def write_shards(sharded: DataFrame, path: str) -> None:
    """Writes each shard as a folder shard=K of Parquet files whose rows are in the order of their slots."""
    sharded.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
