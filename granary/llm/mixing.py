"""Mixing sources to target weights by weighted fair queueing, in DataFrame functions alone.

Each source's documents are shuffled by a hash and queued up to `max_repeats` times. A document's virtual
finish time is the source's cumulative size up to and with it, divided by the source's weight. All are
range-sorted by that time and taken while their sizes sum to no more than the budget.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from granary.llm.common import WORD, Scratch, by_position, unused

#: Rows of a source that are summed together, and queued documents in a range of the global sort.
SUMMED_TOGETHER, SORTED_TOGETHER = 10_000, 100_000
HASH_BITS = 60


def words(text: Column) -> Column:
    """How many words a text has; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def order_hash(ident: Column, seed: int) -> Column:
    """A number below 2**60 that any engine with md5 can make."""
    return F.conv(F.substring(F.md5(F.concat(F.coalesce(ident.cast("string"), F.lit("")), F.lit(f":{seed}"))), 1, HASH_BITS // 4), 16, 10).cast("long")


def shares(sizes: DataFrame, max_repeats: int, budget: Column | None = None) -> DataFrame:
    """Adds each source's target to sizes(source, weight, source_size): the budget (all sizes together) by
    weight, but at most max_repeats times its size, the excess reshared by weight. One row per source."""
    full = F.col("source_size") * max_repeats
    everything = W.Window.partitionBy()
    by_fullness = W.Window.orderBy("fullness", F.col("source").asc_nulls_last())
    fill = sizes.withColumn("fullness", full / F.col("weight")).withColumn("budget", budget if budget is not None else F.sum("source_size").over(everything))
    fill = fill.withColumns({
        "spent": F.coalesce(F.sum(full).over(by_fullness.rowsBetween(W.Window.unboundedPreceding, -1)), F.lit(0)),
        "weights": F.sum("weight").over(by_fullness.rowsBetween(0, W.Window.unboundedFollowing)),
    })
    level = (F.col("budget") - F.col("spent")) / F.col("weights")
    fill = fill.withColumn("level", F.max(F.when(level <= F.col("fullness"), level)).over(everything))
    target = F.when(F.col("level").isNull(), full).otherwise(F.least(full.cast("double"), F.col("weight") * F.col("level")))
    return fill.select("source", "weight", "source_size", F.greatest(target, F.lit(0.0)).cast("double").alias("target"))


OURS = ("_size", "_source_size", "_target", "_taken")


def mix(df: DataFrame, size: Column, weight: Column | None = None, id_col: str = "doc_id", source_col: str = "source", max_repeats: int = 3, seed: int = 17) -> DataFrame:
    """df with _size, _source_size, _target and _taken: how much of each document the mix takes, a multiple of
    its size. weight: of the column `source_rank` (1, 2, ... by code point, null last); 1, 2, 3 repeating by default.

    Null sources are one source; null ids are ordered as the empty text; a null size counts as 0, and what
    has no size is never taken. Documents that tie in hash and id are ordered by size; equal rows are
    interchangeable. An empty table gives an empty one. Columns of df with one of the four names are replaced.
    """
    out = queued(df, size, weight, id_col, source_col, max_repeats, seed)
    kept = [(k, c) for k, c in enumerate(df.columns) if c.lower() not in OURS]
    return out.select(*[f"c{k}" for k, _ in kept], *OURS).toDF(*[c for _, c in kept], *OURS)


def queued(df: DataFrame, size: Column, weight: Column | None, id_col: str, source_col: str, max_repeats: int, seed: int) -> DataFrame:
    """mix() with df's columns named c0, c1, ..., so that no name of theirs can clash."""
    scratch = Scratch(df.sparkSession)
    plain, (id_name, source_name) = by_position(df.withColumn(unused(df, "size"), F.coalesce(size, F.lit(0)).cast("long")), id_col, source_col)
    *names, sized = plain.columns
    source = F.col(source_name)
    docs = plain.select(*names, F.col(sized).alias("_size"), order_hash(F.col(id_name), seed).alias("_hash"), F.coalesce(source, F.lit("")).alias("_key"), source.isNull().alias("_none"))
    docs = scratch.save(docs, "documents")  # texts are measured once; what follows reads the narrow columns
    weight = (F.col("source_rank") - 1) % 3 + 1 if weight is None else weight
    sizes = docs.groupBy("_key", "_none").agg(F.sum("_size").alias("source_size"), F.count("*").alias("rows"))
    sizes = sizes.withColumn("source", F.when(~F.col("_none"), F.col("_key"))).withColumn("source_rank", F.row_number().over(W.Window.orderBy(F.col("_none"), F.col("_key")))).withColumn("weight", weight)
    sizes = scratch.save(sizes, "sizes")
    targets = shares(sizes.select("source", "weight", "source_size"), max_repeats)
    sources = sizes.join(targets.select("source", "target"), sizes["source"].eqNullSafe(targets["source"])).select("_key", "_none", F.col("source_size").alias("_source_size"), F.col("weight").alias("_weight"), F.col("source_rank").alias("_rank"), F.col("target").alias("_target"), F.ceil(F.greatest(F.col("rows"), F.lit(1)) / SUMMED_TOGETHER).alias("_buckets"))
    sources = scratch.save(sources, "sources")
    totals = sizes.agg(F.sum("source_size").alias("budget"), F.sum("rows").alias("rows")).first()
    budget, rows = int(totals["budget"] or 0), int(totals["rows"] or 0)

    # cumulative sizes in the order of the hash: within ranges of it, after the sums of earlier ranges
    docs = docs.join(sources, ["_key", "_none"]).withColumn("_bucket", F.expr(f"shiftright(_hash, {HASH_BITS - 30}) * _buckets div {1 << 30}"))
    within = W.Window.partitionBy("_key", "_none", "_bucket").orderBy("_hash", id_name, "_size").rowsBetween(W.Window.unboundedPreceding, 0)
    before = docs.groupBy("_key", "_none", "_bucket").agg(F.sum("_size").alias("_before"))
    before = before.withColumn("_before", F.coalesce(F.sum("_before").over(W.Window.partitionBy("_key", "_none").orderBy("_bucket").rowsBetween(W.Window.unboundedPreceding, -1)), F.lit(0)))
    before = scratch.save(before, "before")
    docs = docs.join(before, ["_key", "_none", "_bucket"]).withColumn("_sum", F.sum("_size").over(within) + F.col("_before"))

    epochs = [F.struct(((F.col("_sum") + F.col("_source_size") * k) / F.col("_weight")).alias("_time")) for k in range(max_repeats)]
    queue = docs.where("_size > 0").select("_rank", "_size", F.explode(F.array(*epochs)).alias("e")).select("_rank", "_size", F.col("e._time").alias("_time"))
    n = max(1, math.ceil(rows * max_repeats / SORTED_TOGETHER))
    queue = scratch.save(queue.repartitionByRange(n, "_time", "_rank").withColumn("_part", F.spark_partition_id()), "queue")
    parts = queue.groupBy("_part").agg(F.sum("_size").alias("_earlier")).withColumn("_earlier", F.coalesce(F.sum("_earlier").over(W.Window.orderBy("_part").rowsBetween(W.Window.unboundedPreceding, -1)), F.lit(0)))
    running = queue.join(parts, "_part").withColumn("_running", F.col("_earlier") + F.sum("_size").over(W.Window.partitionBy("_part").orderBy("_time", "_rank").rowsBetween(W.Window.unboundedPreceding, 0)))
    last = running.where(F.col("_running") <= budget).agg(F.max(F.struct("_time", "_rank")).alias("last")).first()["last"]
    scratch.drop("queue")

    at, rank = (last["_time"], last["_rank"]) if last else (-1.0, 0)
    times = [((F.col("_sum") + F.col("_source_size") * k) / F.col("_weight")) for k in range(max_repeats)]
    taken = sum((F.when((t < at) | ((t == at) & (F.col("_rank") <= rank)), 1).otherwise(0) for t in times), F.lit(0))
    return docs.withColumn("_taken", (F.col("_size") * taken).cast("long")).select(*names, *OURS)


def mixed(df: DataFrame, text_col: str = "text", weight: Column | None = None, id_col: str = "doc_id", source_col: str = "source", max_repeats: int = 3, seed: int = 17) -> DataFrame:
    """The mix itself: each row as often as it is taken, in df's own columns whatever their names. Null and empty texts have
    no words and are never taken; all else is as in mix()."""
    plain, (text, ident, source) = by_position(df, text_col, id_col, source_col)
    out = queued(plain, words(F.col(text)), weight, ident, source, max_repeats, seed).where("_taken > 0")
    out = out.withColumn("_copy", F.explode(F.sequence(F.lit(1), (F.expr("_taken div _size")).cast("int"))))
    return out.select(*[f"c{k}" for k in range(len(df.columns))]).toDF(*df.columns)
