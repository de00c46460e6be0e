"""Interaction of filters: what each removes, in every order that they can be applied in, per part of a corpus.

A document is the mask of the filters that it fails. Documents are counted by part, mask and label, at most 4 * 2^n cells a part; the
cells are unpivoted against the steps of all orders, a running bit-or over a cell's earlier steps tells whether it is still there, and
conditional sums and totals over a filter's steps give the figures.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from granary.llm.common import WORD

SIGNS, UPPER = r"[#$%&*|]", "[A-Z]"
LEAST_WORDS, LEAST_DISTINCT, MOST_UPPER = 200, 50, 2


def failures(text: Column) -> dict[str, Column]:
    """Whether a text fails the filters that look at itself alone."""
    words = F.regexp_extract_all(text, F.lit(f"({WORD})"), F.lit(1))
    return {
        "A": F.size(words) < LEAST_WORDS,
        "B": 100 * F.size(F.array_distinct(words)) < LEAST_DISTINCT * F.size(words),
        "C": 100 * F.regexp_count(text, F.lit(UPPER)) > MOST_UPPER * F.char_length(text),
        "D": text.rlike(SIGNS),
    }


def masks(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask (a bit for each failed filter, A the lowest), good, toxic, n: how many documents there are of each kind.

    Equal rows are brought together first, so that a text or id that many rows have is one row for each. The first row of a text is
    found by its digest, and marked by a join on digest and id, which no text makes hot."""
    text = F.coalesce(docs["text"], F.lit(""))
    rows = docs.select(docs["doc_id"].alias("id"), F.coalesce(docs["source"], F.lit("")).alias("part"), text.alias("text"))
    own = sum((F.when(bad, 1 << k).otherwise(0) for k, bad in enumerate(failures(F.col("text")).values())), F.lit(0))
    rows = rows.select("id", "part", F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest"), own.alias("own"))
    rows = rows.groupBy("id", "part", "digest", "own").agg(F.count("*").alias("n"))
    first = rows.groupBy("digest").agg(F.min("id").alias("id")).where("id is not null").withColumn("first", F.lit(True))
    known = labels.groupBy("doc_id").agg(F.max(F.col("quality").eqNullSafe(1)).alias("good"), F.max(F.col("toxic").eqNullSafe(1)).alias("toxic")).withColumnRenamed("doc_id", "id")
    copy = F.col("id").isNotNull() & F.col("first").isNull()
    marked = rows.join(first, ["id", "digest"], "left").join(known, "id", "left")
    mask = F.col("own") + F.when(copy, 16).otherwise(0)
    flag = lambda c: F.coalesce(c, F.lit(False)).alias(c)
    return marked.groupBy("part", mask.alias("mask"), flag("good"), flag("toxic")).agg(F.sum("n").alias("n"))


def interactions(cells: DataFrame, names: str) -> DataFrame:
    """The figures for cells(part, mask, good, toxic, n): a row per part, order of the filters and step."""
    figures = [F.sum("n").alias("n"), *(F.sum(F.when(F.col(c), F.col("n")).otherwise(0)).alias(c) for c in ("good", "toxic"))]
    wide = cells.groupBy("part", "mask").agg(*figures)
    orders = F.array(*[F.lit("".join(p)) for p in permutations(names)])
    steps = F.posexplode(F.split("filter_order", "")).alias("at", "filter")
    long = wide.withColumn("filter_order", F.explode(orders)).select("*", steps)
    bit = sum((F.when(F.col("filter") == x, 1 << k).otherwise(0) for k, x in enumerate(names)), F.lit(0))
    long = long.withColumn("bit", bit).withColumn("fails", F.col("mask").bitwiseAND(F.col("bit")))
    earlier = W.Window.partitionBy("part", "mask", "filter_order").orderBy("at").rowsBetween(W.Window.unboundedPreceding, -1)
    long = long.withColumn("before", F.coalesce(F.bit_or("fails").over(earlier), F.lit(0)))
    here, there = F.col("fails") != 0, F.col("before") == 0
    total = lambda test, x="n": F.sum(F.when(test, F.col(x)).otherwise(0))
    out = long.groupBy("part", "filter_order", (F.col("at") + 1).alias("step"), "filter").agg(
        total(there & ~here).alias("kept"), total(there & here).alias("removed"), total(~there & here).alias("redundant"), total(F.col("mask") == F.col("bit")).alias("unique_fails"),
        total(there & here, "good").alias("good_lost"), total(there & here, "toxic").alias("toxic_lost"),
    )
    return out.withColumn("shapley", F.sum("removed").over(W.Window.partitionBy("part", "filter"))).drop("filter")


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley for docs(doc_id, text, source)
    and labels(doc_id, quality, toxic).

    Filters fail a text A: under 200 words; B: with under half of its words distinct; C: with over 2 % of its characters in A-Z; D: with
    a sign of #$%&*|; E: which a smaller doc_id has too, anywhere in the table. A part is a value of source.

    Null and empty texts are one text, without words (A fails it, and E if it is not the first); null and empty sources are one part.
    A row without an id has no smaller one, nor is it one; rows that repeat id and text are all first or none. A document is good, or
    toxic, if any label of its id says so. Extra columns are not read. An empty table gives no rows.
    """
    return interactions(masks(docs, labels), "ABCDE")
