"""Local files: pages, traces, test fixtures, seed lists."""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.functions.text import one_trailing_newline, sha256
from granary.schema import SPANS


def pages(spark: SparkSession, path: str) -> DataFrame:
    """path, raw of each file below a path."""
    return spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), F.col("value").alias("raw"))


def traces(spark: SparkSession, path: str) -> DataFrame:
    """Spans of JSON-lines files; blank lines are none."""
    return spark.read.schema(SPANS).json(path).where("span_id is not null")


def spans_of_batch(spans: DataFrame, batch_id: str) -> DataFrame:
    return spans.where(F.col("attrs")["batch_id"] == batch_id)


def append_spans(spans: DataFrame, path: str) -> None:
    """Appends spans as JSON lines, a folder a day."""
    spans.withColumn("day", F.date_format(F.timestamp_seconds("started"), "yyyyMMdd")).write.mode("append").partitionBy("day").json(path)


class Tracer:
    """Spans of a driver's work: span() opens one below that which is open, measures it and notes how it ended; when the
    outermost ends, all are appended to the trace files."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.open, self.ended = spark, path, [], []

    @contextmanager
    def span(self, name: str, **attrs) -> Iterator[dict]:
        """attrs, to which the caller may add; values are written as text."""
        ident, began, mark = uuid.uuid4().hex, time.time(), time.monotonic()
        parent, status, fault = self.open[-1] if self.open else None, "ok", None
        self.open.append(ident)
        try:
            yield attrs
        except BaseException as e:
            status, fault = "error", repr(e)
            raise
        finally:
            self.open.pop()
            self.ended.append((ident, parent, name, began, {k: str(v) for k, v in attrs.items()}, status, fault, int((time.monotonic() - mark) * 1000)))
            if not self.open:
                rows, self.ended = self.ended, []
                append_spans(self.spark.createDataFrame(rows, SPANS).coalesce(1), self.path)


def children(spans: DataFrame) -> DataFrame:
    """root, child pairs by parent id."""
    root = spans.where("parent_id is null").select(F.col("span_id").alias("root_id"), F.col("name").alias("root_name"))
    return spans.where("parent_id is not null").join(root, F.col("parent_id") == F.col("root_id"))


def fixtures(spark: SparkSession, path: str) -> DataFrame:
    """stem, expected, input: each *.expected.json with the first of .html, .md, .captured.md of its stem."""
    every = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", F.col("content").cast("string").alias("body"))
    ending = F.regexp_extract("path", r"(\.expected\.json|\.captured\.md|\.html|\.md)$", 1)
    named = every.withColumn("ending", ending).where("ending != ''").withColumn("stem", F.expr("substring(path, 1, length(path) - length(ending))"))
    order = F.when(F.col("ending") == ".html", 0).when(F.col("ending") == ".md", 1).otherwise(2)
    inputs = named.where("ending != '.expected.json'").groupBy("stem").agg(F.min_by("body", order).alias("input"))
    return named.where("ending = '.expected.json'").select("stem", F.col("body").alias("expected")).join(inputs, "stem")


def changed_captures(captures: DataFrame, known: DataFrame) -> DataFrame:
    """captures(id, body) that differ from known(id, content_hash): normalized to one trailing newline, with their hash."""
    new = captures.withColumn("body", one_trailing_newline(F.col("body"))).withColumn("content_hash", F.concat(F.lit("sha256:"), sha256(F.col("body"))))
    return new.join(known.select("id", "content_hash"), ["id", "content_hash"], "left_anti")


def write_seeds(urls: DataFrame, path: str) -> None:
    """Sorted, one a line, in one file: a seed list is short."""
    urls.select("url").coalesce(1).sortWithinPartitions("url").write.mode("overwrite").text(path)


def discovered(links: DataFrame, known: DataFrame, keep: Column) -> DataFrame:
    """One row: total, matching, new links."""
    seen = links.join(known.select("url").distinct().withColumn("_known", F.lit(True)), "url", "left")
    return seen.agg(F.count("*").alias("total"), F.count_if(keep).alias("matching"), F.count_if(keep & F.col("_known").isNull()).alias("new"))
