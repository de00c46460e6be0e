"""From what a fetch returned to payloads: API answers are mapped to records, text fields are sanitized."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.functions import html, text
from granary.schema import SANITIZED
from granary.sources.adapters import Adapter
from granary.sources.listing import next_slot


def sanitized(answers: DataFrame, payload: str = "payload") -> DataFrame:
    """answers with the text fields of their payloads (JSON objects) sanitized. What is no string, or no object, stays as it is."""
    doc = F.try_parse_json(payload)
    out = answers
    for f in SANITIZED:
        v = F.try_variant_get(doc, f"$.{f}", "variant")
        out = out.withColumn(f"_{f}", F.when(F.schema_of_variant(v) == "STRING", F.try_variant_get(doc, f"$.{f}", "string")))
    out = out.withColumns({f"_{f}": html.normalized_visible(F.col(f"_{f}"))["text"] for f in SANITIZED})
    clean = F.from_json(F.to_json(F.struct(*[text.sanitize(F.col(f"_{f}"))["text"].alias(f) for f in SANITIZED])), "map<string,variant>")
    whole = F.from_json(F.when(F.schema_of_variant(doc).startswith("OBJECT"), F.col(payload)), "map<string,variant>")
    merged = F.map_concat(F.map_filter(whole, lambda k, v: ~F.array_contains(F.map_keys(clean), k)), clean)
    return out.withColumn(payload, F.coalesce(F.to_json(merged), F.col(payload))).drop(*[f"_{f}" for f in SANITIZED])


#: Errors of how a fetch is set up: trying again, or another URL, does not help.
CONFIGURATION = ("KeyError", "ImportError", "AttributeError", "ModuleNotFoundError")


def transient(ok: Column, error: Column) -> Column:
    """ok, where the error (a class's name, or null) is one that may pass; raises, when it runs, on one of configuration."""
    return F.when(error.isin(*CONFIGURATION), F.raise_error(F.concat(F.lit("configuration error: "), error)).cast("boolean")).otherwise(F.coalesce(ok, F.lit(False)) & error.isNull())


def fetched(urls: DataFrame, get: Callable[[str], str], rps: float, tasks: int = 4) -> DataFrame:
    """url, body, ok, error (its class) of a call for each of urls(url), which start at least 1 / rps seconds apart: each task has
    slots of its own on one clock."""
    if rps <= 0:
        raise ValueError("rps must be positive")
    clock = time.time()

    def call(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task = TaskContext.get().partitionId()
        for batch in batches:
            rows = []
            for url in batch["url"]:
                time.sleep(max(0.0, next_slot(task, tasks, clock, rps, time.time()) - time.time()))
                try:
                    rows.append((url, get(url), True, None))
                except Exception as e:  # noqa: BLE001  told apart by whoever reads the answers
                    rows.append((url, None, False, type(e).__name__))
                time.sleep(1e-3)  # out of the slot that is used up
            yield pd.DataFrame(rows, columns=["url", "body", "ok", "error"])

    return urls.select("url").repartition(tasks, "url").mapInPandas(call, "url string, body string, ok boolean, error string")


REQUIRED = ("source", "source_id", "source_url")


def has_required(payload: Column) -> Column:
    """Whether a payload is a JSON object with all keys that name its record."""
    doc = F.try_parse_json(payload)
    there = F.map_keys(F.from_json(F.when(F.schema_of_variant(doc).startswith("OBJECT"), payload), "map<string,variant>"))
    return F.coalesce(F.forall(F.array(*map(F.lit, REQUIRED)), lambda k: F.array_contains(there, k)), F.lit(False))


def api_payloads(answers: DataFrame, adapter: Adapter) -> DataFrame:
    """url, payload, ok of an API's answers(url, body, ok): a body that is no JSON object, a payload without the keys that name its
    record, or a source without a mapping, is an error."""
    if adapter.response is None:
        raise ValueError(f"source {adapter.name!r} has no response mapping")
    doc = F.try_parse_json("body")
    good = F.coalesce(F.col("ok") & F.schema_of_variant(doc).startswith("OBJECT"), F.lit(False))
    mapped = answers.select("url", F.when(good, adapter.response(doc, F.col("url"))).alias("payload")).withColumn("ok", has_required(F.col("payload")))
    return sanitized(mapped.withColumn("payload", F.when(F.col("ok"), F.col("payload"))))
