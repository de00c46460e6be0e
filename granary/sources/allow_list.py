"""The allow-list of sources: a YAML (where PyYAML is installed) or JSON list, checked as a whole."""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.functions.ids import derived_source
from granary.functions.validate import source_config_errors
from granary.schema import SOURCES


def parse(text: str) -> list[dict]:
    if not text.strip():
        return []
    try:
        return json.loads(text) or []
    except json.JSONDecodeError:
        try:
            import yaml
        except ImportError as e:
            raise RuntimeError("YAML allow-lists need PyYAML; JSON works without") from e
        return yaml.safe_load(text) or []


def load(spark: SparkSession, path: str) -> DataFrame:
    """The allow-list as a DataFrame with `name`; an empty file is an empty list, one bad row raises for all."""
    text = "\n".join(r.value for r in spark.read.text(path, wholetext=True).collect())  # a configuration file
    rows = []
    for item in parse(text):
        day = item.get("reviewed_at")
        try:
            day = dt.date.fromisoformat(day) if isinstance(day, str) else day
        except ValueError:
            day = None
        rps = item.get("rate_limit_rps")
        rows.append([item.get("domain"), item.get("added_by"), day, item.get("legal_basis"), float(rps) if isinstance(rps, (int, float)) else None, item.get("adapter"), item.get("api_available"), item.get("api_check_notes")])
    df = source_config_errors(spark.createDataFrame(rows, SOURCES))
    if bad := df.where(F.size("errors") > 0).select("domain", "errors").head(1):
        raise ValueError(f"bad source {bad[0].domain}: {bad[0].errors[0].field} {bad[0].errors[0].message}")
    return df.drop("errors").withColumn("name", F.regexp_extract("adapter", r"([a-z][a-z0-9_]*)\.py$", 1))


def lookup(sources: DataFrame, name: str):
    found = sources.where(F.col("name") == name).head(1)
    if not found:
        raise ValueError(f"source {name!r} not found in the allow-list")
    return found[0]


def configured(urls: DataFrame, configs: DataFrame) -> DataFrame:
    """urls(url, ...) with the rate_limit_rps, legal_basis and adapter of their host's entry; `listed` is false where there is none. A
    www. before the host does not count. Raises, when it runs, on a domain with two entries."""
    one = configs.groupBy("domain").agg(F.count("*").alias("_n"), F.first(F.struct("rate_limit_rps", "legal_basis", "adapter")).alias("_c"))
    one = one.withColumn("_c", F.when(F.col("_n") > 1, F.raise_error(F.concat(F.lit("listed twice: "), F.col("domain"))).cast("struct<rate_limit_rps:double,legal_basis:string,adapter:string>")).otherwise(F.col("_c")))
    joined = urls.withColumn("_host", derived_source(F.col("url"))).join(one.select(F.col("domain").alias("_host"), "_c"), "_host", "left")
    return joined.select(*urls.columns, "_c.rate_limit_rps", "_c.legal_basis", "_c.adapter", F.col("_c").isNotNull().alias("listed"))
