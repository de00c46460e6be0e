"""The record store: append-only raw log, latest valid versions, field changes and the failure queue.

All functions take and return DataFrames. Tables are partitioned Parquet (Store): logs grow by a partition a batch, and of the latest
versions a batch overwrites the partitions that it touches.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from urllib.parse import quote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import window as W

from granary.functions.text import canonical_json, sha256
from granary.operators import scan
from granary.schema import RESOLUTIONS, TABLES

KEY = ["source", "source_id"]


def dense_ids(df: DataFrame, order: str, start: int = 0, name: str = "id", ties: tuple[str, ...] = (), rows: int = scan.ROWS, written: scan.Written | None = None) -> DataFrame:
    """Numbers rows from start + 1 in the order of a column, and of others where it ties, without one task for all rows: ranges
    that a sample's quantiles cut, so that outliers do not fill one of them, are numbered by themselves, after the counts of earlier ones."""
    keyed = df.withColumn("_all", F.lit(0))
    own = scan.blocks(keyed, ["_all"], [order, *ties], rows, written)
    carry = scan.carried(own, ["_all"], n=F.count("*")).select("_all", scan.BLOCK, "n_before")
    own = own.withColumn("_at", F.row_number().over(scan.inside(["_all"], order, *ties)))
    return scan.joined(own, carry, ["_all"]).withColumn(name, (F.lit(start) + F.col("n_before") + F.col("_at")).cast("long")).select(*df.columns, name)


def record_attempts(fetched: DataFrame, last_id: int, now: Column, trace_id: str) -> DataFrame:
    """Rows of raw_content for fetched(seq, source, source_id, url, payload): every payload, also those that are invalid later."""
    return raw_rows(dense_ids(fetched, "seq", last_id), now, trace_id)


def raw_rows(numbered: DataFrame, now: Column, trace_id: str) -> DataFrame:
    body = canonical_json(F.col("payload"))
    rows = numbered.withColumns({"raw_payload": body, "content_hash": sha256(body), "scraped_at": now, "trace_id": F.lit(trace_id)})
    return rows.select("id", *KEY, "url", "content_hash", "raw_payload", "scraped_at", "trace_id")


def latest(versions: DataFrame, order: str, key: list[str] = KEY) -> DataFrame:
    """The row of each key with the greatest order. Aggregates before the shuffle, so that a hot key costs no more."""
    rest = [c for c in versions.columns if c not in key]
    return versions.groupBy(*key).agg(F.max_by(F.struct(*rest), order).alias("_row")).select(*key, "_row.*").select(*versions.columns)


def upsert(canonical: DataFrame, new: DataFrame) -> DataFrame:
    """canonical_records with new versions (same columns): per key the one with the greatest raw_id."""
    return latest(canonical.unionByName(new), "raw_id")


def field_values(payload: Column) -> Column:
    """map field -> JSON text of a payload. JSON types stay apart; 1 and 1.0 are equal."""
    return F.transform_values(F.from_json(payload, "map<string,variant>"), lambda k, v: F.coalesce(F.to_json(v), F.lit("null")))


def changes(canonical: DataFrame, new: DataFrame, now: Column) -> DataFrame:
    """source, source_id, raw_id, field, old_value, new_value, changed_at of each field that differs between a key's successive
    versions. The first version of a key writes nothing; a missing field equals null."""
    versions = canonical.select(*KEY, "raw_id", "payload").unionByName(new.select(*KEY, "raw_id", "payload"))
    fresh = new.select(*KEY).distinct().withColumn("_new", F.lit(True))
    versions = versions.join(fresh, KEY, "left_semi").withColumn("fields", field_values(F.col("payload")))
    return successive_changes(versions, "raw_id", now)


def successive_changes(versions: DataFrame, order: str, now: Column, key: list[str] = KEY) -> DataFrame:
    """The same over any versions(key..., order, fields map)."""
    paired = versions.withColumn("_old", F.lag("fields").over(W.Window.partitionBy(*key).orderBy(order))).where(F.col("_old").isNotNull())
    names = F.array_union(F.map_keys("_old"), F.map_keys("fields"))
    value = lambda m, k: F.coalesce(F.element_at(m, k), F.lit("null"))
    diffs = F.filter(F.transform(names, lambda k: F.struct(k.alias("field"), value(F.col("_old"), k).alias("old_value"), value(F.col("fields"), k).alias("new_value"))), lambda d: d["old_value"] != d["new_value"])
    return paired.select(*key, order, F.explode(diffs).alias("d")).select(*key, order, "d.field", "d.old_value", "d.new_value", now.alias("changed_at"))


def failures(validated: DataFrame, now: Column) -> DataFrame:
    """Rows for the failure queue of validated(source, url, raw_id, errors): without ids."""
    text = F.array_join(F.transform("errors", lambda e: F.concat_ws(": ", e["field"], e["message"])), "; ")
    return validated.where(F.size("errors") > 0).select("source", "url", "raw_id", text.alias("error"), now.alias("detected_at"), F.lit(None).cast("timestamp").alias("resolved_at"), F.lit(None).cast("string").alias("resolution"))


def resolve(failed: DataFrame, resolutions: DataFrame, now: Column) -> DataFrame:
    """failed with resolutions(id, resolution) applied. Raises, when it runs, on an unknown resolution, an unknown id, and
    one that is resolved already or twice, in that order."""
    r = resolutions.groupBy("id").agg(F.min("resolution").alias("_to"), F.count("*").alias("_n"), F.bool_and(F.coalesce(F.col("resolution").isin(*RESOLUTIONS), F.lit(False))).alias("_known"))
    both = failed.withColumn("_there", F.lit(True)).join(r, "id", "full_outer")
    asked = F.col("_n").isNotNull()
    fault = (
        F.when(asked & ~F.col("_known"), F.concat(F.lit("resolution must be one of "), F.lit(", ".join(sorted(RESOLUTIONS)))))
        .when(asked & F.col("_there").isNull(), F.concat(F.lit("validation failure "), F.col("id").cast("string"), F.lit(" not found")))
        .when(asked & (F.col("resolved_at").isNotNull() | (F.col("_n") > 1)), F.concat(F.lit("validation failure "), F.col("id").cast("string"), F.lit(" already resolved")))
    )
    checked = F.when(fault.isNotNull(), F.raise_error(fault).cast("timestamp")).when(asked, now).otherwise(F.col("resolved_at"))
    return both.withColumn("resolved_at", checked).withColumn("resolution", F.coalesce("resolution", "_to")).select(*failed.columns)


def last_scraped(canonical: DataFrame, raw: DataFrame) -> DataFrame:
    """source, source_id, scraped_at: when the current version of each record was fetched."""
    return canonical.select(*KEY, "raw_id").join(raw.select(F.col("id").alias("raw_id"), "scraped_at"), "raw_id").select(*KEY, "scraped_at")


def freshness(candidates: DataFrame, scraped: DataFrame, now: Column, max_age_days: int = 7, force: bool = False) -> DataFrame:
    """candidates with scraped_at, age_days and is_fresh: fetched at most max_age_days ago."""
    age = (F.unix_micros(now) - F.unix_micros(F.col("scraped_at"))) / 86_400_000_000
    fresh = F.lit(False) if force else F.coalesce(age <= max_age_days, F.lit(False))
    return candidates.join(scraped, KEY, "left").withColumns({"age_days": age, "is_fresh": fresh})


def rename_keys(canonical: DataFrame, names: DataFrame) -> DataFrame:
    """canonical with source_ids replaced by names(source, source_id, new_id). Raises, when it runs, if two records get one key."""
    out = canonical.join(names, KEY, "left").withColumn("source_id", F.coalesce("new_id", "source_id")).drop("new_id")
    twice = F.count("*").over(W.Window.partitionBy(*KEY))
    return out.withColumn("_n", twice).withColumn("url", F.when(F.col("_n") > 1, F.raise_error(F.concat(F.lit("key taken: "), F.col("source_id"))).cast("string")).otherwise(F.col("url"))).select(*canonical.columns)


def unseen(candidates: DataFrame, known: DataFrame, on: list[str]) -> DataFrame:
    """Candidates that are not known; duplicates among them stay."""
    return candidates.join(known.select(*on), on, "left_anti")


def commit(store: Store, checked: DataFrame, now: Column, trace_id: str) -> None:
    """Writes what was fetched, checked(seq, source, source_id, url, payload, errors, record_json): all to the raw log, then
    the invalid to the failure queue, then the valid ones' changes, then their versions, so that a crash leaves an audited
    prefix. Each write is made once for a trace id: the same call again does what is left. seq is unique. checked is worked out once."""
    store.recover()
    with scan.Written(store.spark) as scratch:
        again = store.has("raw_content", trace_id)
        last = store.batch("raw_content", trace_id).agg(F.min("id") - 1).first()[0] if again else store.last_id("raw_content")
        asked = checked.select("seq", *KEY, "url", "payload", "errors", "record_json", now.cast("timestamp").alias("_now"))
        rows = scratch.save(dense_ids(asked, "seq", last or 0, written=scratch))
        if not again:
            store.append("raw_content", raw_rows(rows, F.col("_now"), trace_id), trace_id, (last or 0) + rows.count())
        rows = rows.withColumnRenamed("id", "raw_id")
        if not store.has("validation_failed", trace_id):
            last = store.last_id("validation_failed")
            failed = scratch.save(dense_ids(failures(rows, F.col("_now")), "raw_id", last, written=scratch).select(*TABLES["validation_failed"].names))
            store.append("validation_failed", failed, trace_id, last + failed.count())
        valid = rows.where(F.size("errors") == 0)
        new = valid.select(*KEY, "url", F.col("record_json").alias("payload"), F.col("_now").alias("valid_from"), "raw_id")
        old = store.touched(new)
        if not store.has("change_history", trace_id):
            last = store.last_id("change_history")
            at = valid.select("raw_id", F.col("_now").alias("_changed"))
            diff = changes(old.select(*new.columns), new, F.lit(None).cast("timestamp")).join(at, "raw_id").withColumn("changed_at", F.col("_changed"))
            diff = scratch.save(dense_ids(diff, "raw_id", last, ties=("field",), written=scratch).select(*TABLES["change_history"].names))
            store.append("change_history", diff, trace_id, last + diff.count())
        merged = upsert(old.select(*new.columns), new)
        store.overwrite("canonical_records", merged.withColumn("part", store.part()), ["part"])


class Store:
    """Tables of Parquet files below a root path, with a folder a partition.

    The logs (raw_content, validation_failed, change_history) have a partition for each batch, named by its label and by the greatest
    id up to it: a batch is written aside and appears by one rename, so that it is there whole or not at all, once for its label.
    canonical_records has a partition for each of `parts` hashes of the key: a batch reads and overwrites those that it touches. What
    overwrites is first written aside whole, and recover() repeats what a crash has cut short. One writer at a time; a reader that
    meets a partition being overwritten reads again. `parts` stays as it is for the life of a root."""

    LOGS = ("raw_content", "validation_failed", "change_history")
    BATCH = ["upto", "batch"]

    def __init__(self, spark: SparkSession, root: str, parts: int = 64):
        self.spark, self.root, self.parts = spark, root.rstrip("/"), parts
        self.fs = spark._jvm.org.apache.hadoop.fs.Path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, *parts: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.root, *parts]))

    def migrate(self) -> None:
        """Creates the tables that are not there; running it again changes nothing."""
        for name in TABLES:
            self.fs.mkdirs(self._path(name))

    def part(self) -> Column:
        """The partition of a record's key."""
        return F.pmod(F.xxhash64(*KEY), F.lit(self.parts)).cast("int")

    def partitioned(self, name: str) -> DataFrame:
        """A table with its partition columns, which filters prune by."""
        if not self.fs.exists(self._path(name)):
            raise FileNotFoundError(f"no table {name} below {self.root}: run migrate() first")
        schema = T.StructType([*TABLES[name].fields])
        schema = schema.add("upto", T.LongType()).add("batch", T.StringType()) if name in self.LOGS else schema.add("part", T.IntegerType())
        return self.spark.read.schema(schema).parquet(f"{self.root}/{name}")

    def read(self, name: str) -> DataFrame:
        return self.partitioned(name).select(*TABLES[name].names)

    def batch(self, name: str, label: str) -> DataFrame:
        return self.partitioned(name).where(F.col("batch") == label).select(*TABLES[name].names)

    def touched(self, new: DataFrame) -> DataFrame:
        """canonical_records' partitions, with their numbers, that the keys of `new` fall in."""
        parts = [r["part"] for r in new.select(self.part().alias("part")).distinct().collect()]  # at most `parts` numbers
        return self.partitioned("canonical_records").where(F.col("part").isin(parts))

    def _batches(self, name: str, pattern: str = "*") -> list[tuple[int, str]]:
        """(greatest id, label as it is in the path) of a log's batches."""
        found = self.fs.globStatus(self._path(name, "upto=*", f"batch={pattern}"))
        paths = [x.getPath() for x in found or []]
        return [(int(p.getParent().getName()[5:]), p.getName()[6:]) for p in paths]

    def has(self, name: str, label: str) -> bool:
        """Whether a log has the batch of that label."""
        return bool(self._batches(name, quote(label, safe="")))

    def last_id(self, name: str) -> int:
        """The greatest id of a log, from the names of its partitions alone."""
        return max((upto for upto, _ in self._batches(name)), default=0)

    def _write(self, name: str, df: DataFrame, by: list[str] | None = None) -> str:
        """Writes rows aside."""
        folder = f"pending/{name}-{uuid.uuid4().hex}"
        (df.repartition(*by).write.partitionBy(*by) if by else df.write).parquet(f"{self.root}/{folder}")
        return folder

    def _publish(self, name: str, folder: str, target: str | None) -> None:
        """Makes what was written aside a new partition, by one rename, or puts it in the place of the partitions that it has."""
        if target:
            self.fs.mkdirs(self._path(name, target).getParent())
            if self.fs.exists(self._path(name, target)) or not self.fs.rename(self._path(folder), self._path(name, target)):
                raise RuntimeError(f"{name}: another writer was faster")
            return
        aside = self.spark.read.schema(self.partitioned(name).schema).parquet(f"{self.root}/{folder}")
        by = self.BATCH if name in self.LOGS else ["part"]
        aside.repartition(*by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(f"{self.root}/{name}")
        self.fs.delete(self._path(folder), True)

    def append(self, name: str, df: DataFrame, label: str, upto: int) -> None:
        """Adds a batch to a log; its ids go up to `upto`."""
        self._publish(name, self._write(name, df), f"upto={upto}/batch={quote(label, safe='')}")

    def overwrite(self, name: str, df: DataFrame, by: list[str]) -> None:
        """Puts df, with its partition columns, in the place of the partitions that it has rows of."""
        self._publish(name, self._write(name, df, by), None)

    def holding(self, name: str, id: int) -> DataFrame:
        """The partition of a log that would hold an id, with its partition columns."""
        first = min((upto for upto, _ in self._batches(name) if upto >= id), default=-1)
        return self.partitioned(name).where(F.col("upto") == first)

    def recover(self) -> None:
        """Repeats the overwriting that a crash has cut short, and deletes what was only half written aside."""
        if not self.fs.exists(self._path("pending")):
            return
        for status in self.fs.listStatus(self._path("pending")):
            folder = f"pending/{status.getPath().getName()}"
            name = status.getPath().getName().rpartition("-")[0]
            partitions = self.fs.globStatus(self._path(folder, "*=*"))
            if self.fs.exists(self._path(folder, "_SUCCESS")) and partitions:
                self._publish(name, folder, None)
            else:
                self.fs.delete(status.getPath(), True)


#: What a query that only reads is parsed into.
READING = set(
    "Aggregate Distinct Except Filter Generate GlobalLimit Intersect Join LateralJoin LocalLimit LocalRelation Offset OneRowRelation Pivot Project Range Sample Sort SubqueryAlias "
    "Subquery Tail Union UnresolvedHaving UnresolvedInlineTable UnresolvedOrderedTable UnresolvedRelation UnresolvedSubqueryColumnAliases UnresolvedTableValuedFunction UnresolvedWith "
    "Unpivot View Window WithWindowDefinition WithCTE CTERelationDef CTERelationRef".split()
)
#: Functions that call any method of the JVM.
REFLECTING = {"reflect", "java_method", "try_reflect"}
#: Expressions of an analyzed plan that run code from outside Spark: reflection, and functions that users register.
FOREIGN = ("CallMethodViaReflection", "ScalaUDF", "PythonUDF", "PythonUDAF", "PythonUDTF", "ScalaUDAF", "ScalaAggregator", "HiveSimpleUDF", "HiveGenericUDF", "HiveUDAFFunction", "HiveGenericUDTF")


def _nodes(tree, path: str = "plan") -> Iterator[tuple[dict, str, str]]:
    """(node, short class name, class path) of a plan's JSON, expressions and nested plans included."""
    if isinstance(tree, list):
        for x in tree:
            yield from _nodes(x, path)
    elif isinstance(tree, dict):
        if name := tree.get("class", ""):
            yield tree, name.rpartition(".")[2], "plan" if path == "plan" and ".analysis." in name else name
        for x in tree.values():
            yield from _nodes(x, "inner")


def read_only_sql(spark: SparkSession, query: str, rows: int = 50) -> DataFrame:
    """The first rows of a query over tables and views, made of reading operators alone: anything else is refused before it runs.

    The parsed plan may hold reading operators alone, and each relation of two or more names must be a table or view of the catalog,
    which files named by a format and a path are not. The analyzed plan, in which all names are resolved, may hold no expression
    that runs code from outside Spark; what a name or a literal is called does not matter."""

    def refuse(what: str) -> None:
        raise PermissionError(f"only queries are allowed, not {what}")

    parsed = spark._jsparkSession.sessionState().sqlParser().parsePlan(query)
    for node, short, name in _nodes([json.loads(parsed.toJSON())]):
        if (name == "plan" or ".plans.logical." in name or ".execution." in name) and short not in READING:
            refuse(short)
        if short == "UnresolvedRelation":
            parts = [x.strip() for x in str(node["multipartIdentifier"]).strip("[]").split(",")]
            if len(parts) > 1 and not spark.catalog.tableExists(".".join(f"`{x.replace('`', '``')}`" for x in parts)):
                refuse(f"{'.'.join(parts)}, which is no table or view")
        if short == "UnresolvedFunction" and {x.strip().lower() for x in str(node["nameParts"]).strip("[]").split(",")} & REFLECTING:
            refuse("a function that runs code")
    out = spark.sql(query)
    for _, short, _ in _nodes([json.loads(out._jdf.queryExecution().analyzed().toJSON())]):
        if short in FOREIGN:
            refuse("a function that runs code")
    return out.limit(rows)
