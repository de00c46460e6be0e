"""Running values over rows in order, where one key may hold most rows.

A window over a key is one task. Here each key's rows are dealt to blocks that are runs in the order, of about `rows` rows each; a block
is worked out by itself, what it hands on is brought together (one row a block), and its sum or maximum over earlier blocks is what a
row of the block starts from. Whatever has such a carry can run so: sums, counts, maxima, and schedules, which are maxima in disguise.

Blocks are cut by Spark's range partitioning, whose borders are quantiles of a sample, and written before they are used, so that they
stay what they are when a task is run again. A log in which no key has more than `rows` rows is one block a key and is not written.
"""

from __future__ import annotations

import atexit
import math
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import window as W

ROWS = 100_000
BLOCK = "_block"


def shared_root(spark: SparkSession) -> str:
    """The folder that the cluster shares; one of our own only where none is set and all runs on this machine, as in tests."""
    if not (root := spark.conf.get("spark.checkpoint.dir", None)):
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        spark.conf.set("spark.checkpoint.dir", root := "file://" + tempfile.mkdtemp(prefix="granary-"))
        atexit.register(remove, spark, root)
    return root.rstrip("/")


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a scratch path; at exit the JVM may be gone already."""
    try:
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    except Exception:  # noqa: BLE001  the session has ended
        pass


class Written:
    """Tables in the shared folder for as long as the `with` lasts, or until the driver ends."""

    def __init__(self, spark: SparkSession):
        self.spark, self.root, self.n = spark, f"{shared_root(spark)}/granary-records/{uuid.uuid4().hex}", 0
        atexit.register(remove, spark, self.root)

    def save(self, df: DataFrame) -> DataFrame:
        self.n += 1
        path = f"{self.root}/{self.n}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def __enter__(self) -> Written:
        return self

    def __exit__(self, *_) -> None:
        remove(self.spark, self.root)


def blocks(df: DataFrame, by: list[str], order: list[str], rows: int = ROWS, written: Written | None = None) -> DataFrame:
    """df with BLOCK, which rises with the order in each key; rows that tie in it share a block."""
    most = df.groupBy(*by).count().agg(F.max("count").alias("most"), F.sum("count").alias("n")).first()
    if (most["most"] or 0) <= rows:
        return df.withColumn(BLOCK, F.lit(0))
    ranged = df.repartitionByRange(math.ceil(most["n"] / rows), *by, *order).withColumn(BLOCK, F.spark_partition_id())
    return (written or Written(df.sparkSession)).save(ranged)


def inside(by: list[str], *order: str | Column) -> W.WindowSpec:
    """A key's rows in a block, in order."""
    return W.Window.partitionBy(*by, BLOCK).orderBy(*order)


def carried(blocked: DataFrame, by: list[str], **parts: Column) -> DataFrame:
    """A row for each key and block: for each aggregate, `name` over the block's rows and `name_before`, the sum over earlier blocks."""
    own = blocked.groupBy(*by, BLOCK).agg(*[c.alias(name) for name, c in parts.items()])
    earlier = before(by)
    return own.withColumns({f"{name}_before": F.coalesce(F.sum(name).over(earlier), F.lit(0)) for name in parts})


def before(by: list[str]) -> W.WindowSpec:
    """The earlier blocks of a key: one row a block."""
    return W.Window.partitionBy(*by).orderBy(BLOCK).rowsBetween(W.Window.unboundedPreceding, -1)


def joined(blocked: DataFrame, carry: DataFrame, by: list[str]) -> DataFrame:
    """Rows with what their block starts from; null keys are keys like any other."""
    on = [*by, BLOCK]
    names = {c: f"_of_{c}" for c in on}
    right = carry.withColumnsRenamed(names)
    same = [blocked[c].eqNullSafe(right[names[c]]) for c in on]
    cond = same[0]
    for s in same[1:]:
        cond = cond & s
    return blocked.join(right, cond).drop(*names.values())
