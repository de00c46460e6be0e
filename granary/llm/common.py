"""What the corpus operators share: scratch tables, batch sizes, word hashing."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word, as the operators' contracts have it: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: Rows that one Arrow batch holds at most, so that a batch of long texts stays small.
BATCH_ROWS = 256


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def small_batches(spark: SparkSession) -> None:
    """Bounds the Arrow batches that Python workers get (a runtime setting of the session)."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def scratch_root(spark: SparkSession) -> str:
    """The cluster's shared folder; one of our own only where none is set and all runs on this machine, as in tests."""
    if not (root := spark.conf.get("spark.checkpoint.dir", None)):
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        spark.conf.set("spark.checkpoint.dir", root := "file://" + tempfile.mkdtemp(prefix="granary-"))
        atexit.register(_remove, spark, root)
    return root.rstrip("/")


def _remove(spark: SparkSession, path: str) -> None:
    """Deletes a scratch path; at exit the JVM may be gone already."""
    try:
        jvm = spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    except Exception:  # noqa: BLE001  the session has ended
        pass


class Scratch:
    """Tables in the shared folder. save() writes a DataFrame once as Parquet and reads it again, which cuts
    the lineage and survives the loss of executors; drop() deletes tables that nothing reads any more. What
    is left goes when the driver ends."""

    def __init__(self, spark: SparkSession):
        self.spark, self.root = spark, f"{scratch_root(spark)}/granary/{uuid.uuid4().hex}"
        self.paths: dict[str, str] = {}
        atexit.register(_remove, spark, self.root)

    def save(self, df: DataFrame, name: str) -> DataFrame:
        self.paths[name] = path = f"{self.root}/{name}-{len(self.paths)}-{uuid.uuid4().hex[:8]}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        for name in names:
            if path := self.paths.pop(name, None):
                _remove(self.spark, path)


def by_position(df: DataFrame, *wanted: str) -> tuple[DataFrame, list[str]]:
    """df with its columns called c0, c1 and so on, and what the wanted ones are called then: whatever names a caller's columns have,
    with dots, in other cases or twice, no expression meets them."""
    low = [c.lower() for c in df.columns]
    at = [df.columns.index(c) if c in df.columns else low.index(c.lower()) for c in wanted]
    return df.toDF(*[f"c{i}" for i in range(len(low))]), [f"c{i}" for i in at]


def unused(df: DataFrame, name: str) -> str:
    """A column name that df has not, in any case."""
    have = {c.lower() for c in df.columns}
    while name.lower() in have:
        name = "_" + name
    return name


def texts(batch, column: int = 1) -> Iterator[bytes]:
    """The UTF-8 bytes of a batch's texts, null as empty, without making Python strings."""
    import pyarrow as pa

    for x in batch.column(column).cast(pa.large_binary()).to_pylist():
        yield x or b""


def text_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a column's texts, one after another, and where each begins and the last ends; null is empty."""
    import pyarrow as pa

    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_binary())
    edges = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, 8 * column.offset) if len(column) else np.zeros(1, np.int64)
    data = column.buffers()[2]
    values = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return values[edges[0] : edges[-1]], edges - edges[0]


def gathered(batches: Iterator, size: int) -> Iterator:
    """The batches brought together until they have about `size` bytes."""
    import pyarrow as pa

    def whole(held):
        return held[0] if len(held) == 1 else pa.concat_batches(held)

    held, n = [], 0
    for batch in batches:
        if held and n + batch.nbytes > size:
            yield whole(held)
            held, n = [], 0
        held.append(batch)
        n += batch.nbytes
    if held:
        yield whole(held)


_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer (splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= _M1
    x ^= x >> np.uint64(27)
    x *= _M2
    x ^= x >> np.uint64(31)
    return x


_BYTES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_P = 0x9E3779B97F4A7C15 | 1
_P_INV = pow(_P, -1, 1 << 64)
_POWERS: dict[str, np.ndarray] = {}


def _powers(name: str, base: int, n: int) -> np.ndarray:
    have = _POWERS.get(name)
    if have is None or len(have) < n:
        _POWERS[name] = have = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(max(n, 1 << 16), base, np.uint64)]), dtype=np.uint64)
    return have[:n]


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Texts are hashed in pieces of at most so many bytes, cut at white space where there is any.
PIECE = 1 << 20


def span_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each of the spans raw[start:end], in a fixed number of passes over raw."""
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_BYTES[raw] * _powers("p", _P, len(raw)), out=sums[1:])
    return mix((sums[ends] - sums[starts]) * _powers("inv", _P_INV, len(raw) + 1)[starts] + (ends - starts).astype(np.uint64))


def word_spans(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.diff(_SPACE[raw].astype(np.int8), prepend=1, append=1)
    return np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)


def _word_hashes(raw: np.ndarray) -> np.ndarray:
    return span_hashes(raw, *word_spans(raw))


def word_hashes(text: bytes) -> np.ndarray:
    """A 64-bit hash of each word of a text, in order; equal words have equal hashes."""
    if len(text) <= PIECE:
        return _word_hashes(np.frombuffer(text, np.uint8))
    out, at = [], 0
    while at < len(text):
        end = min(len(text), at + PIECE)
        while end < len(text) and not _SPACE[text[end]]:  # a word is never cut
            end += 1
        out.append(_word_hashes(np.frombuffer(text, np.uint8, end - at, at)))
        at = end
    return np.concatenate(out)


def shingle_hashes(words: np.ndarray, size: int = 5) -> np.ndarray:
    """The hashes of all runs of `size` words; a shorter text is one shingle, an empty one none."""
    if not len(words):
        return words
    size = min(size, len(words))
    n = len(words) - size + 1
    out = np.full(n, np.uint64(size))
    for k in range(size):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + words[k : k + n])
    return out
