"""N-gram Jaccard join by chosen paths.

Texts are sets of word shingles; equal sets are one class, which its copies never leave. Each class is
embedded as `SIZE` MinHash values. A run starts at a root that samples coordinates of the embedding; classes
that agree in a sampled coordinate go to the same child. Small buckets are compared all against all by
their embeddings; large ones are split on further coordinates, and what is still large at the greatest depth
is compared block by block. Runs are repeated until a pair at the threshold is met with probability
`recall`.

What is met are candidates. Their connected components are then verified exactly, on the whole shingle sets,
again in blocks of bounded size, which count each class's links and give the final classes. Only one row
per member and block leaves a task, never one per pair.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.llm.common import Scratch, by_position, mix, shingle_hashes, small_batches, texts, word_hashes

SIZE, DEPTH, BUCKET = 64, 4, 1024
#: Members, and shingles, that a block of a component has on average at most.
BLOCK, BLOCK_SHINGLES = 1024, 400_000
#: An embedding agrees in this many standard errors less than the threshold at worst.
SLACK = 4.0
_A = mix(np.arange(1, SIZE + 1, dtype=np.uint64)) | np.uint64(1)
_B = mix(np.arange(1001, SIZE + 1001, dtype=np.uint64))


def runs_for(threshold: float, recall: float) -> int:
    """A node samples one coordinate, and one time in four a second. The probability that a pair stays together
    to the greatest depth follows level by level; independent runs make up for the rest."""
    q = 1.0
    for _ in range(DEPTH):
        miss = 1 - threshold * q
        q = 0.75 * (1 - miss) + 0.25 * (1 - miss * miss)
    return math.ceil(math.log(1 - recall) / math.log(1 - q))


def picks(nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The coordinates that each node samples: the first, the second, and whether it has a second."""
    h = mix(nodes)
    first, second = h % np.uint64(SIZE), (h >> np.uint64(16)) % np.uint64(SIZE)
    return first, second, ((h >> np.uint64(8)) % np.uint64(4) == 0) & (second != first)


def coordinates(node: int) -> list[int]:
    """The coordinates that a node samples."""
    first, second, both = picks(np.array([node & (2**64 - 1)], np.uint64))
    return [int(first[0])] + ([int(second[0])] if both[0] else [])


def shingle_set(text: bytes, size: int) -> np.ndarray:
    return np.unique(shingle_hashes(word_hashes(text), size))


def embed(shingles: np.ndarray) -> np.ndarray:
    out = np.full(SIZE, ~np.uint64(0))
    for k in range(0, len(shingles), 4096):
        h = shingles[None, k : k + 4096] * _A[:, None] + _B[:, None]
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        out = np.minimum(out, h.min(1))
    return out


def signatures(df: DataFrame, size: int, runs: int) -> DataFrame:
    """key, n shingles, set (a 128-bit hash), sketch (a byte of each coordinate), roots (a bucket for each run's coordinates)."""
    small_batches(df.sparkSession)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import xxhash

        nodes = [int(x) for x in mix(np.arange(1, runs + 1, dtype=np.uint64) * np.uint64(0x51_7C_C1_B7_27_22_0A_95))]
        picks = [(node, c) for node in nodes for c in coordinates(node)]
        salt, at = mix(np.array([n for n, _ in picks], np.uint64) + np.array([c for _, c in picks], np.uint64)), np.array([c for _, c in picks])
        for batch in batches:
            rows = []
            for text in texts(batch):
                s = shingle_set(text, size)
                if not len(s):
                    rows.append((0, b"", b"", []))
                    continue
                e = embed(s)
                rows.append((len(s), xxhash.xxh3_128_digest(s.tobytes()), (e & np.uint64(0xFF)).astype(np.uint8).tobytes(), mix(e[at] + salt).view(np.int64)))
            n, sets, sketches, roots = zip(*rows) if rows else ((), (), (), ())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int32()), pa.array(sets, pa.binary()), pa.array(sketches, pa.binary()), pa.array(list(roots), pa.list_(pa.int64()))], ["key", "n", "set", "sketch", "roots"])

    return df.select("_key", "_text").mapInArrow(run, "key long, n int, set binary, sketch binary, roots array<bigint>")


def streamed(df: DataFrame, by: str, schema: str, group: Callable) -> DataFrame:
    """Hands the rows of each value of `by` to group() together, as a pyarrow table, and yields the tables that it returns."""
    order = df.columns.index(by)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        held, value = [], None

        def flush() -> Iterator:
            if held and (out := group(pa.Table.from_batches(held))) is not None:
                yield from out.to_batches()

        for batch in batches:
            keys = batch.column(order).to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero(np.diff(keys)) + 1
            for a, b in zip([0, *cuts], [*cuts, len(keys)]):
                if a == b:
                    continue
                if keys[a] != value:
                    yield from flush()
                    held, value = [], keys[a]
                held.append(batch.slice(a, b - a))
        yield from flush()

    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, by).sortWithinPartitions(by).mapInArrow(run, schema)


def roots_of(n: int, pairs: np.ndarray) -> np.ndarray:
    """For each of n nodes the least node of its component."""
    root = np.arange(n)
    while True:
        low = root.copy()
        if len(pairs):
            np.minimum.at(low, pairs[:, 0], root[pairs[:, 1]])
            np.minimum.at(low, pairs[:, 1], root[pairs[:, 0]])
        low = low[low]
        if (low == root).all():
            return root
        root = low


def close_pairs(sketch: np.ndarray, n: np.ndarray, threshold: float) -> np.ndarray:
    """Pairs whose embeddings may be those of sets with that similarity, and whose sizes allow it."""
    least = SIZE * threshold - SLACK * math.sqrt(SIZE * threshold * (1 - threshold))
    out = []
    for a in range(0, len(sketch), 256):
        same = (sketch[a : a + 256, None, :] == sketch[None, a:, :]).sum(2)
        i, j = np.nonzero(same >= least)
        i, j = i + a, j + a
        keep = (i < j) & (np.minimum(n[i], n[j]) >= threshold * np.maximum(n[i], n[j]) - 1e-9)
        out.append(np.stack([i[keep], j[keep]], 1))
    return np.concatenate(out)


NODES = "bucket long, key long, n int, sketch binary, other long"


def compare(nodes: DataFrame, threshold: float, limit: int | None, scratch: Scratch) -> DataFrame:
    """Of each bucket the edges to the least key of each component (key, other); of those with more rows than the limit, the
    rows again, in their children's buckets. These rows split where they are: a hot bucket never meets in one task."""
    nodes = nodes.select("bucket", "key", "n", "sketch")

    def arrays(table):
        keys = table.column("key").to_numpy()
        sketch = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint8).reshape(len(keys), SIZE)
        return keys, table.column("n").to_numpy(), sketch

    def names(table):
        return ["bucket", "key", "n", "sketch", "other"]

    def group(table):
        import pyarrow as pa

        if len(table) < 2:
            return None
        keys, n, sketch = arrays(table)
        order = np.argsort(keys, kind="stable")
        keys, n, sketch = keys[order], n[order], sketch[order]
        root = roots_of(len(keys), close_pairs(sketch, n, threshold))
        at = np.flatnonzero(root != np.arange(len(keys)))
        if not len(at):
            return None
        none = lambda kind: pa.nulls(len(at), kind)
        return pa.Table.from_arrays([none(pa.int64()), pa.array(keys[at]), none(pa.int32()), none(pa.binary()), pa.array(keys[root[at]])], names(table))

    def split(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for table in batches:
            keys, _, sketch = arrays(table)
            bucket = table.column("bucket").to_numpy().view(np.uint64)
            first, second, both = picks(bucket)
            for c, some in ((first, slice(None)), (second, np.flatnonzero(both))):
                at, of = c[some], bucket[some]
                own = sketch[np.arange(len(keys))[some], at.astype(np.int64)]
                child = mix(own.astype(np.uint64) + np.uint64(1) + at * np.uint64(256) + mix(of)).view(np.int64)
                rows = table if isinstance(some, slice) else table.take(pa.array(some))
                yield pa.RecordBatch.from_arrays([pa.array(child), rows.column("key"), rows.column("n"), rows.column("sketch"), pa.nulls(len(child), pa.int64())], names(table))

    if limit is None:
        return streamed(nodes, "bucket", NODES, group)
    # one row for every `limit` nodes at most, written: its known size decides whether Spark broadcasts it
    hot = scratch.save(nodes.groupBy("bucket").count().where(F.col("count") > limit).select("bucket", F.lit(True).alias("hot")), "hot")
    marked = nodes.join(hot, "bucket", "left")
    small = streamed(marked.where("hot is null").drop("hot"), "bucket", NODES, group)
    return small.union(marked.where("hot").drop("hot").mapInArrow(split, NODES)) if not hot.isEmpty() else small


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """node, root (the least node of its component) of all nodes with an edge (a, b), by minimum labels and pointer jumping."""
    both = scratch.save(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "edges")
    labels = scratch.save(both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("root")), "labels")
    step = 0
    while True:
        near = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("root").alias("near"))
        less = labels.join(near, labels["node"] == near["a"]).select("node", "root", F.least("root", "near").alias("low"))
        less = scratch.save(less, f"low{step}")
        jump = less.select(F.col("node").alias("to"), F.col("low").alias("far"))
        new = less.join(jump, less["low"] == jump["to"], "left").select("node", F.least("low", F.coalesce("far", "low")).alias("root"), F.col("root").alias("old"))
        new = scratch.save(new, f"labels{step}")
        scratch.drop("labels", f"low{step}", f"labels{step - 1}")
        moved = new.where("root != old").limit(1).count()
        labels, step = new.select("node", "root"), step + 1
        if not moved:
            scratch.drop("edges")
            return labels


def exact_pairs(sets: list[np.ndarray], side: np.ndarray, cross: bool, threshold: float) -> np.ndarray:
    """Pairs of sets with at least that Jaccard similarity; with cross, only those of different sides."""
    n, size = len(sets), np.array([len(s) for s in sets])
    if n <= 12:
        out = []
        for i in range(n):
            for j in range(i + 1, n):
                if (not cross or side[i] != side[j]) and min(size[i], size[j]) >= threshold * max(size[i], size[j]) - 1e-9:
                    same = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                    if same >= threshold * (size[i] + size[j] - same) - 1e-9:
                        out.append((i, j))
        return np.array(out, np.int64).reshape(-1, 2)
    _, token, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(n), size)
    shared = times[token] > 1
    rank = np.cumsum(times > 1) - 1
    token, owner = rank[token[shared]], owner[shared]
    order = np.argsort(token, kind="stable")
    token, owner = token[order], owner[order]
    same = np.zeros((n, n), np.float32)
    total = int(token[-1]) + 1 if len(token) else 0
    for a in range(0, total, 4096):  # some columns of the incidence matrix at a time
        low, high = np.searchsorted(token, [a, a + 4096])
        part = np.zeros((n, min(4096, total - a)), np.float32)
        part[owner[low:high], token[low:high] - a] = 1
        same += part @ part.T
    good = same >= threshold * (size[:, None] + size[None, :] - same) - 1e-6
    i, j = np.nonzero(np.triu(good, 1))
    keep = (side[i] != side[j]) if cross else np.ones(len(i), bool)
    return np.stack([i[keep], j[keep]], 1)


def verify(tasks: DataFrame, size: int, threshold: float) -> DataFrame:
    """key, links (documents), class_links, root (the least linked key's component in this block), from tasks(task, cross, key, side, copies, text)."""

    def group(table):
        import pyarrow as pa

        keys = table.column("key").to_numpy()
        order = np.argsort(keys, kind="stable")
        table = table.take(pa.array(order)).combine_chunks()
        keys, copies = keys[order], table.column("copies").to_numpy()
        sets = [shingle_set(x or b"", size) for x in table.column("text").cast(pa.large_binary()).to_pylist()]
        pairs = exact_pairs(sets, table.column("side").to_numpy(), table.column("cross")[0].as_py(), threshold)
        links, classes = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        for a, b in ((0, 1), (1, 0)):
            np.add.at(links, pairs[:, a], copies[pairs[:, b]])
            np.add.at(classes, pairs[:, a], 1)
        return pa.table({"key": keys, "links": links, "class_links": classes, "root": keys[roots_of(len(keys), pairs)]})

    return streamed(tasks, "task", "key long, links long, class_links long, root long", group)


def keyed(df: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, bool]:
    """df with _key and _text. The id is the key where it is there and tells all rows apart; else a hash of id and text, so that
    only equal rows share it. The second result says whether keys are unique."""
    ids = df.select(F.col(id_col).alias("i")).groupBy("i").count().agg(F.max("count").alias("most"), F.max(F.col("i").isNull()).alias("none")).first()
    unique = (ids["most"] or 1) == 1 and not ids["none"] and df.schema[id_col].dataType.typeName() in ("long", "integer", "short", "byte")
    key = F.col(id_col).cast("long") if unique else F.xxhash64(F.col(id_col).cast("string"), F.lit("\0"), F.col(text_col))
    return df.withColumns({"_key": key, "_text": F.col(text_col)}), unique


def classes(df: DataFrame, scratch: Scratch, size: int, threshold: float, recall: float) -> tuple[DataFrame, DataFrame]:
    """From rows (_key, _text): member rows (key, set, n), and of each set (set, n, rep, copies, root, links, class_links)."""
    own = scratch.save(signatures(df, size, runs_for(threshold, recall)), "signatures")
    reps = own.where("n > 0").groupBy("set", "n").agg(F.min(F.struct("key", "sketch", "roots")).alias("r"), F.count("*").alias("copies"))
    reps = scratch.save(reps.select("set", "n", F.col("r.key").alias("rep"), F.col("r.sketch").alias("sketch"), F.col("r.roots").alias("roots"), "copies"), "reps")
    level = compare(reps.select(F.explode("roots").alias("bucket"), F.col("rep").alias("key"), "n", "sketch"), threshold, BUCKET, scratch)
    edges = None
    for depth in range(1, DEPTH + 2):
        done = scratch.save(level, f"level{depth}")
        found = done.where("other is not null").select(F.col("key").alias("a"), F.col("other").alias("b"))
        edges = found if edges is None else edges.union(found)
        rest = done.where("other is null")
        if depth == DEPTH + 1 or rest.isEmpty():
            break
        if depth == DEPTH:  # all pairs of blocks; a block pair is one bucket
            count = rest.groupBy("bucket").agg(F.ceil(F.count("*") / BUCKET).cast("int").alias("blocks"))
            rest = pairs_of_blocks(rest.join(count, "bucket").withColumn("block", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int")), "bucket").withColumn("bucket", F.col("task"))
        level = compare(rest, threshold, BUCKET if depth < DEPTH else None, scratch)
    near = components(edges, scratch)
    members = reps.join(near, reps["rep"] == near["node"]).select("rep", "n", "copies", F.col("root").alias("component"))
    members = scratch.save(members, "members")
    sums = members.groupBy("component").agg(F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("n") / BLOCK_SHINGLES)).cast("int").alias("blocks"))
    blocked = members.join(sums, "component").withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    whole = df.select(F.col("_key").alias("rep"), F.col("_text").alias("text"))
    # a merge join at every size: a plan that broadcasts small inputs would tell nothing about large ones
    tasks = pairs_of_blocks(blocked, "component").hint("merge").join(whole, "rep")
    tasks = tasks.dropDuplicates(["task", "rep"]) if "_repeated" in df.columns else tasks
    checked = scratch.save(verify(tasks.select("task", "cross", F.col("rep").alias("key"), "side", "copies", "text"), size, threshold), "checked")
    true = checked.where("root != key").select(F.col("key").alias("a"), F.col("root").alias("b"))
    final = components(true, scratch)
    counts = checked.groupBy("key").agg(F.sum("links").alias("links"), F.sum("class_links").alias("class_links"))
    out = reps.select("set", "n", "rep", "copies").join(counts, F.col("rep") == counts["key"], "left").drop("key").join(final, F.col("rep") == final["node"], "left")
    out = out.select("set", "n", "rep", "copies", F.coalesce("root", "rep").alias("root"), F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("class_links", F.lit(0)).alias("class_links"))
    return own.select("key", "set", "n"), scratch.save(out, "classes")


def pairs_of_blocks(blocked: DataFrame, group: str) -> DataFrame:
    """Each row (with block of blocks) once for each pair of blocks that it is in: task, cross, side."""
    other = blocked.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    low, high = F.least("block", "with"), F.greatest("block", "with")
    return other.withColumns({"task": F.xxhash64(group, low, high), "cross": F.col("block") != F.col("with"), "side": F.col("block")}).withColumn("cross", low != high).drop("with", "block", "blocks")


def join_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, threshold: float = 0.8, recall: float = 0.999) -> DataFrame:
    """id, class_id, class_size, set_id, copies, n_links, n_set_links of each row.

    Words are runs of anything but ASCII white space; a text's set has its runs of `size` words, a shorter text's the
    run of all its words. set_id: the least id among the rows with an equal set, copies their number. n_links: how many other
    rows have a Jaccard similarity of at least the threshold; n_set_links: how many other sets. class_id: the least id of the
    rows that links connect, class_size their number.

    Null, empty and blank texts have no set and no links, and are classes of their own (set_id is null). Rows with a null id
    or an id that repeats are told apart by their text; equal rows are copies of each other. An empty table gives
    an empty one. Other columns are not read.
    """
    scratch = Scratch(df.sparkSession)
    rows, unique = keyed(df.select(id_col, text_col), id_col, text_col)
    if not unique:
        rows = rows.withColumn("_repeated", F.lit(True))
    own, sets = classes(rows, scratch, size, threshold, recall)
    if unique:
        full = own.join(sets, ["set", "n"], "left").withColumn("id", F.col("key"))
        names = {"class": F.col("root"), "set": F.col("rep")}
    else:
        of = rows.select(F.col("_key").alias("key"), F.col(id_col).alias("id")).dropDuplicates(["key"])
        own = own.join(of, "key")
        full = own.join(sets, ["set", "n"], "left")
        first = lambda c, name: full.groupBy(c).agg(F.min("id").alias(name)).withColumnRenamed(c, f"_{name}")
        full = full.join(first("root", "class"), F.col("root") == F.col("_class"), "left").join(first("rep", "least"), F.col("rep") == F.col("_least"), "left")
        names = {"class": F.col("class"), "set": F.col("least")}
    sizes = sets.groupBy(F.col("root").alias("of")).agg(F.sum("copies").alias("class_size"))
    full = full.join(sizes, F.col("root") == F.col("of"), "left")
    links = F.coalesce(F.col("links") + F.col("copies") - 1, F.lit(0)).cast("long")
    kind = df.schema[id_col].dataType
    return full.select(F.col("id").cast(kind).alias(id_col), F.coalesce(names["class"], F.col("id")).cast(kind).alias("class_id"), F.coalesce("class_size", F.lit(1)).cast("long").alias("class_size"), names["set"].cast(kind).alias("set_id"), F.coalesce("copies", F.lit(1)).cast("long").alias("copies"), links.alias("n_links"), F.coalesce("class_links", F.lit(0)).cast("long").alias("n_set_links"))


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, threshold: float = 0.8, recall: float = 0.999) -> DataFrame:
    """df with one row of each class, that with the least key (its id, or a hash where ids are null or repeat); null, empty and blank
    texts all stay. Columns as they are, whatever their names; an empty table gives an empty one."""
    scratch = Scratch(df.sparkSession)
    plain, (ident, text) = by_position(df, id_col, text_col)
    rows, unique = keyed(plain.select(F.struct("*").alias("_row"), ident, text), ident, text)
    own, sets = classes(rows if unique else rows.withColumn("_repeated", F.lit(True)), scratch, size, threshold, recall)
    first = sets.where("rep = root").select(F.col("rep").alias("_keep"))
    blank = own.where("n = 0").select(F.col("key").alias("_keep"))
    kept = rows.join(first.union(blank).distinct(), F.col("_key") == F.col("_keep"), "left_semi")
    if not unique:  # equal rows share a key: of those with words one stays
        words = F.length(F.regexp_replace(F.coalesce("_text", F.lit("")), r"[\x20\x09-\x0D]+", "")) > 0
        kept = kept.where(words).dropDuplicates(["_key"]).unionByName(kept.where(~words))
    return kept.select("_row.*").toDF(*df.columns)
