"""SimHash near-duplicates by vantage-point trees.

A text's fingerprint has a bit for each that is set in over half of its shingles' hashes. Equal fingerprints are one point; points
link within `radius` bits, and the links' components are the groups.

The trees' upper levels deal the points over Spark's tasks. The 64 bits are cut into radius // 2 + 1 stretches, one a tree: two points
within the radius are within one bit in some stretch. A tree cuts its stretch into windows, one a level, and parts the points by their
Hamming distance from the level's vantage point in that window. The windows share no bits, so that the distances of two linked points
differ by one at one level at most (the triangle bound, summed over the path). A shard has the points of one path; its points query it,
and so do those of the neighbouring paths whose balls reach over the boundary. Bits of a hash are as good as any other, so that vantage
points need no sample. The lower levels are a tree over all 64 bits in each shard, with vantage points of its own, pruned by the radius.

The levels grow with the number of points, which keeps shards small; one that grows large all the same, as near copies share paths,
is searched block against block. A shard hands on one edge a point at most, never one per pair.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.llm.common import PIECE, Scratch, mix, small_batches, texts
from granary.llm.jaccard_join import components, roots_of, streamed

SHINGLE, SEED, RADIUS = 4, 42, 4
#: Points that a shard has at most if bits are evenly spread; points of a block of one that has more.
SHARD, BLOCK = 4096, 1 << 17
#: Points of a leaf, and queries that are compared with it at a time.
LEAF, QUERIES = 64, 8192
#: Rows with one fingerprint that are joined with its component in one task.
TOGETHER = 100_000

_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
_PLACES = (np.arange(8) * 256).astype(np.int64)


def _set_bits(hashes: np.ndarray) -> np.ndarray:
    """How often each of the 64 bits is set."""
    at = hashes.astype("<u8").view(np.uint8).reshape(-1, 8) + _PLACES
    return (np.bincount(at.ravel(), minlength=2048).reshape(8, 256) @ _BITS).reshape(64)


def fingerprint(text: bytes, size: int = SHINGLE, seed: int = SEED) -> int:
    """The SimHash of a text's word shingles, in pieces of bounded size; zero without a word."""
    from xxhash import xxh64_intdigest

    counts, n, held, at = np.zeros(64, np.int64), 0, [], 0
    while at < len(text):
        end = min(len(text), at + PIECE)
        while end < len(text) and text[end : end + 1].strip():  # a word is never cut
            end += 1
        words, at = held + text[at:end].lower().split(), end
        if len(words) < size:
            held = words
            continue
        line = b" ".join(words)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(lengths + 1) - 1
        starts = ends - lengths
        spans = zip(starts[: len(words) - size + 1].tolist(), ends[size - 1 :].tolist())
        hashes = np.fromiter((xxh64_intdigest(line[a:b], seed) for a, b in spans), np.uint64, len(words) - size + 1)
        counts += _set_bits(hashes)
        n += len(hashes)
        held = words[len(words) - size + 1 :]
    if not n and held:
        counts, n = _set_bits(np.array([xxh64_intdigest(b" ".join(held), seed)], np.uint64)), 1
    return sum(1 << int(k) for k in np.flatnonzero(2 * counts > n))


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, point (the fingerprint as a signed long) of each row."""
    small_batches(df.sparkSession)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            points = np.array([fingerprint(x) for x in texts(batch)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(points)], ["id", "point"])

    rows = df.select(df[f"`{id_col}`"].alias("id"), df[f"`{text_col}`"].alias("text"))
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, point long")


def windows(first: int, last: int, levels: int) -> list[tuple[int, int]]:
    """The bits [first, last) cut into levels of nearly equal width."""
    edges = [first + (last - first) * k // levels for k in range(levels + 1)]
    return list(zip(edges, edges[1:]))


def levels_for(n: int, bits: int, shard: int) -> int:
    """The fewest levels at which the likeliest path of n points with even bits has at most `shard` of them."""
    likeliest = lambda w: math.comb(w, w // 2) / 2**w
    for levels in range(1, bits + 1):
        if n * math.prod(likeliest(b - a) for a, b in windows(0, bits, levels)) <= shard:
            return levels
    return bits


def _signed(x: int) -> int:
    return x - 2**64 if x >= 2**63 else x


def shards(point: Column, n: int, radius: int = RADIUS, shard: int = SHARD) -> Column:
    """array of struct(shard, home): where a point is, and where else it must be looked up. Of two neighbouring paths the points of
    the one farther out query the one nearer to the vantage point, so that a pair meets once."""
    trees, out = radius // 2 + 1, []
    for tree, (first, last) in enumerate(windows(0, 64, trees)):
        radix, path, steps = trees, F.lit(tree).cast("long"), []
        for a, b in windows(first, last, levels_for(n, last - first, shard)):
            window = ((1 << b) - 1) ^ ((1 << a) - 1)
            vantage = int(mix(np.array([64 * tree + a + 1], np.uint64))[0])
            ring = F.bit_count(point.bitwiseXOR(F.lit(_signed(vantage))).bitwiseAND(F.lit(_signed(window)))).cast("long")
            path = path + ring * radix
            steps.append((ring, radix))
            radix *= b - a + 1
        out.append(F.struct(path.alias("shard"), F.lit(True).alias("home")))
        out += [F.when(ring > 0, F.struct((path - step).alias("shard"), F.lit(False).alias("home"))) for ring, step in steps]
    return F.filter(F.array(*out), lambda x: x.isNotNull())


def _near(members: np.ndarray, queries: np.ndarray, radius: int) -> np.ndarray:
    """Which pairs (member, query) are within the radius."""
    return np.bitwise_count(members[:, None] ^ queries[None, :]) <= radius


class _Links:
    """Edges between n points, which are replaced by a forest whenever they have become many."""

    def __init__(self, n: int):
        self.n, self.edges, self.held = n, [np.zeros((0, 2), np.int64)], 0

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        self.edges.append(np.stack(np.broadcast_arrays(a, b), 1).reshape(-1, 2))
        self.held += len(self.edges[-1])
        if self.held > 4 * self.n + 100_000:
            root = self.roots()
            self.edges, self.held = [np.stack([np.arange(self.n), root], 1)], self.n

    def roots(self) -> np.ndarray:
        return roots_of(self.n, np.concatenate(self.edges))


def search(points: np.ndarray, members: np.ndarray, queries: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """The least index of each point's component, under the links between members and queries (indices into points), by a
    vantage-point tree over the members. A subtree is passed by if no point of it can be near, and taken whole if all must be."""
    links, stack = _Links(len(points)), [(members, queries)]
    while stack:
        inside, asking = stack.pop()
        if not len(inside) or not len(asking):
            continue
        vantage = points[inside[0]]
        far, ask = np.bitwise_count(points[inside] ^ vantage), np.bitwise_count(points[asking] ^ vantage)
        whole = ask.astype(np.int64) + int(far.max()) <= radius
        if whole.any():
            taken, asking, ask = asking[whole], asking[~whole], ask[~whole]
            links.add(taken, inside[0])
            links.add(inside, taken[0])
        middle = int(np.sort(far)[len(far) // 2])
        if middle == far.max():  # the outer part would be empty
            middle -= 1
        near = far <= middle
        if len(inside) > LEAF and near.any():
            stack.append((inside[near], asking[ask.astype(np.int64) <= middle + radius]))
            stack.append((inside[~near], asking[ask.astype(np.int64) > middle - radius]))
            continue
        for m in range(0, len(inside), LEAF):
            part = inside[m : m + LEAF]
            for q in range(0, len(asking), QUERIES):
                some = asking[q : q + QUERIES]
                a, b = np.nonzero(_near(points[part], points[some], radius))
                links.add(part[a], some[b])
    return links.roots()


def edges(points: DataFrame, n: int, scratch: Scratch, radius: int = RADIUS, shard: int = SHARD, block: int = BLOCK) -> DataFrame:
    """a, b: edges between points (a column of distinct longs, n rows) that connect what links within the radius connect."""
    dealt = points.select("point", F.explode(shards(F.col("point"), n, radius, shard)).alias("s")).select("point", "s.*")
    # one row for every `block` rows at most, written: its known size decides whether Spark broadcasts it
    hot = dealt.groupBy("shard").count().where(F.col("count") > block)
    hot = scratch.save(hot.select("shard", F.ceil(F.col("count") / block).cast("int").alias("blocks")), "hot")
    dealt = dealt.withColumn("asks", F.lit(True))
    if hot.isEmpty():
        dealt = dealt.withColumn("task", F.xxhash64("shard"))
    else:  # a block of members with a block of queries is one task
        own, every = F.pmod(F.xxhash64("point"), F.col("blocks")).cast("int"), F.sequence(F.lit(0), F.col("blocks") - 1)
        place = lambda i, j, asks: F.struct(i.alias("i"), j.alias("j"), asks.alias("asks"))
        asked = F.transform(every, lambda k: place(k, own, F.lit(True)))
        kept = F.filter(F.transform(every, lambda k: place(own, k, F.lit(False))), lambda x: x["j"] != own)
        alone = F.array(place(F.lit(0), F.lit(0), F.lit(True)))
        places = F.when(F.col("blocks").isNull(), alone).when(F.col("home"), F.concat(asked, kept)).otherwise(asked)
        dealt = dealt.join(hot, "shard", "left").withColumn("p", F.explode(places))
        member = F.col("home") & (F.col("blocks").isNull() | (own == F.col("p.i")))
        dealt = dealt.select("point", member.alias("home"), F.col("p.asks").alias("asks"), F.xxhash64("shard", "p.i", "p.j").alias("task"))

    def group(table):
        import pyarrow as pa

        found, home, asks = table.column("point").to_numpy().view(np.uint64), table.column("home").to_numpy(), table.column("asks").to_numpy()
        # a task with the keys of two shards, which a hash may give, only compares more
        root = search(found, np.flatnonzero(home), np.flatnonzero(asks), radius)
        at = np.flatnonzero(root != np.arange(len(root)))
        at = at[found[at] != found[root[at]]]
        return pa.table({"a": found[at].view(np.int64), "b": found[root[at]].view(np.int64)}) if len(at) else None

    return streamed(dealt.select("task", "point", "home", "asks"), "task", "a long, b long", group)


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS, shard: int = SHARD, block: int = BLOCK) -> DataFrame:
    """id, fingerprint (16 hex digits), component_id of each row.

    A-Z count as a-z; words are runs of anything but ASCII white space, shingles runs of four words with repeats; a shorter text is one
    shingle. A bit is set if over half of the shingles' XXH64 (seed 42) have it. Rows whose fingerprints differ in at most
    `radius` bits are linked; component_id is the least id that links lead to, the row's own included.

    Null, empty and blank texts have fingerprint zero, which links like any other. A null id is never the least: a component of such
    rows alone has a null component_id. Repeated rows and ids stay, one result each. An empty table gives an empty one. Other
    columns are not read.
    """
    scratch = Scratch(df.sparkSession)
    own = scratch.save(fingerprints(df, id_col, text_col), "fingerprints")
    points = scratch.save(own.groupBy("point").agg(F.min("id").alias("least"), F.count("*").alias("n")), "points")
    found = scratch.save(edges(points.select("point"), points.count(), scratch, radius, shard, block), "edges")
    linked = components(found, scratch)
    least = linked.join(points, linked["node"] == points["point"]).groupBy("root").agg(F.min("least").alias("component_id"))
    named = linked.join(least, "root").select(F.col("node").alias("point"), "component_id")
    parts = F.ceil(F.col("n") / TOGETHER).cast("int")
    of = points.join(named, "point", "left").select("point", F.coalesce("component_id", "least").alias("component_id"), F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"))
    hot = scratch.save(points.where(F.col("n") > TOGETHER).select("point", parts.alias("parts")), "common")
    if hot.isEmpty():
        own = own.withColumn("part", F.lit(0))
    else:
        own = own.join(hot, "point", "left").withColumn("part", F.coalesce(F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"), F.lit(0)))
    out = own.join(of, ["point", "part"])
    return out.select(F.col("id").alias(id_col), F.lpad(F.lower(F.hex("point")), 16, "0").alias("fingerprint"), "component_id")
