"""Exact top-k search by no-random-access aggregation.

The candidates of a block have, for each dimension, a list sorted by that dimension's component; a query
reads it from the end that helps its score, a step at a time in all dimensions. What has been read gives each
candidate a lower bound (what is unread at the list's worst) and an upper bound (what is unread at the list's
frontier). The k-th best lower bound, or the k-th best score of the blocks before if that is greater, is the
bar: a query stops as soon as only few candidates have an upper bound that reaches it, for no other can
qualify, and only these few get their final scores.

Queries are in groups and candidates in spans of blocks; a task takes one group through one span, block by block,
so that the bar rises. A window merges the spans' winners. The work is that of all queries against all candidates, in
tasks of bounded size; a candidate is sent once for every QUERY_GROUP queries, a query once for every SPAN candidates.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

#: Candidates in a block and in a span of blocks; queries in a group, and of these in memory together.
BLOCK, SPAN, QUERY_GROUP, QUERIES_TOGETHER = 2048, 16384, 4096, 512
#: How far the lists have been read after each step.
DEPTHS = (0.25, 0.4, 0.5, 0.55, 0.6, 0.65, 0.7, 0.75, 0.8, 0.85, 0.9, 0.95, 1.0)


class Lists:
    """A block of candidates as lists sorted by component. kind: a type that holds all sums exactly."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, kind: type):
        self.ids, self.v = ids, vectors.astype(kind)
        self.order = np.argsort(self.v, axis=0, kind="stable")
        self.sorted = np.take_along_axis(self.v, self.order, axis=0)

    def read(self, low: int, high: int, unread: np.ndarray) -> np.ndarray:
        """The entries of all lists from place low to place high, by candidate; they are unread no more."""
        out = np.zeros_like(self.v)
        np.put_along_axis(out, self.order[low:high], self.sorted[low:high], axis=0)
        np.put_along_axis(unread, self.order[low:high], 0, axis=0)
        return out


def search(lists: Lists, query_ids: np.ndarray, queries: np.ndarray, k: int, bar: np.ndarray, depths: list | None = None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each query its place, and the candidates that can be among the k best and reach its bar, with final scores."""
    n, kind = len(lists.ids), lists.v.dtype
    up, down = np.maximum(queries, 0), np.minimum(queries, 0)
    unread_top, unread_low = np.ones_like(lists.v), np.ones_like(lists.v)
    open_q, done, few = np.arange(len(queries)), 0, 8 * k
    have = np.zeros((n, len(queries)), kind)  # what each candidate's read entries sum to
    for depth in DEPTHS:
        t = min(n, math.ceil(depth * n))
        a, b = up[open_q].T, down[open_q].T
        have += lists.read(n - t, n - done, unread_top) @ a + lists.read(done, t, unread_low) @ b
        done = t
        upper = have
        if t < n:
            upper = have + unread_top @ (a * lists.sorted[n - t][:, None]) + unread_low @ (b * lists.sorted[t - 1][:, None])
        own = lists.ids[:, None] == query_ids[open_q]  # a query's id may have any number of rows; none is a candidate
        least = bar[open_q]
        if n > k and (t == n or not np.isfinite(least.astype(float)).all()):
            lower = have if t == n else have + unread_top @ (a * lists.sorted[0][:, None]) + unread_low @ (b * lists.sorted[-1][:, None])
            lower = np.where(own, -np.inf, lower)
            least = np.maximum(least, np.partition(lower, n - k, axis=0)[n - k])
        alive = (upper >= least) & ~own
        stop = (alive.sum(0) <= few) | (t == n)
        for j in np.flatnonzero(stop):
            c = np.flatnonzero(alive[:, j])
            yield int(open_q[j]), c, lists.v[c] @ queries[open_q[j]]
        if depths is not None:
            depths += [depth] * int(stop.sum())
        open_q, have = open_q[~stop], have[:, ~stop]
        if not len(open_q):
            break


class Search:
    """The k best candidates of each of some queries, over blocks of candidates that come one after another. Integers."""

    def __init__(self, query_ids: np.ndarray, queries: np.ndarray, k: int, depths: list | None = None):
        self.ids, self.queries, self.k, self.depths = query_ids, queries, k, depths
        self.best = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(query_ids)  # scores, candidates
        self.bar = np.full(len(query_ids), -np.inf, object)

    def block(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        d = max(vectors.shape[1], self.queries.shape[1])
        wide = lambda x: np.pad(x, ((0, 0), (0, d - x.shape[1])))
        vectors, queries = wide(vectors), wide(self.queries)
        most = int(np.abs(vectors).max(initial=0)) * int(np.abs(queries).max(initial=0)) * max(d, 1) * 4
        kind = np.float32 if most < 2**24 else np.float64 if most < 2**53 else object
        lists = Lists(ids, vectors, kind)
        for at in range(0, len(self.ids), QUERIES_TOGETHER):
            some = slice(at, at + QUERIES_TOGETHER)
            bar = self.bar[some].astype(kind if kind is not object else object)
            for j, c, scores in search(lists, self.ids[some], queries[some].astype(kind), self.k, bar, self.depths):
                self.merge(at + j, scores.astype(np.int64 if kind is not object else object), ids[c])

    def merge(self, q: int, scores: np.ndarray, ids: np.ndarray) -> None:
        scores, ids = np.concatenate([self.best[q][0], scores]), np.concatenate([self.best[q][1], ids])
        order = np.lexsort((ids, -scores))[: self.k]
        self.best[q] = scores[order], ids[order]
        if len(order) == self.k:
            self.bar[q] = scores[order[-1]]

    def result(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Query ids, candidate ids and scores."""
        counts = [len(s) for s, _ in self.best]
        join = lambda x: np.concatenate(x).astype(np.int64) if x else np.zeros(0, np.int64)
        return np.repeat(self.ids, counts).astype(np.int64), join([i for _, i in self.best]), join([s for s, _ in self.best])


def top_k(df: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 64) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k candidates with the highest integer inner product of the
    vectors floor(scale * x), ties to the smaller id, for each query; a query's own id is no candidate.

    Vectors that are null or hold a null or non-finite component, and rows with a null id, take no part. A shorter
    vector counts as if zeros followed; an empty one scores 0. Rows that repeat an id are candidates each; a repeated query
    id asks once, with the least of its vectors. An empty table gives an empty one. Other columns are not read.
    Components and scores are 64-bit integers; beyond them Spark's arithmetic decides.
    """
    x = F.col(vector_col)
    fine = F.col(id_col).isNotNull() & x.isNotNull() & F.coalesce(F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf"))), F.lit(False))
    rows = df.where(fine).select(F.col(id_col).cast("long").alias("id"), F.transform(x, lambda e: F.floor(F.lit(scale) * e.cast("double"))).alias("v"), F.coalesce(is_query, F.lit(False)).alias("is_query"))
    most = F.array_max(F.transform("v", F.abs))
    size = rows.agg(F.count("*").alias("n"), F.count_if("is_query").alias("q"), F.max(most).alias("most")).first()
    if (size["most"] or 0) < 2**15:
        rows = rows.withColumn("v", F.col("v").cast("array<smallint>"))  # a quarter of the bytes to shuffle
    asked = rows.where("is_query").groupBy("id").agg(F.min("v").alias("v"))
    n_spans, n_groups = max(1, math.ceil(size["n"] / SPAN)), max(1, math.ceil(size["q"] / QUERY_GROUP))
    hashed = lambda n, seed: F.pmod(F.xxhash64("id", "v", F.lit(seed)), F.lit(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    candidates = rows.select("id", "v", hashed(n_spans, 1).alias("span"), hashed(SPAN // BLOCK, 2).alias("block"), each(n_groups).alias("group"))
    queries = asked.select("id", "v", each(n_spans).alias("span"), F.lit(-1).alias("block"), hashed(n_groups, 3).alias("group"))
    both = candidates.unionByName(queries).select((F.col("span") * F.lit(n_groups).cast("long") + F.col("group")).alias("task"), "block", "id", "v")

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        held, at, now = [], None, None

        def vectors(table):
            lists = table.column("v").combine_chunks()
            lengths = np.diff(lists.offsets.to_numpy())
            v = np.zeros((len(lengths), int(lengths.max(initial=0))), np.int64)
            v[np.arange(v.shape[1])[None, :] < lengths[:, None]] = lists.flatten().to_numpy()
            return table.column("id").to_numpy(), v

        def take() -> None:
            nonlocal now, held
            if held and at[1] < 0:
                now = Search(*vectors(pa.Table.from_batches(held)), k)
            elif held and now is not None:
                now.block(*vectors(pa.Table.from_batches(held)))
            held = []

        def out() -> Iterator:
            if now is not None:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in now.result()], ["query_id", "vec_id", "score"])

        for batch in batches:
            task, block = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            cuts = (np.flatnonzero((np.diff(task) != 0) | (np.diff(block) != 0)) + 1).tolist()
            for a, b in zip([0, *cuts], [*cuts, len(task)]):
                if a == b:
                    continue
                key = int(task[a]), int(block[a])
                if key != at:
                    take()
                    if at and key[0] != at[0]:
                        yield from out()
                        now = None
                    at = key
                held.append(batch.slice(a, b - a))
        take()
        yield from out()

    dealt = both.repartition(n_spans * n_groups, "task").sortWithinPartitions("task", "block")
    found = dealt.mapInArrow(run, "query_id long, vec_id long, score long")
    ranked = found.withColumn("rank", F.row_number().over(W.Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
