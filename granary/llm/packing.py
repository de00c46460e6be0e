"""Best-fit packing after a Martello-Toth dominance reduction.

A piece matters to the plan by its length only, and there are at most `capacity` lengths. So the
instance is a histogram, whatever the number of pieces: the plan is made on counts (of the order of
`capacity` groups of equal sequences) and each piece then finds its place from its length and its rank
among the pieces of that length. Nothing that grows with the corpus reaches the driver.
"""

from __future__ import annotations

import math
import re
import struct
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from granary.llm.common import Scratch, gathered, mix, small_batches, text_bytes

#: Rows that are ranked together, so that a length that a third of all pieces have is ranked in many tasks.
RANKED_TOGETHER = 10_000
#: Words that a Python worker remembers at most, some 60 bytes each; then it starts anew.
REMEMBERED, SHIFT = 1 << 19, 44  # twice as many values of the leading 20 bits
#: Bytes of texts that are encoded together, and of a word that is remembered at most.
TOGETHER, LONGEST_WORD = 2 << 20, 24
_ODD = np.uint64(0x9E3779B97F4A7C15)


class Words:
    """Remembered words as arrays sorted by a hash of their bytes: the bytes (as three 64-bit numbers), and where in
    `pool` their ids are. A hash finds a word and the bytes confirm it, so that no collision can give wrong ids."""

    def __init__(self):
        self.clear()

    def clear(self) -> None:
        self.hash, self.bytes = np.zeros(0, np.uint64), np.zeros((0, 3), np.uint64)
        self.start, self.n, self.pool = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)
        self.index()

    def index(self) -> None:
        """Where the hashes with each leading bits begin."""
        count = np.bincount((self.hash >> np.uint64(SHIFT)).astype(np.int64), minlength=2 * REMEMBERED)
        self.first = (np.cumsum(count) - count).astype(np.int32)

    def find(self, hashes: np.ndarray, raw: np.ndarray) -> np.ndarray:
        """The place of each word, -1 of those that are not remembered."""
        if not len(self.hash):
            return np.full(len(hashes), -1)
        at = np.minimum(self.first[hashes >> np.uint64(SHIFT)], len(self.hash) - 1)
        behind = np.flatnonzero(self.hash[at] < hashes)
        while len(behind):
            at[behind] += 1
            behind = behind[at[behind] < len(self.hash)]
            behind = behind[self.hash[at[behind]] < hashes[behind]]
        at = np.minimum(at, len(self.hash) - 1)
        known = self.bytes[at]
        same = (self.hash[at] == hashes) & (known[:, 0] == raw[:, 0]) & (known[:, 1] == raw[:, 1]) & (known[:, 2] == raw[:, 2])
        return np.where(same, at, -1)

    def add(self, hashes: np.ndarray, raw: np.ndarray, ids: list[bytes]) -> None:
        """Words whose hashes are sorted, distinct and new."""
        if len(self.hash) + len(hashes) > REMEMBERED:
            self.clear()
        n = np.array([len(x) // 4 for x in ids], np.int64)
        start = len(self.pool) + np.cumsum(n) - n
        at = np.searchsorted(self.hash, hashes)
        self.hash, self.bytes = np.insert(self.hash, at, hashes), np.insert(self.bytes, at, raw, axis=0)
        self.start, self.n = np.insert(self.start, at, start), np.insert(self.n, at, n)
        self.pool = np.concatenate([self.pool, np.frombuffer(b"".join(ids), "<u4")])
        self.index()


class Encoder:
    """The token ids of texts under a tokenizers file, without added special tokens.

    White space separates tokens in every pre-tokenizer that drops it, and so does the place between a letter and a
    mark, so a text's ids are those of its parts in turn. Each short part that is new is encoded by the library and
    remembered; long ones are encoded each time. Parts that are plain letters are encoded as the lower-case letters, by
    the library's model alone (normalizing and splitting leave them as they are). A tokenizer for which that does not
    hold, and texts that contain a special token, are encoded whole.
    """

    PLAIN = re.compile(r"[A-Za-zÀ-ÖØ-öø-ÿ]+")
    TRIAL = "The heed, Größe. it's 42x! naïve\n\tÀ,b c'est éa  ΣΣ foo;bar -- \x1c z ÿþß 'll. x.'s", "a b", "Été's. 'll x", "a.b,,c;'d e!?f\u0301. g:\"h\".", "..!a's,"

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.t = Tokenizer.from_file(path)
        self.special = [x.content.encode() for x in self.t.get_added_tokens_decoder().values()]
        self.words = Words()
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]  # a byte-level model's letters: others follow from 256 on
        odd = iter(range(256, 512))
        letters = [chr(b) if b in printable else chr(next(odd)) for b in range(256)]
        self.byte_letters = {c: "".join(letters[x] for x in chr(c).encode()) for c in range(192, 256)}
        kind = np.zeros(256, np.int8)  # 1: separates, 2: mark, 3: letter
        kind[[0x20, 0x09, 0x0A]] = 1
        kind[list(b".,;:!?")] = 2
        kind[[*range(65, 91), *range(97, 123)]] = 3
        self.kind = kind
        self.lower = np.arange(256, dtype=np.uint8)
        self.lower[65:91] += 32
        self.by_part = all(self.parts(x.encode()) == self.whole(x).tobytes() for x in self.TRIAL) and self.spaced()

    def spaced(self) -> bool:
        """Whether a space yields no token and separates those around it."""
        whole = lambda x: self.whole(x).tobytes()
        return whole("ab cd") == whole("ab") + whole("cd") and whole(" \n\t") == b""

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.t.encode(text, add_special_tokens=False).ids, "<u4")

    def parts(self, text: bytes) -> bytes:
        return self.fast(np.frombuffer(text, np.uint8), np.array([0, len(text)]))[0].tobytes()

    def learn(self, words: list[bytes]) -> list[bytes]:
        """The ids of each word, as little-endian 32-bit bytes."""
        out, rest, plain = [b""] * len(words), [], {}
        match, tokenize = self.PLAIN.fullmatch, self.t.model.tokenize
        for i, x in enumerate(map(bytes.decode, words)):
            if not match(x):
                rest.append((i, x))
                continue
            low = x.lower()
            if (ids := plain.get(low)) is None:
                own = low if low.isascii() else low.translate(self.byte_letters)
                plain[low] = ids = struct.pack(f"<{len(k)}I", *k) if (k := [t.id for t in tokenize(own)]) else b""
            out[i] = ids
        for (i, _), e in zip(rest, self.t.encode_batch_fast([x for _, x in rest], add_special_tokens=False)):
            out[i] = struct.pack(f"<{len(e.ids)}I", *e.ids)
        return out

    def fast(self, raw: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the texts raw[edges[k]:edges[k + 1]], one after another, and how many each has."""
        raw = self.lower[raw]
        kind = np.concatenate([self.kind[raw], np.ones(1, np.int8)])
        apart = np.zeros(len(raw) + 1, bool)  # whether a part ends before this place, as it does where a text ends
        apart[edges] = True
        apart[1:-1] |= (kind[:-2] == 3) & (kind[1:-1] == 2)
        inner = kind != 1
        before = np.concatenate([np.zeros(1, bool), inner[:-1]])
        starts = np.flatnonzero(inner & (apart | ~before))
        ends = np.flatnonzero(before & (apart | ~inner))
        size = ends - starts
        padded = np.concatenate([raw, np.zeros(LONGEST_WORD, np.uint8)])
        eight = np.ndarray(len(raw) + LONGEST_WORD - 7, "<u8", padded, strides=(1,))  # the eight bytes from each place on
        short = np.flatnonzero(size <= LONGEST_WORD)
        key = np.empty((len(short), 3), np.uint64)
        for k in range(3):
            some = np.clip(size[short] - 8 * k, 0, 8).astype(np.uint64)
            key[:, k] = eight[np.minimum(starts[short] + 8 * k, len(raw))] & np.where(some == 8, ~np.uint64(0), (np.uint64(1) << (some * np.uint64(8))) - np.uint64(1))
        hashes = mix(key[:, 0] * _ODD + mix(key[:, 1] + mix(key[:, 2])))
        there = self.words.find(hashes, key)
        if (there < 0).any():
            new = np.flatnonzero(there < 0)
            fresh, first = np.unique(hashes[new], return_index=True)
            first = new[first]
            if len(self.words.hash):  # one of another word with an equal hash is left to the slow way
                known = self.words.hash[np.minimum(np.searchsorted(self.words.hash, fresh), len(self.words.hash) - 1)] == fresh
                fresh, first = fresh[~known], first[~known]
            where = short[first]
            learnt = self.learn([padded[a:b].tobytes() for a, b in zip(starts[where], ends[where])])
            self.words.add(fresh, key[first], learnt)
            there = self.words.find(hashes, key)
            if (there < 0).any() and len(fresh) < REMEMBERED // 2:  # the memory began anew: once more
                return self.fast(raw, edges)
        n, at = np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64)
        n[short] = np.where(there < 0, 0, self.words.n[there]) if len(self.words.n) else 0
        at[short] = np.where(there < 0, 0, self.words.start[there]) if len(self.words.n) else 0
        slow = np.concatenate([np.flatnonzero(size > LONGEST_WORD), short[there < 0]])
        pool = self.words.pool
        if len(slow):
            own = [struct.pack(f"<{len(e.ids)}I", *e.ids) for e in self.t.encode_batch_fast([padded[a:b].tobytes().decode() for a, b in zip(starts[slow], ends[slow])], add_special_tokens=False)]
            n[slow] = [len(x) // 4 for x in own]
            at[slow] = len(pool) + np.cumsum(n[slow]) - n[slow]
            pool = np.concatenate([pool, np.frombuffer(b"".join(own), "<u4")])
        done = np.concatenate([[0], np.cumsum(n)])
        ids = pool[np.repeat(at - done[:-1], n) + np.arange(done[-1])]
        return ids, np.diff(done[np.searchsorted(starts, edges)])

    def encode(self, values: np.ndarray, edges: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The ids of the UTF-8 texts values[edges[k]:edges[k + 1]], one after another, and how many each has; some texts at a time."""
        k = 0
        while k < len(edges) - 1:
            stop = max(k + 1, int(np.searchsorted(edges, edges[k] + TOGETHER, "right")) - 1)
            raw, own = values[edges[k] : edges[stop]], edges[k : stop + 1] - edges[k]
            text = raw.tobytes() if self.special else b""
            if self.by_part and not any(x in text for x in self.special):
                yield from self.long(raw) if stop == k + 1 and len(raw) > TOGETHER else [self.fast(raw, own)]
            else:
                for a, b in zip(own, own[1:]):
                    part = raw[a:b].tobytes()
                    if self.by_part and not any(x in part for x in self.special):
                        yield self.fast(raw[a:b], np.array([0, b - a]))
                    else:
                        ids = self.whole(part.decode())
                        yield ids, np.array([len(ids)])
            k = stop

    def long(self, raw: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """One text beyond TOGETHER bytes, in stretches that end before a separator."""
        found, at = [], 0
        while at < len(raw):
            end = min(len(raw), at + TOGETHER)
            while end < len(raw):
                gaps = np.flatnonzero(self.kind[raw[end : end + TOGETHER]] == 1)
                end = end + int(gaps[0]) if len(gaps) else min(len(raw), end + TOGETHER)
                if len(gaps):
                    break
            found.append(self.fast(raw[at:end], np.array([0, end - at]))[0])
            at = end
        ids = np.concatenate(found)
        yield ids, np.array([len(ids)])


_ENCODERS: dict[str, Encoder] = {}


def pieces(df: DataFrame, tokenizer: str, capacity: int, id_col: str, text_col: str, end_id: int, with_ids: bool) -> DataFrame:
    """doc_id, piece, start, length, their ids' crc32 and, if wanted, ids (little-endian 32-bit): a document is its ids and
    end_id, cut only where it is longer than capacity."""
    small_batches(df.sparkSession)

    def run(batches: Iterator) -> Iterator:
        import os
        import zlib

        import pyarrow as pa

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        if tokenizer not in _ENCODERS:
            _ENCODERS[tokenizer] = Encoder(tokenizer)
        encoder, end = _ENCODERS[tokenizer], np.array([end_id], "<u4")
        for batch in gathered(batches, TOGETHER):
            done = 0
            for ids, counts in encoder.encode(*text_bytes(batch.column(1))):
                ids = np.insert(ids, np.cumsum(counts), end)
                counts = counts + 1
                parts = -(-counts // capacity)
                row = np.repeat(np.arange(len(counts)), parts)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(parts) - parts, parts)
                n = np.minimum(counts[row] - piece * capacity, capacity)
                edges = np.concatenate([[0], np.cumsum(n)])
                view = memoryview(ids.astype("<u4", copy=False)).cast("B")
                sums = [zlib.crc32(view[4 * a : 4 * b]) for a, b in zip(edges.tolist(), edges[1:].tolist())]
                cols = [batch.column(0).take(pa.array(row + done)), pa.array(piece, pa.int32()), pa.array(piece * capacity, pa.int64()), pa.array(n, pa.int64()), pa.array(sums, pa.int64())]
                if with_ids:
                    cols.append(pa.array([view[4 * a : 4 * b].tobytes() for a, b in zip(edges.tolist(), edges[1:].tolist())], pa.binary()))
                yield pa.RecordBatch.from_arrays(cols, ["doc_id", "piece", "start", "length", "ids_crc32", "ids"][: len(cols)])
                done += len(counts)

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(df[id_col], df[text_col]).mapInArrow(run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids)


class Plan:
    """Groups of equal sequences: how often, and which lengths in which order."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.capacity, self.left = capacity, {s: c for s, c in counts.items() if c}
        self.sizes = sorted(self.left)
        self.fixed: list[tuple[int, list[tuple[int, int]]]] = []  # (times, [(length, how many)])
        self.reduce()
        self.groups = self.fixed + self.best_fit()

    def take(self, size: int, n: int) -> None:
        self.left[size] -= n
        if not self.left[size]:
            del self.left[size]
            del self.sizes[bisect_left(self.sizes, size)]

    def fix(self, times: int, *members: int) -> None:
        self.fixed.append((times, [(s, members.count(s)) for s in dict.fromkeys(members)]))
        for s in members:
            self.take(s, times)

    def least(self, n: int, but: int) -> list[int]:
        """The n smallest lengths that remain beside one piece of length `but`."""
        out: list[int] = []
        for s in self.sizes:
            out += [s] * min(n - len(out), self.left[s] - (s == but))
            if len(out) == n:
                break
        return out

    def best_single(self, size: int) -> int | None:
        """The longest length that fits beside a piece of this length."""
        i = bisect_left(self.sizes, self.capacity - size + 1)
        while i and self.sizes[i - 1] == size and self.left[size] < 2:
            i -= 1
        return self.sizes[i - 1] if i else None

    def best_pair(self, size: int) -> int:
        """The greatest length of two pieces that fit beside a piece of this length."""
        room, best, j = self.capacity - size, 0, len(self.sizes) - 1
        have = lambda s: self.left[s] - (s == size)
        for i, a in enumerate(self.sizes):
            while j >= 0 and a + self.sizes[j] > room:
                j -= 1
            k = j
            while k >= i and not (have(a) and have(self.sizes[k]) and (k != i or have(a) > 1)):
                k -= 1
            if k < i:
                if j < i:
                    break
                continue
            best = max(best, a + self.sizes[k])
        return best

    def reduce(self) -> None:
        """Fixes sequences that dominate every other one their longest piece could be in: it fits beside nothing;
        or beside one piece at most, or one that fills the sequence, with the longest that fits; or beside two
        at most, of which no pair is longer than that single piece. Repeats while any is found."""
        found = True
        while found:
            found = False
            for size in self.sizes[::-1]:
                while size in self.left:
                    room = self.capacity - size
                    low = self.least(3, size)
                    fit = sum(sum(low[: k + 1]) <= room for k in range(len(low)))
                    one = self.best_single(size) if fit else None
                    if not fit:
                        self.fix(self.left[size], size)
                    elif fit == 1 or one == room or fit == 2 and self.best_pair(size) <= one:
                        times = self.left[size] // 2 if one == size else min(self.left[size], self.left[one])
                        # with two beside it, all stays as it is while there are three or more of each length
                        self.fix(times if one == room or fit == 1 else max(1, times - 3), size, one)
                    else:
                        break
                    found = True

    def best_fit(self) -> list[tuple[int, list[tuple[int, int]]]]:
        """Longest first, each into the open sequence that it leaves least room in."""
        by_room: dict[int, list[tuple[int, list[tuple[int, int]]]]] = {}
        rooms: list[int] = []

        def put(room: int, times: int, what: list[tuple[int, int]]) -> None:
            if room not in by_room:
                by_room[room] = []
                rooms.insert(bisect_left(rooms, room), room)
            by_room[room].append((times, what))

        for size in self.sizes[::-1]:
            n = self.left[size]
            while n:
                i = bisect_left(rooms, size)
                if i == len(rooms):
                    put(self.capacity, math.ceil(n / (self.capacity // size)), [])
                    i = len(rooms) - 1
                room = rooms[i]
                times, what = by_room[room].pop()
                if not by_room[room]:
                    del by_room[room], rooms[i]
                each = min(room // size, n)
                full = min(times, n // each)
                if times > full:
                    put(room, times - full, what)
                put(room - each * size, full, [*what, (size, each)])
                n -= full * each
        return [g for groups in by_room.values() for g in groups if g[1]]

    def places(self) -> dict[str, np.ndarray]:
        """Sorted by (length, first rank): where the pieces of a length from that rank on go."""
        rows, used, base = [], {}, 0
        for times, what in self.groups:
            at = 0
            for size, each in what:
                rows.append((size, used.get(size, 0), base, each, at))
                used[size] = used.get(size, 0) + each * times
                at += size * each
            base += times
        a = np.array(sorted(rows), np.int64).reshape(-1, 5)
        return {"length": a[:, 0], "rank": a[:, 1], "base": a[:, 2], "each": a[:, 3], "at": a[:, 4]}


def pack(df: DataFrame, tokenizer: str, capacity: int = 2048, id_col: str = "doc_id", text_col: str = "text", end_id: int = 0, with_ids: bool = True) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset and, if wanted, ids of each piece of each document.

    A null or empty text is one piece that holds end_id alone; null ids and repeated rows are packed like any
    other; an empty table gives an empty one; other columns are not read. Equal lengths take their
    places in the order of a hash of id and piece.
    """
    scratch = Scratch(df.sparkSession)
    cut = scratch.save(pieces(df, tokenizer, capacity, id_col, text_col, end_id, with_ids), "pieces")
    counts = {int(r["length"]): int(r["n"]) for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most `capacity` rows
    n_buckets = max(1, math.ceil(sum(counts.values()) / RANKED_TOGETHER))
    places = Plan(counts, capacity).places()
    order = F.xxhash64("doc_id", "piece")
    keyed = cut.withColumns({"bucket": F.pmod(order, F.lit(n_buckets)), "order": order})
    sums = keyed.groupBy("length", "bucket").agg(F.count("*").alias("n")).withColumn("before", F.sum("n").over(W.Window.partitionBy("length").orderBy("bucket").rowsBetween(W.Window.unboundedPreceding, -1)))
    own = F.row_number().over(W.Window.partitionBy("length", "bucket").orderBy("order", "doc_id", "piece", "ids_crc32")) - 1
    ranked = keyed.withColumn("rank", own).join(sums.select("length", "bucket", F.coalesce("before", F.lit(0)).alias("before")), ["length", "bucket"])
    ranked = ranked.withColumn("rank", F.col("rank") + F.col("before")).select(*cut.columns, "rank")
    return placed(ranked, places)


def placed(ranked: DataFrame, places: dict[str, np.ndarray]) -> DataFrame:
    """Adds sequence_id and offset. places has of the order of `capacity` rows, whatever the corpus."""
    at = F.struct("length", "rank")
    kinds = "struct<sequence_id: bigint, offset: bigint>"

    @F.pandas_udf(kinds)
    def find(s):
        import pandas as pd

        key = places["length"] * (1 << 42) + places["rank"]
        i = np.searchsorted(key, s["length"].to_numpy() * (1 << 42) + s["rank"].to_numpy(), "right") - 1
        k = s["rank"].to_numpy() - places["rank"][i]
        return pd.DataFrame({"sequence_id": places["base"][i] + k // places["each"][i], "offset": places["at"][i] + k % places["each"][i] * places["length"][i]})

    out = ranked.withColumn("place", find(at))
    return out.select(*[c for c in ranked.columns if c != "rank"], "place.sequence_id", "place.offset")
