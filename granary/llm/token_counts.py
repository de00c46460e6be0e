"""Token counts by overlap resynchronisation.

A huge text is encoded in overlapping chunks, each with token offsets. Two neighbouring chunks are
spliced at a boundary that both have and that is proven stable; where the overlap has none, it is
widened, and at last the chunk itself, so that the counts are always those of the whole text.

The proof: no piece of the vocabulary holds a space mark after another character, and nothing is
normalized away, so that no merge reaches over a place where a space follows a non-space. Left of
such a place the tokens depend on what is left of it only, and the same for the right. A vocabulary
without that property has no such places; its texts are encoded whole.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

from pyspark.sql import DataFrame

from granary.llm.common import small_batches

MARK = "▁"
#: Characters in a chunk, and by how many neighbouring chunks overlap at first.
CHUNK, OVERLAP = 1 << 15, 256


class Counter:
    """Counts a text's tokens under one SentencePiece model, without begin, end or other special tokens."""

    def __init__(self, model: str, chunk: int = CHUNK, overlap: int = OVERLAP):
        import sentencepiece

        self.sp = sentencepiece.SentencePieceProcessor(model_file=model)
        self.chunk, self.overlap, self.widened = chunk, min(overlap, chunk // 2), 0
        self.stable = self.proven()

    def proven(self) -> bool:
        """Whether a space after a non-space is a place that no token and no merge can span."""
        pieces = [self.sp.id_to_piece(i) for i in range(self.sp.get_piece_size())]
        same = all(self.sp.decode(self.sp.encode(x)) == x for x in ("a  b", "éﬁ½ x", "A\tb", "e\u0301\u3000y"))
        return same and not any(MARK in p.lstrip(MARK) for p in pieces)

    def ends(self, text: str) -> list[int]:
        """Where each token of a chunk ends, in characters of the chunk. Non-decreasing: a character that falls
        back to bytes ends with the last of them."""
        return [end for _, end in self.sp.encode(text, return_type="offset_mapping")["offsets"]]

    @staticmethod
    def is_edge(text: str, at: int) -> bool:
        """at: between a non-space and a space (the space mark itself counts as one)."""
        return text[at] in (" ", MARK) and text[at - 1] not in (" ", MARK)

    def count(self, text: str) -> int:
        if not text:
            return 0
        if len(text) <= self.chunk or not self.stable:
            return len(self.sp.encode(text))
        return self.splice(text)

    def splice(self, text: str) -> int:
        n, size, total = len(text), self.chunk, 0
        left, end, at = 0, size, 0  # the left chunk, and the last splice: what is before it has been counted
        ends = self.ends(text[:end])
        while end < n:
            overlap = self.overlap
            while True:
                start = max(left, end - overlap)
                if start == left:  # the overlap has become the whole chunk: now the chunk grows
                    end = min(n, 2 * end - left)
                    ends, overlap = self.ends(text[left:end]), self.overlap
                    self.widened += 1
                    if end == n:
                        return total + len(ends) - self.before(ends, at - left)
                    continue
                stop = min(n, start + size + overlap)
                right = self.ends(text[start:stop])
                both = {start + x for x in right} & {left + x for x in ends[bisect_left(ends, start - left) :]}
                if spots := [p for p in both if max(start, at) < p < end and self.is_edge(text, p)]:
                    break
                overlap *= 2
                self.widened += 1
            total -= self.before(ends, at - left)
            at = max(spots)
            total += self.before(ends, at - left)
            left, end, ends = start, stop, right
        return total + len(ends) - self.before(ends, at - left)

    @staticmethod
    def before(ends: list[int], at: int) -> int:
        return bisect_right(ends, at) if at > 0 else 0


def count_tokens(df: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 4096, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit) of each row's whole text.

    A null text is empty and has no tokens; a null id stays null; repeated rows are counted each;
    an empty table gives an empty one. Other columns are not read. One row in, one row out, no shuffle.
    """
    small_batches(df.sparkSession)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        counter = Counter(model, chunk, overlap)
        for batch in batches:
            docs = [x or "" for x in batch.column(1).to_pylist()]
            counts = [0] * len(docs)
            short = [i for i, x in enumerate(docs) if 0 < len(x) <= chunk]
            for i, ids in zip(short, counter.sp.encode([docs[i] for i in short], num_threads=1) if short else []):
                counts[i] = len(ids)
            for i, x in enumerate(docs):
                if len(x) > chunk:
                    counts[i] = counter.count(x)
            sizes = [len(x.encode()) for x in docs]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(counts, pa.int64()), pa.array([x > limit for x in counts], pa.bool_())], ["id", "n_bytes", "n_tokens", "over_limit"])

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(df[id_col], df[text_col]).mapInArrow(run, f"id {kind}, n_bytes long, n_tokens long, over_limit boolean").withColumnRenamed("id", id_col)
