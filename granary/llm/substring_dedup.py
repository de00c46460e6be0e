"""Substring deduplication by content-defined chunks.

A gear rolling hash over the last 16 bytes rates every place of a text. A place is a border where its hash
is the least among the 16 places on either side, which depends on the near text only: an insertion
shifts borders only near itself, and equal passages have equal chunks inside. Chunks are deduplicated by
digest: one that stands at more than one place, of one document or of several, is kept at the first and is a repeat elsewhere. Runs of
repeated chunks of at least `min_words` words are the passages to cut.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from granary.llm.common import _BYTES, PIECE, Scratch, by_position, small_batches, span_hashes, texts, word_spans

GEAR = (_BYTES >> np.uint64(32)).astype(np.uint32)
#: Bytes that the hash covers, and places on either side that a border is compared with: chunks have 2 * REACH + 1 bytes on average.
WINDOW = REACH = 16
#: No chunk is longer.
LONGEST = 4000
#: A passage loses some 80 bytes at its ends, so that this finds passages of fifty words.
MIN_WORDS = 12


def gear(raw: np.ndarray) -> np.ndarray:
    """sum(GEAR[byte] << age) over the last WINDOW bytes at each place, by doubling."""
    h, k = GEAR[raw], 1
    while k < WINDOW:
        out = h.copy()
        out[k:] += h[:-k] << np.uint32(k)
        h, k = out, 2 * k
    return h


def borders(h: np.ndarray) -> np.ndarray:
    """Where a hash is less than the REACH before it and at most the REACH after it; outside there is nothing less."""
    low = np.concatenate([np.full(REACH, np.uint32(2**32 - 1)), h, np.full(REACH, np.uint32(2**32 - 1))])
    k = 1
    while k < REACH:  # the least of each place and the next REACH - 1
        low = np.minimum(low[:-k], low[k:])
        k *= 2
    return np.flatnonzero((h < low[: len(h)]) & (h <= low[REACH + 1 : REACH + 1 + len(h)]))


def chunk_ends(text: bytes) -> np.ndarray:
    """Where the chunks of a text end, in bytes, never within a character."""
    found, margin = [], WINDOW + REACH
    for at in range(0, len(text), PIECE):
        low, high = max(0, at - margin), min(len(text), at + PIECE + margin)
        spots = borders(gear(np.frombuffer(text, np.uint8, high - low, low))) + low
        found.append(spots[(spots >= at) & (spots < at + PIECE)] + 1)
    ends = np.concatenate([*found, [len(text)]])
    raw = np.frombuffer(text, np.uint8)
    for _ in range(3):  # out of a character: continuation bytes are 10xxxxxx
        inner = ends < len(raw)
        inner[inner] = (raw[ends[inner]] & 0xC0) == 0x80
        if not inner.any():
            break
        ends = ends + inner
    ends = np.unique(ends)
    gaps = np.diff(ends, prepend=0)
    if gaps.max(initial=0) > LONGEST:
        more = [np.arange(e - g + LONGEST, e, LONGEST) for e, g in zip(ends, gaps) if g > LONGEST]
        extra = np.concatenate(more)
        extra -= (raw[extra] & 0xC0) == 0x80  # back to the start of the character, three bytes at most
        extra -= (raw[extra] & 0xC0) == 0x80
        extra -= (raw[extra] & 0xC0) == 0x80
        ends = np.unique(np.concatenate([ends, extra]))
    return ends


def digests(text: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    raw, out, i = np.frombuffer(text, np.uint8), [], 0
    while i < len(starts):  # some MB of chunks at a time
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + PIECE)))
        out.append(span_hashes(raw[starts[i] : ends[j - 1]], starts[i:j] - starts[i], ends[i:j] - starts[i]))
        i = j
    return np.concatenate(out)


def chunks(df: DataFrame) -> DataFrame:
    """doc, of, spot, digest of each chunk of df(doc, text, of). spot holds the chunk's start in characters, whether its text has it earlier
    (1 bit), its length (13 bits) and the words that begin in it (12 bits)."""
    small_batches(df.sparkSession)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            row, spots, found = [], [], []
            for i, text in enumerate(texts(batch)):
                if not text:
                    continue
                raw, ends = np.frombuffer(text, np.uint8), chunk_ends(text)
                starts = np.concatenate([[0], ends[:-1]])
                chars = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
                begun = np.searchsorted(word_spans(raw)[0], np.concatenate([[0], ends]))
                at = chars[starts]
                row.append(np.full(len(ends), i))
                own = digests(text, starts, ends).view(np.int64)
                again = np.ones(len(own), np.int64)
                again[np.unique(own, return_index=True)[1]] = 0
                spots.append((at << 26) | (again << 25) | ((chars[ends] - at) << 12) | np.minimum(np.diff(begun), 4095))
                found.append(own)
            if row:
                at = pa.array(np.concatenate(row))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(2).take(at), pa.array(np.concatenate(spots), pa.int64()), pa.array(np.concatenate(found), pa.int64())], ["doc", "of", "spot", "digest"])

    return df.select("doc", "text", "of").mapInArrow(run, f"doc {df.schema['doc'].dataType.simpleString()}, of long, spot long, digest long")


def spans(rows: DataFrame, min_words: int, within: bool) -> DataFrame:
    """doc, of, start, end, n_words, kept_id of the passages of rows(doc, text, of) that stand earlier, too."""
    scratch = Scratch(rows.sparkSession)
    own = scratch.save(chunks(rows), "chunks")
    inside = F.expr("shiftright(spot, 25) & 1 = 1") if within else F.lit(False)
    nameless = F.when(F.col("doc").isNull(), F.col("of"))
    first = own.groupBy("digest").agg(F.min("doc").alias("kept"), F.max("doc").alias("last"), F.max(inside).alias("inside"), F.min(nameless).alias("low"), F.max(nameless).alias("high"))
    first = first.where("kept < last or inside or kept is not null and low is not null or low < high").select("digest", "kept", F.when(F.col("kept").isNull(), F.col("low")).alias("low"))
    # a merge join at every size: it splits hot chunks over tasks, and no plan depends on how small a table is
    again = own.join(first.hint("merge"), "digest").where((F.col("doc") > F.col("kept")) | F.col("doc").isNull() & (F.col("kept").isNotNull() | (F.col("of") > F.col("low"))) | inside)
    again = again.select("doc", "of", F.expr("shiftright(spot, 26)").alias("start"), F.expr("shiftright(spot, 12) & 8191").alias("length"), F.expr("spot & 4095").alias("words"), "kept")
    again = scratch.save(again.withColumn("stop", F.col("start") + F.col("length")).drop("length"), "again")
    scratch.drop("chunks")
    by_doc = W.Window.partitionBy("doc", "of").orderBy("start")
    earlier = F.max("stop").over(by_doc.rowsBetween(W.Window.unboundedPreceding, -1))
    runs = again.withColumns({"begins": F.coalesce(F.col("start") > earlier, F.lit(True)), "twin": F.coalesce(F.lag("start").over(by_doc) == F.col("start"), F.lit(False))})
    runs = runs.withColumn("run", F.sum(F.col("begins").cast("long")).over(by_doc.rowsBetween(W.Window.unboundedPreceding, 0)))
    found = runs.groupBy("doc", "of", "run").agg(F.min("start").alias("start"), F.max("stop").alias("end"), F.sum(F.when(F.col("twin"), 0).otherwise(F.col("words"))).cast("long").alias("n_words"), F.min(F.struct("start", "kept"))["kept"].alias("kept_id"))
    return found.where(F.col("n_words") >= min_words).drop("run")


def identified(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """df's columns by position, and doc, text, of: a document is its id, or where that is null a hash of its text."""
    plain, (ident, text) = by_position(df, id_col, text_col)
    return plain.select("*", F.col(ident).alias("doc"), F.col(text).alias("text"), F.when(F.col(ident).isNull(), F.xxhash64(text)).alias("of"))


def repeated_spans(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS, within: bool = True) -> DataFrame:
    """id, start, end (characters), n_words, kept_id of each passage that an earlier document (by id, null last) has, too, or, unless
    `within` is false, an earlier part of the same document.

    A passage begins and ends at chunk borders: up to a chunk on either side of the common text is not in it. n_words: words
    that begin in it. kept_id: the document that keeps the passage's first chunk. Null and empty texts have no chunks. Rows that
    repeat an id are one document, as are rows without an id that have the same text; a repeat inside one is looked for in each row's
    text. An empty table gives an empty one. Other columns are not read.
    """
    found = spans(identified(df, id_col, text_col), min_words, within)
    return found.select(F.col("doc").alias(id_col), "start", "end", "n_words", "kept_id")


def cut_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS, within: bool = True) -> DataFrame:
    """df with repeated passages cut out of its texts. All other columns stay, whatever their names and types. Null and empty texts stay as
    they are; rows that repeat an id are cut alike; an empty table gives an empty one."""
    rows = identified(df, id_col, text_col)
    *names, _, _, _ = rows.columns
    _, (target,) = by_position(df, text_col)
    found = spans(rows, min_words, within)
    cuts = found.groupBy(F.col("doc").alias("of_doc"), F.col("of").alias("of_text")).agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("cuts"))  # of one document
    part = lambda a, n: F.substring("text", (a + 1).cast("int"), n.cast("int"))
    step = lambda a, c: F.struct(F.concat(a["text"], part(a["at"], c["start"] - a["at"])).alias("text"), c["end"].alias("at"))
    kept = F.aggregate("cuts", F.struct(F.lit("").alias("text"), F.lit(0).cast("long").alias("at")), step, lambda a: F.concat(a["text"], part(a["at"], F.length("text"))))
    joined = rows.join(cuts, F.col("doc").eqNullSafe(F.col("of_doc")) & F.col("of").eqNullSafe(F.col("of_text")), "left")
    joined = joined.withColumn(target, F.when(F.col("cuts").isNull(), F.col("text")).otherwise(kept))
    return joined.select(*names).toDF(*df.columns)
