"""Quality rules: word rules, and perplexity bands of a character n-gram model per language.

A 4-gram of characters (16 bits each: code points as they are, lower case; what lies beyond U+FFFF shares 2,048 codes) is
one 64-bit number, whose upper bits are its context and whose lower bits its suffix. Spark counts the
4-grams of all documents, halved by a hash of the text, and works out modified Kneser-Ney probabilities order by order with
aggregations and joins, for each half by itself: each text is scored by the model of the other half, so that no text is
scored by what it taught. The model has as many rows as the corpus has distinct 4-grams. Tasks that score look
4-grams up in arrays sorted by number; a model beyond MODEL_ROWS is joined instead of sent to them.

Both bands are the median log perplexity of the language's documents that pass the word rules, plus or minus
a multiple of their median absolute deviation.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from granary.llm.common import Scratch, by_position, mix, shingle_hashes, small_batches, texts, unused, word_hashes, word_spans

ORDER, BITS = 4, 16
#: Widths of the bands in median absolute deviations, and the bins of log perplexities, whose width a band has at
#: least. On half of the labelled documents, the narrowest whole widths that each lose at most 1 % of the good ones.
BAND_LOW, BAND_HIGH, BIN = 6.0, 7.0, 0.001
#: The fewer documents of a language pass the word rules, the less their median says: with so many, its bands reach one nat farther, with
#: a tenth of them a hundred, with ten times as many a hundredth.
FEW_DOCUMENTS = 20
#: A model of more 4-grams (24 bytes each) is not sent to the tasks.
MODEL_ROWS = 1 << 22
#: 4-grams that a counting task holds at most, before and after they are counted.
PENDING, HELD = 1 << 22, 1 << 21

_TABLE: list[np.ndarray] = []


def symbols(text: bytes) -> np.ndarray:
    """A 16-bit code of each character: lower case, white space and controls as a space, digits as 0."""
    if not _TABLE:
        table = np.arange(1 << 16, dtype=np.uint64)
        for i in range(1 << 16):
            c = chr(i)
            if 0xD800 <= i < 0xE000:
                continue
            table[i] = 32 if i < 32 or c.isspace() else 48 if c.isdecimal() else min(ord(c.lower()[0]), 0xFFFF)
        _TABLE.append(table)
    cp = np.frombuffer(text.decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    if len(cp) and cp.max() > 0xFFFF:
        cp = np.where(cp > 0xFFFF, 0xD800 + cp % 2048, cp)
    return _TABLE[0][cp]


def ngrams(text: bytes) -> np.ndarray:
    """The 4-gram that ends at each character; spaces come before the text."""
    s = np.concatenate([np.full(ORDER - 1, 32, np.uint64), symbols(text)])
    n = len(s) - ORDER + 1
    out = s[:n].copy()
    for k in range(1, ORDER):
        out <<= np.uint64(BITS)
        out |= s[k : k + n]
    return out


def half(text: bytes) -> int:
    """Which half of the corpus a text is in; equal texts are in the same."""
    import xxhash

    return xxhash.xxh3_64_intdigest(text) & 1


def language(lang: Column) -> Column:
    """A language's key: null is a language, too, and not the same as an empty one."""
    return F.coalesce(F.concat(F.lit("="), lang.cast("string")), F.lit(""))


def count_ngrams(df: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    """lang (its key), gram, n0, n1: how often each half has it. Each task counts its own before the shuffle."""
    small_batches(df.sparkSession)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        pending: dict[tuple[str, int], list[np.ndarray]] = {}
        counts: dict[tuple[str, int], tuple[np.ndarray, np.ndarray]] = {}
        waiting = 0

        def settle() -> None:
            for key, parts in pending.items():
                grams, n = np.unique(np.concatenate(parts), return_counts=True)
                if key in counts:
                    both, at = np.unique(np.concatenate([counts[key][0], grams]), return_inverse=True)
                    grams, n = both, np.bincount(at, np.concatenate([counts[key][1], n])).astype(np.int64)
                counts[key] = grams, n
            pending.clear()

        def out() -> Iterator:
            for (lang, side), (grams, n) in counts.items():
                yield pa.RecordBatch.from_arrays([pa.array([lang], pa.string()).take(pa.array(np.zeros(len(grams), np.int32))), pa.array(np.full(len(grams), side), pa.int32()), pa.array(grams.view(np.int64)), pa.array(n.astype(np.int64))], ["lang", "side", "gram", "n"])
            counts.clear()

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), texts(batch)):
                if text:
                    own = ngrams(text)
                    pending.setdefault((lang, half(text)), []).append(own)
                    waiting += len(own)
                    if waiting > PENDING:
                        settle()
                        waiting = 0
                        if sum(len(g) for g, _ in counts.values()) > HELD:
                            yield from out()
        settle()
        yield from out()

    found = df.select(language(df[lang_col]), df[text_col]).mapInArrow(run, "lang string, side int, gram long, n long")
    of = lambda k: F.sum(F.when(F.col("side") == k, F.col("n")).otherwise(0))
    return found.groupBy("lang", "gram").agg(of(0).alias("n0"), of(1).alias("n1"))


def discounts(level: DataFrame) -> DataFrame:
    """lang, and for each half the three discounts, for n-grams counted once, twice and more often, from the counts of counts."""
    times = [F.count_if(F.col(f"n{h}") == k).cast("double").alias(f"t{h}{k}") for h in (0, 1) for k in (1, 2, 3, 4)]
    out = level.groupBy("lang").agg(*times)
    made = []
    for h in (0, 1):
        t = {k: F.col(f"t{h}{k}") for k in (1, 2, 3, 4)}
        y = F.when(t[1] > 0, F.try_divide(t[1], t[1] + 2 * t[2])).otherwise(0.5)
        made += [F.when(t[k] > 0, F.least(F.greatest(k - (k + 1) * y * F.try_divide(t[k + 1], t[k]), F.lit(0.05)), F.lit(float(k)))).otherwise(0.5 * k).alias(f"d{h}{k}") for k in (1, 2, 3)]
    return out.select("lang", *made)


def suffix(gram: Column, n: int) -> Column:
    """The last n characters of an n-gram."""
    return gram.bitwiseAND(F.lit((1 << BITS * n) - 1))


def train(counts: DataFrame, scratch: Scratch) -> DataFrame:
    """lang, gram, p0, p1: the natural log of each 4-gram's probability under the model of each half, seen there or not.

    The highest order counts occurrences, the lower ones the characters that precede. The lowest interpolates with
    equal probabilities of all characters of the language.
    """
    levels = {ORDER: counts}
    for n in range(ORDER - 1, 0, -1):
        up = levels[n + 1]
        levels[n] = up.groupBy("lang", suffix(F.col("gram"), n).alias("gram")).agg(F.count_if(F.col("n0") > 0).alias("n0"), F.count_if(F.col("n1") > 0).alias("n1"))
    # four rows a language, written: its known size lets Spark broadcast it, so that no language's rows meet in one task
    less = scratch.save(functools.reduce(DataFrame.union, [discounts(rows).withColumn("order", F.lit(n)) for n, rows in levels.items()]), "discounts")
    lower = levels[1].groupBy("lang").agg((1.0 / F.count("*")).alias("q0")).select("lang", F.lit(0).cast("long").alias("low"), "q0", F.col("q0").alias("q1"))
    for n in range(1, ORDER + 1):
        context = F.shiftrightunsigned("gram", BITS) if n > 1 else F.lit(0).cast("long")
        same = W.Window.partitionBy("lang", "context")
        rows = levels[n].join(less.where(F.col("order") == n).drop("order"), "lang").withColumn("context", context)
        for h in (0, 1):
            c = F.col(f"n{h}")
            rows = rows.withColumn(f"d{h}", F.when(c == 0, 0.0).when(c == 1, F.col(f"d{h}1")).when(c == 2, F.col(f"d{h}2")).otherwise(F.col(f"d{h}3")))
        rows = rows.select("lang", "gram", (suffix(F.col("gram"), n - 1) if n > 1 else F.lit(0).cast("long")).alias("low"), *[x for h in (0, 1) for x in (f"n{h}", f"d{h}", F.sum(f"n{h}").over(same).alias(f"all{h}"), F.sum(f"d{h}").over(same).alias(f"rest{h}"))])
        rows = rows.join(lower, ["lang", "low"])
        p = lambda h: F.when(F.col(f"all{h}") > 0, (F.col(f"n{h}") - F.col(f"d{h}") + F.col(f"rest{h}") * F.col(f"q{h}")) / F.col(f"all{h}")).otherwise(F.col(f"q{h}"))
        lower = rows.select("lang", F.col("gram").alias("low"), p(0).alias("q0"), p(1).alias("q1"))
    return lower.select("lang", F.col("low").alias("gram"), F.log("q0").cast("float").alias("p0"), F.log("q1").cast("float").alias("p1"))


class Model:
    """A model as arrays sorted by a hash of the 4-gram (one-to-one: no two share one), one for each language, with the
    log probabilities under each half, and where the hashes with each leading bits begin."""

    def __init__(self, table):
        langs, hashes = table.column("lang").to_pandas(), mix(table.column("gram").to_numpy().view(np.uint64))
        logs = np.stack([table.column("p0").to_numpy(), table.column("p1").to_numpy()])
        self.arrays = {}
        for lang, rows in langs.groupby(langs).indices.items():
            order = rows[np.argsort(hashes[rows], kind="stable")]
            bits = len(order).bit_length() + 1
            count = np.bincount((hashes[order] >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)
            self.arrays[lang] = hashes[order], logs[:, order], np.uint64(64 - bits), (np.cumsum(count) - count).astype(np.int32)

    def find(self, grams: np.ndarray, lang: str) -> np.ndarray:
        """The place of each 4-gram, all of which the model has."""
        known, _, shift, first = self.arrays[lang]
        hashes = mix(grams)
        at = first[hashes >> shift]
        behind = np.flatnonzero(known[at] != hashes)
        while len(behind):
            at[behind] += 1
            behind = behind[known[at[behind]] != hashes[behind]]
        return at

    def log_perplexity(self, text: bytes, lang: str) -> float | None:
        """The mean negative log probability of a text's characters under the other half's model; none of an empty text."""
        if not text:
            return None
        return -float(self.arrays[lang][1][1 - half(text)][self.find(ngrams(text), lang)].mean(dtype=np.float64))


def word_rules(text: bytes) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    raw = np.frombuffer(text, np.uint8)
    starts, _ = word_spans(raw)
    blank = np.isin(raw, np.array([0x20, *range(0x09, 0x0E)], np.uint8))
    chars = int((((raw & 0xC0) != 0x80) & ~blank).sum())
    lines = [x for x in text.split(b"\n") if x.strip()]
    repeated = 0
    if len(starts) >= 3:
        windows = shingle_hashes(word_hashes(text), 3)
        _, back, times = np.unique(windows, return_inverse=True, return_counts=True)
        twice = np.flatnonzero(times[back] > 1)
        cover = np.zeros(len(starts), bool)
        for k in range(3):
            cover[twice + k] = True
        repeated = int(cover.sum())
    return len(starts), chars, len(text) - len(text.translate(None, b"#*$%&|<>")), len(lines) - len(set(lines)), repeated


def fails(n_words: int, n_repeat_words: int) -> bool:
    return n_words < 50 or 100 * n_repeat_words > 50 * n_words


KINDS = {"n_words": "long", "word_chars": "long", "n_symbols": "long", "n_dup_lines": "long", "n_repeat_words": "long", "base_failed": "boolean", "lang_key": "string", "log_perplexity": "double"}


def measure(df: DataFrame, carried: list[str], model: DataFrame, at: str, text_col: str, lang_col: str) -> DataFrame:
    """df's carried columns with a struct `at` of KINDS."""
    small_batches(df.sparkSession)
    sent = None
    if model.count() <= MODEL_ROWS:
        sent = df.sparkSession.sparkContext.broadcast(Model(model.toArrow()))
    if sent is None and text_col not in carried:
        return measure(df, df.columns, model, at, text_col, lang_col).select(*carried, at)
    where = len(carried)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        kinds = [pa.int64()] * 5 + [pa.bool_(), pa.string(), pa.float64()]
        for batch in batches:
            rows = []
            for lang, text in zip(batch.column(where).to_pylist(), texts(batch, where + 1)):
                rule = word_rules(text)
                rows.append((*rule, fails(rule[0], rule[4]), lang, sent.value.log_perplexity(text, lang) if sent else None))
            cols = list(zip(*rows)) or [()] * len(kinds)
            found = pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], list(KINDS))
            yield pa.RecordBatch.from_arrays([*batch.columns[:where], found], [*batch.schema.names[:where], at])

    struct = "struct<" + ", ".join(f"{n}: {k}" for n, k in KINDS.items()) + ">"
    schema = df.select(*carried, F.lit(None).cast(struct).alias(at)).schema
    out = df.select(*carried, language(F.col(lang_col)), F.col(text_col)).mapInArrow(run, schema)
    return out if sent else joined(out, model, at, text_col, lang_col)


def joined(measured: DataFrame, model: DataFrame, at: str, text_col: str, lang_col: str) -> DataFrame:
    """measured with its log perplexities by joins, for a model of any size: each distinct text's 4-grams meet their
    probabilities, and their sums meet the texts again by a 128-bit hash."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for lang, text, of in zip(batch.column(0).to_pylist(), texts(batch), batch.column(2)):
                if text:
                    grams, n = np.unique(ngrams(text), return_counts=True)
                    one = lambda x, kind: pa.array([x], kind).take(pa.array(np.zeros(len(grams), np.int32)))  # noqa: B023, E731
                    yield pa.RecordBatch.from_arrays([one(lang, pa.string()), one(of.as_py(), pa.string()), one(half(text), pa.int32()), pa.array(grams.view(np.int64)), pa.array(n, pa.int64())], ["lang", "of", "side", "gram", "n"])

    of = F.md5(F.coalesce(F.col(text_col), F.lit("")).cast("binary"))
    distinct = measured.select(language(F.col(lang_col)).alias("lang"), F.col(text_col).alias("text"), of.alias("of")).dropDuplicates(["lang", "of"])
    grams = distinct.mapInArrow(run, "lang string, of string, side int, gram long, n long")
    scored = grams.join(model, ["lang", "gram"]).groupBy("lang", "of").agg((-F.sum(F.col("n") * F.when(F.col("side") == 0, F.col("p1")).otherwise(F.col("p0")).cast("double")) / F.sum("n")).alias("value"))
    keys, value = unused(measured, "key"), unused(measured, "value")
    scored = scored.select(F.struct("lang", "of").alias(keys), F.col("value").alias(value))
    full = measured.withColumn(keys, F.struct(language(F.col(lang_col)).alias("lang"), of.alias("of"))).join(scored, keys, "left")
    return full.withColumn(at, F.col(at).withField("log_perplexity", F.col(value))).drop(keys, value)


def bands(measured: DataFrame, at: str) -> DataFrame:
    """lang_key, low, high of each language. Medians are of whole bins, so that they are the same in any order."""
    low, high = F.col("cum") - F.col("n"), F.col("cum")

    def middle(bins: DataFrame, name: str) -> DataFrame:
        by = W.Window.partitionBy("lang_key")
        cum = bins.withColumn("cum", F.sum("n").over(by.orderBy("bin").rowsBetween(W.Window.unboundedPreceding, 0))).withColumn("total", F.sum("n").over(by))
        return cum.where((2 * low < F.col("total")) & (2 * high >= F.col("total"))).select("lang_key", F.col("bin").alias(name), "total")

    values = measured.where(~F.col(f"{at}.base_failed") & F.col(f"{at}.log_perplexity").isNotNull()).select(f"{at}.lang_key", F.floor(F.col(f"{at}.log_perplexity") / BIN).cast("long").alias("bin"))
    bins = values.groupBy("lang_key", "bin").agg(F.count("*").alias("n"))
    center = middle(bins, "center")
    spread = bins.join(center.drop("total"), "lang_key").groupBy("lang_key", F.abs(F.col("bin") - F.col("center")).alias("bin")).agg(F.sum("n").alias("n"))
    both = center.join(middle(spread, "spread").drop("total"), "lang_key")
    unsure = F.pow(F.lit(FEW_DOCUMENTS) / F.col("total"), F.lit(2.0))
    width = lambda x: F.greatest(F.col("spread") * x, F.lit(1.0)) * BIN + unsure
    at_center = (F.col("center") + 0.5) * BIN
    return both.select("lang_key", (at_center - width(BAND_LOW)).alias("low"), (at_center + width(BAND_HIGH)).alias("high"))


def judged(df: DataFrame, carried: list[str], text_col: str, lang_col: str) -> tuple[DataFrame, str, str]:
    """df's carried columns with a struct of KINDS and a boolean, whether the row is kept; their names."""
    scratch, at, kept = Scratch(df.sparkSession), unused(df, "quality"), unused(df, "kept")
    counts = scratch.save(count_ngrams(df, text_col, lang_col), "ngrams")
    model = scratch.save(train(counts, scratch), "model")
    scratch.drop("ngrams")
    measured = scratch.save(measure(df, carried, model, at, text_col, lang_col), "measured")
    limits = bands(measured, at).select(F.struct("low", "high").alias(unused(measured, "limits")), F.col("lang_key").alias(unused(measured, "language")))
    band, lang = limits.columns
    limits = scratch.save(limits, "bands")  # written: see train()
    full = measured.join(limits, F.col(f"{at}.lang_key") == F.col(lang), "left")
    inside = F.col(f"{at}.log_perplexity").between(F.col(f"{band}.low"), F.col(f"{band}.high"))
    verdict = ~F.col(f"{at}.base_failed") & F.coalesce(inside, F.lit(True))  # no model, no verdict
    return full.withColumn(kept, verdict).drop(band, lang), at, kept


def quality(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The word counts, base_failed, log_perplexity and kept of each row.

    A null or empty text has no words and fails. Null languages are a language; the fewer documents of one pass the word rules,
    the wider its bands; null ids and repeated rows are rows like others; an empty table gives an empty one.
    Other columns are not read. kept: base_failed is false and the log perplexity is within the language's bands.
    """
    plain, (ident, text, lang) = by_position(df, id_col, text_col, lang_col)
    narrow = plain.select(F.col(ident).alias("id"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    slim = judged(narrow, ["id"], "text", "lang")
    return slim[0].select(F.col("id").alias(id_col), f"{slim[1]}.*", F.col(slim[2]).alias("kept"))


def keep_good(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of df that quality() keeps, with all columns as they are. Rows are judged as there: null and empty texts go, null ids
    and languages, repeated rows and columns of any name and type stay as they are, and an empty table gives an empty one."""
    plain, (_, text, lang) = by_position(df, id_col, text_col, lang_col)
    full, _, kept = judged(plain, plain.columns, text, lang)
    return full.where(F.col(kept)).select(*plain.columns).toDF(*df.columns)
