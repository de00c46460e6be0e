"""Operators that hand on whole rows, with columns of awkward names and types: what they do with plain ones, and the others untouched."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from granary.llm import conversation_repair, filter_audit, jaccard_join, license_scan, mixing, packing, quality, secret_scan, sharding, simhash, substring_dedup, token_counts
from granary.llm.queries import PIECE_MODEL, WORD_TOKENIZER

public_tokenizers = pytest.importorskip("public_tokenizers")
AWKWARD = ["a.b", "_", "_cuts", "shard", "slot", "TEXT", "Doc_Id", "kept", "value", "c0", "`tick`", "map", "_row", "of", "point"]


@pytest.fixture(scope="module")
def plain(spark):
    rng = random.Random(3)
    rows = []
    for i in range(60):
        text = " ".join(f"w{rng.randrange(300)}" for _ in range(rng.randrange(60, 200)))
        if i % 7 == 0 and rows:
            text = rows[-1][1]
        rows.append((i, text + (" password = hunter2hunter2" if i % 5 == 0 else ""), ["en", "de"][i % 2], "abc"[i % 3], len(text)))
    rows += [(None, rows[3][1], "en", None, 1), (70, None, None, "a", 0), (71, "", "en", "b", 0), (5, *rows[5][1:])]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)


@pytest.fixture(scope="module")
def awkward(plain):
    """The same rows with more columns, one of them a map; two names differ from wanted ones in their case alone."""
    more = [F.create_map(F.lit("k"), F.col("doc_id")) if name == "map" else F.concat(F.lit(name), F.coalesce(F.col("text"), F.lit("none"))) for name in AWKWARD]
    return plain.select("*", *more).toDF(*plain.columns, *AWKWARD)


def tuples(df, n, at=0):
    """The first n values of each row behind `at`, by position."""
    return sorted((repr(tuple(r)[at : at + n]) for r in df.collect()))


def check_rows(plain_out, awkward_out, awkward):
    """Whole rows: the same documents' values, the columns in place, and what rode along still beside its document."""
    assert awkward_out.columns[: len(awkward.columns)] == awkward.columns
    assert tuples(plain_out, 5) == tuples(awkward_out, 5)
    given = {tuple(r)[5:20][1] for r in awkward.collect()}
    assert {tuple(r)[5:20][1] for r in awkward_out.collect()} <= given
    for r in awkward_out.collect():
        values = tuple(r)
        assert values[5 + AWKWARD.index("map")] == {"k": values[0]}


@pytest.mark.parametrize("apply", [quality.keep_good, secret_scan.redact, substring_dedup.cut_repeats, jaccard_join.keep_one, mixing.mixed], ids=lambda f: f.__name__)
def test_whole_rows(plain, awkward, apply):
    check_rows(apply(plain), apply(awkward), awkward)


def test_shards_keep_all_columns(plain, awkward):
    a, b = sharding.two_pass_shuffle(plain, ["doc_id"], 4), sharding.two_pass_shuffle(awkward, ["doc_id"], 4)
    check_rows(a, b, awkward)
    assert b.columns[-2:] == ["_shard", "_slot"]
    slots = sorted(tuple(r)[-2:] for r in b.collect())
    assert slots == sorted(tuple(r)[-2:] for r in a.collect())
    assert sorted(map(repr, b.collect())) == sorted(map(repr, sharding.two_pass_shuffle(awkward, ["doc_id"], 4).collect()))


def test_operators_that_read_three_columns(awkward, plain):
    model, words = public_tokenizers.path(PIECE_MODEL), public_tokenizers.path(WORD_TOKENIZER)
    few = plain
    for name in ("a.b", "_cuts", "shard", "size", "point", "of", "bucket", "key"):
        few = few.withColumn(name, F.lit(1))
    few = few.withColumn("_", F.create_map(F.lit(1), F.lit(2)))
    for f in (
        lambda d: token_counts.count_tokens(d, model), lambda d: packing.pack(d, words, with_ids=False).select("doc_id", "piece", "start", "length", "ids_crc32"), substring_dedup.repeated_spans, quality.quality, secret_scan.scan_secrets,
        license_scan.scan_licenses, jaccard_join.join_documents, simhash.near_duplicates, lambda d: filter_audit.audit(d, plain.select("doc_id", F.lit(1).alias("quality"), F.lit(0).alias("toxic"))),
        lambda d: conversation_repair.repairs(d.withColumnsRenamed({"doc_id": "conv_id", "n_chars": "turn", "lang": "role"})),
    ):
        assert sorted(map(repr, map(tuple, f(few).collect()))) == sorted(map(repr, map(tuple, f(plain).collect())))


def test_pipeline_of_awkward_tables(spark, plain, awkward, tmp_path):
    """All stages in turn; of all but the last the columns are those that it got. No table that is written has names that differ in
    their case alone."""
    at = [i for i, c in enumerate(awkward.columns) if c not in ("TEXT", "Doc_Id")]
    docs = awkward.toDF(*[f"c{i}" for i in range(len(awkward.columns))]).select(*[f"c{i}" for i in at]).toDF(*[awkward.columns[i] for i in at])
    small = plain
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out, less = stage(spark, docs, None), stage(spark, small, None)
        if k == len(corpus_pipeline.STAGES) - 1:
            assert sorted(map(str, out.select("doc_id", "piece", "length", "ids_crc32").collect())) == sorted(map(str, less.select("doc_id", "piece", "length", "ids_crc32").collect())), name
        else:
            assert out.columns == docs.columns, name
            assert tuples(out, 5) == tuples(less, 5), name
            docs, small = out, less
