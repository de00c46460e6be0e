"""The pipeline stage by stage on the smallest tables."""

import os
import re

import pytest

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages(spark, tmp_path):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [docs]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, rows[-1], SF).write.parquet(str(tmp_path / str(k)))
        rows.append(spark.read.parquet(str(tmp_path / str(k))))
    start, good, single, clean, mixed, packed = rows
    assert all(r.columns == COLUMNS for r in rows[:-1])
    text = lambda df: {r.doc_id: r.text for r in df.collect()}
    assert 0 < len(text(good)) < len(text(start)) and text(good).items() <= text(start).items()
    shingles = {i: {tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))} for i, t in text(single).items() for w in [re.findall(r"[^\x20\x09-\x0D]+", t)]}
    ids = sorted(shingles)
    assert not any(len(shingles[a] & shingles[b]) >= 0.8 * len(shingles[a] | shingles[b]) for a in ids for b in ids if a < b)
    assert set(text(clean)) == set(text(single)) and not any(re.search(r"AKIA[A-Z0-9]{16,}|[0-9a-f]{24,}", t) for t in text(clean).values())
    assert all(r.n_chars == len(r.text) for r in clean.collect())
    counts = {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert set(counts) <= set(ids) and max(counts.values()) <= 3
    assert {r.doc_id for r in packed.collect()} == set(counts) and packed.where("piece = 0").count() == sum(counts.values())


def test_run(spark):
    import corpus_pipeline

    assert corpus_pipeline.run(spark, SF).count() > 0


def test_run_on_odd_and_empty_tables(spark, tmp_path):
    """Null ids, texts, languages and sources, blank and very long texts, repeated rows, and columns that clash with those of the stages."""
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    known = {r.text for r in docs.collect()}
    odd = docs.limit(3).selectExpr("cast(null as long) doc_id", "text", "cast(null as string) lang", "cast(null as string) source", "n_chars")
    blank = docs.limit(4).selectExpr("doc_id + 900000 doc_id", "array(null, '', '   ', 'one')[doc_id % 4] text", "lang", "source", "cast(null as long) n_chars")
    long = docs.limit(1).selectExpr("cast(990000 as long) doc_id", "array_join(transform(sequence(1, 60000), x -> concat('wort', x * 7919 % 10007)), ' ') text", "'de' lang", "source", "n_chars")
    for name, df in (("odd", docs.unionByName(odd).unionByName(blank).unionByName(long).unionByName(docs.limit(5))), ("empty", docs.limit(0))):
        extra = df.selectExpr("*", "1 as _size", "'x' as _key", "2 as quality", "3 as length", "4 as kept", "5 as _text", "6 as piece")
        extra.write.parquet(str(tmp_path / name / "documents.parquet"))
        out = corpus_pipeline.run(spark, str(tmp_path / name))
        assert {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"} <= set(out.columns)
        rows = out.collect()
        assert bool(rows) == (name == "odd")
        at = {}
        for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
            assert r.offset == at.get(r.sequence_id, 0) and r.offset + r.length <= 2048
            at[r.sequence_id] = r.offset + r.length
    assert known
