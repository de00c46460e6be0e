import json

import pytest

from pyspark.sql import functions as F

from granary.functions.validate import validate, web_url

BASE = {"source": "s", "source_url": "HTTPS://Example.COM:443", "source_id": "1"}
GOOD = {
    "article": {"title": "t", "body_md": "long enough", "language": "English"}, "docs": {"title": "t", "body_md": "long enough", "code_block_count": "3"},
    "product": {"name": "n", "in_stock": "yes"}, "reference": {"term": "t", "definition": "long enough"},
}


def check(spark, cases):
    """(record, errors) of each (page type, changes to a good record); ... removes a field. One validation per page type."""
    out = {}
    for t in {t for t, _ in cases}:
        rows = [(k, json.dumps({f: v for f, v in (BASE | GOOD[t] | over).items() if v is not ...})) for k, (kind, over) in enumerate(cases) if kind == t]
        for r in validate(spark.createDataFrame(rows, "k int, payload string"), t).collect():
            out[r.k] = (r.record, sorted(f"{e.field}:{e.code}" for e in r.errors))
    return [out[k] for k in range(len(cases))]


def test_good_records(spark):
    got = dict(zip(GOOD, check(spark, [(t, {"extra": "dropped"}) for t in GOOD])))
    for record, errors in got.values():
        assert errors == [] and record.source_url == "https://example.com/" and "extra" not in record
    assert got["article"][0].language == "en" and got["docs"][0].code_block_count == 3
    assert got["docs"][0].section_path == [] and got["product"][0].in_stock is True


def test_bad_records(spark):
    cases = [
        ("article", {"title": ""}, ["title:string_too_short"]), ("article", {"title": "x" * 501}, ["title:string_too_long"]), ("article", {"title": "x" * 500}, []), ("article", {"title": 5}, ["title:str_type"]),
        ("article", {"title": None}, ["title:missing"]), ("article", {"body_md": "short"}, ["body_md:string_too_short"]), ("article", {"body_md": "lorem ipsum dolor"}, ["body_md:placeholder"]),
        ("article", {"language": "en\n\n1"}, ["language:pattern_mismatch"]), ("article", {"published_at": "15/03/2026"}, ["published_at:datetime_type"]), ("article", {"published_at": " "}, []),
        ("article", {"source_url": "ftp://x/y"}, ["source_url:url_type"]), ("article", {"title": ..., "language": ...}, ["language:missing", "title:missing"]),
        ("docs", {"code_block_count": 3.5}, ["code_block_count:int_type"]), ("docs", {"code_block_count": True}, []), ("docs", {"code_block_count": -1}, ["code_block_count:too_small"]), ("docs", {"section_path": None}, ["section_path:list_type"]),
        ("docs", {"section_path": ["a", 1]}, ["section_path:list_type"]), ("docs", {"section_path": ["a"]}, []), ("product", {"price": 0}, ["price:not_positive"]), ("product", {"price": "29.90"}, []), ("product", {"price": True}, ["price:decimal_type"]),
        ("product", {"in_stock": "in stock"}, ["in_stock:bool_type"]), ("product", {"in_stock": 2}, ["in_stock:bool_type"]), ("product", {"in_stock": 1.0}, []), ("product", {"currency": "usd"}, ["currency:pattern_mismatch"]), ("product", {"description": None}, []),
        ("product", {"description": "Access denied"}, ["description:placeholder"]), ("reference", {"examples": "x"}, ["examples:list_type"]),
    ]
    for (t, over, want), (_, errors) in zip(cases, check(spark, [c[:2] for c in cases])):
        assert errors == want, (t, over)




def test_web_urls(spark):
    want = {
        "https://é.com/a b": "https://xn--9ca.com/a%20b", " HTTP://A.B:80 ": "http://a.b/", "https://a.b:443?q=ü": "https://a.b/?q=%C3%BC", "https://a.b:8443/x": "https://a.b:8443/x",
        "https://a.b:99999/": None, "ftp://a.b/": None, "https://": None, "https://a.b:x/": None, "no url": None, None: None, "https://a.b/日": "https://a.b/%E6%97%A5",
    }
    df = spark.createDataFrame([(k,) for k in want], "u string")
    assert {r.u: r.v for r in df.select("u", web_url(F.col("u")).alias("v")).collect()} == want


def test_decimals_keep_their_digits(spark):
    rows = [(p,) for p in ('"29.90"', "149", '"149.00"', "null", '"x"')]
    df = spark.createDataFrame(rows, "p string").withColumn("payload", F.concat(F.lit('{"source":"s","source_url":"https://u.v","source_id":"i","name":"n","in_stock":true,"price":'), "p", F.lit("}")))
    got = {r.p: r.record_json for r in validate(df, "product").collect()}
    assert [('"price":"29.90"' in got['"29.90"']), ('"price":"149"' in got["149"]), ('"price":"149.00"' in got['"149.00"']), ('"price":null' in got["null"]), ('"price":null' in got['"x"'])] == [True] * 5


def test_registered_validators(spark):
    from granary.functions import validate as v
    from granary.schema import Field

    v.register("upper", before=lambda s: F.upper(s))
    v.register("even", after=lambda f, value, ok: F.when(ok & (value % 2 != 0), v.error(f.name, "odd", "must be even")))
    try:
        fields = (Field("code", "str", True, 1, 3, pattern=r"\A[A-Z]+\z", before="upper"), Field("n", "int", after="even"))
        rows = [('{"code": "ab", "n": 2}',), ('{"code": "ab", "n": 3}',), ('{"code": "abcd", "n": null}',), ("{}",)]
        got = v.validate(spark.createDataFrame(rows, "payload string"), "", fields=fields).collect()
        assert [[(e.field, e.code) for e in r.errors] for r in got] == [[], [("n", "odd")], [("code", "string_too_long")], [("code", "missing")]] and got[0].record.code == "AB"
        with pytest.raises(ValueError, match="there already"):
            v.register("even", after=lambda f, value, ok: value)
        assert v.AFTER.keys() >= {"placeholder", "positive"}
    finally:
        v.BEFORE.pop("upper"), v.AFTER.pop("even")


def test_soft_rules(spark):
    from granary.functions import text

    rows = [(0, "A long body with Needle", 3), (1, "short", None), (2, None, 0), (3, "needle", 2)]
    df = spark.createDataFrame(rows, "k int, body string, blocks int")
    rules = {"body_min_length": 6, "body_must_contain": ["needle"], "blocks_min": 2}
    got = {r.k: r.failed for r in df.select("k", text.soft_failures(rules, {"body": F.col("body"), "blocks": F.col("blocks")}).alias("failed")).collect()}
    assert got == {0: [], 1: ["body_min_length", "body_must_contain", "blocks_min"], 2: ["body_min_length", "body_must_contain", "blocks_min"], 3: []}
    zero = df.select(text.soft_failures({"blocks_min": 0}, {"blocks": F.col("blocks")}).alias("failed"))
    assert all(r.failed == [] for r in zero.collect())
    with pytest.raises(ValueError, match="unknown soft rule"):
        text.soft_failures({"body_max": 1}, {"body": F.col("body")})
    one = df.limit(1).select(text.includes(F.array(F.lit("a"), F.lit("b")), F.array(F.lit("b"))).alias("yes"), text.includes(F.array(F.lit("a")), F.array(F.lit("b"))).alias("no"), text.guard_prefix(F.lit("é" * 9000)).alias("cut"), text.guard_prefix(F.lit(None).cast("string")).alias("none")).first()
    assert (one.yes, one.no, len(one.cut), one.none) == (True, False, 8000, None)
