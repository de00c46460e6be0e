"""Validation as a contract: every rule of a page type becomes a Column, all errors of a row are collected.

Payloads are JSON objects. A field's JSON type decides what it may become, so that a number is never taken
for text. Order: normalizers, then types and bounds, then rules on the value, which a field that
has failed already skips.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.functions import text
from granary.schema import RECORDS, Field

TRUE, FALSE = ("true", "t", "yes", "y", "on", "1"), ("false", "f", "no", "n", "off", "0")


def error(field: str, code: str, message: str | Column) -> Column:
    return F.struct(F.lit(field).alias("field"), F.lit(code).alias("code"), (F.lit(message) if isinstance(message, str) else message).alias("message"))


def escaped(c: Column) -> Column:
    """c with all but printable ASCII percent-encoded as UTF-8."""
    parts = F.transform(F.split(c, ""), lambda x: F.when(x.rlike(r"\A[\x21-\x7e]\z"), x).otherwise(F.regexp_replace(F.hex(F.encode(x, "UTF-8")), "(..)", "%$1")))
    return F.array_join(parts, "")


def ascii_host(host: Column) -> Column:
    """A host name with its labels in Punycode, by the JVM's own conversion; null where a label has none."""
    return F.try_reflect(F.lit("java.net.IDN"), F.lit("toASCII"), host)


def web_url(c: Column) -> Column:
    """An http or https URL with its host in lower case and ASCII, no default port and a path, percent-encoded; null where it is none."""
    c = F.trim(c)
    scheme = F.lower(F.regexp_extract(c, r"(?i)\A(https?)://", 1))
    host = F.lower(F.regexp_extract(c, r"(?i)\Ahttps?://([^/?#\s]+)", 1))
    host = F.when(scheme == "http", F.regexp_replace(host, r":80\z", "")).otherwise(F.regexp_replace(host, r":443\z", ""))
    rest = F.regexp_extract(c, r"(?is)\Ahttps?://[^/?#\s]+(.*)\z", 1)
    path = F.when(rest.startswith("/"), rest).otherwise(F.concat(F.lit("/"), rest))
    port = F.regexp_extract(host, r":(\d*)\z", 1)
    good = (F.length(port) <= 5) & (F.coalesce(port.try_cast("int"), F.lit(0)) <= 65535) & ~host.rlike(r":[^\d\]]+\z")
    plain = host.rlike(r"\A[\x21-\x7e]*\z") & path.rlike(r"\A[\x21-\x7e]*\z")
    whole = F.concat(scheme, F.lit("://"), F.when(host.rlike(r"[^\x21-\x7e]"), ascii_host(host)).otherwise(host), F.when(path.rlike(r"[^\x21-\x7e]"), escaped(path)).otherwise(path))
    return F.when((scheme != "") & (host != "") & good & ~c.rlike(r"\A\S*[\r\n\t]"), F.when(plain, F.concat(scheme, F.lit("://"), host, path)).otherwise(whole))


def _json_type(v: Column) -> Column:
    """string, number, boolean, array, object; null of an absent field and of a JSON null."""
    kind = F.schema_of_variant(v)
    return (
        F.when(v.isNull() | (kind == "VOID"), F.lit(None).cast("string"))
        .when(kind == "STRING", "string").when(kind == "BOOLEAN", "boolean").when(kind.startswith("ARRAY"), "array").when(kind.startswith("OBJECT"), "object").otherwise("number")
    )


def _typed(f: Field, kind: Column, s: Column) -> Column:
    """A present field's value in its type; null where it is of another."""
    is_text = kind == "string"
    if f.kind == "str":
        return F.when(is_text, BEFORE[f.before](s) if f.before else s)
    if f.kind == "url":
        return web_url(F.when(is_text, s))
    if f.kind == "int":
        number = F.when(kind.isin("number", "string"), s.try_cast("decimal(38,9)")).when(kind == "boolean", F.when(s == "true", 1).otherwise(0).cast("decimal(38,9)"))
        return F.when(number == F.floor(number), number.try_cast("int"))
    if f.kind == "bool":
        low = F.lower(F.regexp_replace(s, r"\.0+\z", ""))
        return F.when(kind.isin("boolean", "number", "string"), F.when(low.isin(*TRUE), True).when(low.isin(*FALSE), False))
    if f.kind == "decimal":
        return F.when(kind.isin("number", "string"), s.try_cast("decimal(38,18)"))
    return text.date_value(F.when(kind.isin("number", "string"), s))


def placeholder_rule(f: Field, value: Column, ok: Column) -> Column:
    marker = text.placeholder(value)
    return F.when(ok & marker.isNotNull(), error(f.name, "placeholder", F.concat(F.lit(f"{f.name} looks like placeholder/error: "), marker)))


def positive_rule(f: Field, value: Column, ok: Column) -> Column:
    return F.when(value <= 0, error(f.name, "not_positive", f"{f.name} must be > 0 if present"))


#: Validators that a Field names: what a text is read as before its rules, and an error (or null) after them, of the field, its value
#: and whether it has passed. Both grow by register().
BEFORE: dict[str, Callable[[Column], Column]] = {"language": text.language_code}
AFTER: dict[str, Callable[[Field, Column, Column], Column]] = {"placeholder": placeholder_rule, "positive": positive_rule}


def register(name: str, before: Callable[[Column], Column] | None = None, after: Callable[[Field, Column, Column], Column] | None = None) -> None:
    """Makes a validator known under a name that Fields can have in `before` or `after`."""
    for table, f in ((BEFORE, before), (AFTER, after)):
        if f is not None:
            if name in table:
                raise ValueError(f"validator {name!r} is there already")
            table[name] = f


def _rules(f: Field, value: Column) -> list[Column]:
    """Errors of a value that has its type. The last rule skips a value that has failed before."""
    out, ok = [], value.isNotNull()
    bound = F.length(value) if f.kind == "str" else value
    few, many = ("string_too_short", "string_too_long") if f.kind == "str" else ("too_small", "too_large")
    for limit, bad, code, words in ((f.low, bound < F.lit(f.low), few, "at least"), (f.high, bound > F.lit(f.high), many, "at most")):
        if limit is not None:
            out.append(F.when(bad, error(f.name, code, f"{words} {limit}" + " characters" * (f.kind == "str"))))
            ok = ok & ~bad
    if f.pattern:
        out.append(F.when(~value.rlike(f.pattern), error(f.name, "pattern_mismatch", "does not match the pattern")))
    if f.after:
        out.append(AFTER[f.after](f, value, ok))
    return out


def validate(df: DataFrame, page_type: str, payload: str = "payload", fields: tuple[Field, ...] | None = None) -> DataFrame:
    """df with record (the declared fields, typed; unknown keys dropped) and errors (empty where the record is valid).

    A payload that is null or no JSON object misses all its required fields. An unknown page type raises KeyError. `fields`: others than
    the page type's.
    The steps are columns of their own, so that each is evaluated once: the JSON, its fields, their types, their values.
    """
    fields = RECORDS[page_type] if fields is None else fields
    out = df.withColumn("_doc", F.try_parse_json(payload))
    get = lambda f, kind: F.try_variant_get("_doc", f"$.{f.name}", kind)
    out = out.withColumns({f"_v_{f.name}": get(f, "variant") for f in fields})
    out = out.withColumns({f"_k_{f.name}": _json_type(F.col(f"_v_{f.name}")) for f in fields} | {f"_s_{f.name}": get(f, "array<variant>" if f.kind == "list" else "string") for f in fields})
    values = {}
    for f in fields:
        kind, s = F.col(f"_k_{f.name}"), F.col(f"_s_{f.name}")
        if f.kind == "list":
            texts = F.forall(s, lambda x: F.coalesce(_json_type(x) == "string", F.lit(False)))
            found = F.when((kind == "array") & texts, F.transform(s, lambda x: F.variant_get(x, "$", "string")))
            values[f"_t_{f.name}"] = F.when(F.col(f"_v_{f.name}").isNull(), F.array().cast("array<string>")).otherwise(found)
        else:
            values[f"_t_{f.name}"] = _typed(f, kind, s)
    out = out.withColumns(values)
    errors = []
    for f in fields:
        kind, value = F.col(f"_k_{f.name}"), F.col(f"_t_{f.name}")
        present = kind.isNotNull()
        if f.before == "date":
            present = present & ~F.coalesce((kind == "string") & (F.trim(F.col(f"_s_{f.name}")) == ""), F.lit(False))
        if f.kind == "list":  # a missing list has its default; a JSON null is no list
            errors.append(F.when(value.isNull(), error(f.name, "list_type", "is no valid list")))
            continue
        errors.append(F.when(present & value.isNull(), error(f.name, f"{f.kind}_type", f"is no valid {f.kind}")))
        if f.required:
            errors.append(F.when(~present, error(f.name, "missing", "is required")))
        errors += _rules(f, value)
    out = out.withColumns({
        "record": F.struct(*[F.col(f"_t_{f.name}").alias(f.name) for f in fields]),
        "errors": F.filter(F.array(*errors), lambda e: e.isNotNull()),
        # a decimal is written as it was given: its digits are part of it
        "record_json": F.to_json(F.struct(*[(F.when(F.col(f"_t_{f.name}").isNotNull(), F.trim(F.col(f"_s_{f.name}"))) if f.kind == "decimal" else F.col(f"_t_{f.name}")).alias(f.name) for f in fields]), {"ignoreNullFields": "false"}),
    })
    return out.drop("_doc", *[f"_{k}_{f.name}" for f in fields for k in "vkst"])


def valid(df: DataFrame) -> DataFrame:
    return df.where(F.size("errors") == 0)


def source_config_errors(df: DataFrame) -> DataFrame:
    """An allow-list with the errors of each row."""
    c = F.col
    rules = [
        F.when(F.coalesce(F.length("domain"), F.lit(0)) < 1, error("domain", "missing", "is required")),
        F.when(F.coalesce(F.length("added_by"), F.lit(0)) < 1, error("added_by", "missing", "is required")),
        F.when(c("reviewed_at").isNull(), error("reviewed_at", "date_type", "is no valid date")),
        F.when(F.coalesce(F.length("legal_basis"), F.lit(0)) < 10, error("legal_basis", "string_too_short", "at least 10 characters")),
        F.when(~F.coalesce((c("rate_limit_rps") > 0) & (c("rate_limit_rps") <= 10), F.lit(False)), error("rate_limit_rps", "out_of_range", "above 0 and at most 10")),
        F.when(~F.coalesce(c("adapter").rlike(r"\Asrc/sources/[a-z][a-z0-9_]*\.py\z"), F.lit(False)), error("adapter", "pattern_mismatch", "does not match the pattern")),
        F.when(c("api_available").isNull(), error("api_available", "missing", "is required")),
    ]
    return df.withColumn("errors", F.filter(F.array(*rules), lambda e: e.isNotNull()))
