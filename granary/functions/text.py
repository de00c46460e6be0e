"""Text functions as Column expressions; only nfkc() and what builds on it needs Python."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Characters, patterns and names that results depend on.
INVISIBLE = r"[\x{200B}-\x{200F}\x{2028}\x{2029}\x{202A}-\x{202E}\x{2060}-\x{206F}\x{FEFF}]"
ROLE = r"(?imdU)^\s*(system|assistant|user|developer)\s*:"
ROLE_MARK = "[neutralized-role-prefix]:"
HINT = r"(?iU)(ignore (all |previous )?instructions|disregard (the )?(above|prior)|you are now|new instructions:)"
HIDING = r"(?i)color\s*:\s*(white|transparent)|display\s*:\s*none|visibility\s*:\s*hidden|opacity\s*:\s*0\b"
PRICE = r"([€$£₽])(?U:\s*)((?U:[\d,.\s]+))|((?U:[\d,.\s]+))(?U:\s*)([€$£₽]|USD|EUR|RUB|GBP)"
CURRENCIES = {"€": "EUR", "$": "USD", "£": "GBP", "₽": "RUB"}
HARD_MARKERS = ("lorem ipsum",)
SOFT_MARKERS = ("page not found", "access denied", "404 not found", "403 forbidden", "are you a robot")
SOFT_LENGTH = 500
LANGUAGES = {
    "english": "en", "french": "fr", "german": "de", "spanish": "es", "italian": "it", "portuguese": "pt", "russian": "ru", "chinese": "zh",
    "japanese": "ja", "korean": "ko", "arabic": "ar", "dutch": "nl", "polish": "pl", "swedish": "sv", "turkish": "tr",
}
WARNINGS = {"invisible": "invisible_characters_stripped", "role": "role_prefix_neutralized", "hint": "injection_hint_detected"}


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


@F.pandas_udf(T.StringType())
def nfkc(s: pd.Series) -> pd.Series:
    return s.str.normalize("NFKC")


def strip_invisible(c: Column) -> Column:
    return F.regexp_replace(c, rf"[\x{{200B}}-\x{{FEFF}}&&{INVISIBLE}]", "")  # the range spares most characters the list


def neutralize_roles(c: Column) -> Column:
    return F.regexp_replace(c, ROLE, ROLE_MARK)


def has_hint(c: Column) -> Column:
    return c.rlike(r"(?iU)(?=[idyn])" + HINT)  # the first letters spare most places the phrases


def sanitize(c: Column, hidden: Column | None = None) -> Column:
    """struct(text, warnings) of a text that is normalized already. hidden: warnings of hidden markup, which come first.

    Null stays null. Each step's text is bound once (as the element of an array) and serves all that follows; warnings are in
    order and unique.
    """
    plain = F.array(strip_invisible(c))
    marked = F.transform(plain, lambda p: F.struct(p.alias("plain"), p.rlike(ROLE).alias("role")))
    clean = F.transform(marked, lambda x: F.struct(x["plain"].alias("plain"), x["role"].alias("role"), F.when(x["role"], neutralize_roles(x["plain"])).otherwise(x["plain"]).alias("text")))

    def outcome(x: Column) -> Column:
        own = F.array(F.when(x["plain"] != c, F.lit(WARNINGS["invisible"])), F.when(x["role"], F.lit(WARNINGS["role"])), F.when(has_hint(x["text"]), F.lit(WARNINGS["hint"])))
        own = F.filter(own, lambda w: w.isNotNull())
        warnings = own if hidden is None else F.array_distinct(F.concat(F.coalesce(hidden, F.array().cast("array<string>")), own))
        return F.struct(x["text"].alias("text"), warnings.alias("warnings"))

    return F.when(c.isNotNull(), F.get(F.transform(clean, outcome), F.lit(0)))


def first_heading(md: Column) -> Column:
    """The first Markdown heading of the first level, trimmed; null without one."""
    return blank_to_null(F.regexp_replace(F.regexp_extract(md, r"(?md)^#(?U:\s+)(.+)$", 1), r"(?U)^\s+|\s+$", ""))


def html_lang(html: Column) -> Column:
    return blank_to_null(F.regexp_extract(html, r"""(?i)<html[^>]+lang=["']([a-z]{2})["']""", 1))


def byline(md: Column) -> Column:
    return blank_to_null(F.trim(F.regexp_extract(md, r"\bBy(?U:\s+)([A-Z][a-zA-Z .'\-]{2,60})", 1)))


def code_blocks(md: Column) -> Column:
    return F.floor(F.regexp_count(md, F.lit(r"(?md)^```")) / 2).cast("int")


def price(md: Column) -> Column:
    """struct(price_text, currency) of the first price. The number keeps its digits; both are null where it is no number."""
    part = lambda k: F.regexp_extract(md, PRICE, k)
    symbol = F.when(part(1) != "", part(1)).otherwise(part(4))
    number = F.when(part(2) != "", part(2)).otherwise(part(3))
    digits = F.regexp_replace(F.regexp_replace(number, ",", "."), r"(?U)[^\d.]", "")
    valid = (digits == "") | digits.rlike(r"\A(\d+\.?\d*|\.\d+)\z")
    named = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in CURRENCIES.items() for x in kv]), symbol), F.when(F.length(symbol) == 3, symbol))
    return F.struct(F.when(valid, blank_to_null(digits)).alias("price_text"), F.when(valid & md.rlike(PRICE), named).alias("currency"))


def in_stock(html: Column) -> Column:
    value = F.lower(F.regexp_extract(html, r"""(?i)data-in-stock=["']?((?U:\w+))["']?""", 1))
    return ~F.coalesce(value, F.lit("")).isin("false", "0", "no")


def term(heading: Column) -> Column:
    return F.regexp_replace(heading, r"(?i)^(?:Glossary|Reference|Term|Definition|FAQ):(?U:\s+)", "")


def language_code(c: Column) -> Column:
    """English names of languages as two-letter codes; anything else trimmed."""
    names = F.create_map(*[F.lit(x) for kv in LANGUAGES.items() for x in kv])
    trimmed = F.regexp_replace(c, r"(?U)^\s+|\s+$", "")
    return F.coalesce(F.element_at(names, F.lower(trimmed)), trimmed)


def date_value(c: Column) -> Column:
    """A timestamp of 'Feb 17, 2026', 'January 5, 2025' or ISO 8601; null where it is blank or none of these."""
    s = F.trim(c)
    iso = F.when(s.rlike(r"\A\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}.*)?\z"), F.expr("1"))
    return F.coalesce(F.try_to_timestamp(s, F.lit("MMM d, yyyy")), F.try_to_timestamp(s, F.lit("MMMM d, yyyy")), F.when(iso.isNotNull(), s.try_cast("timestamp")), F.when(s.rlike(r"\A\d{1,11}\z"), F.timestamp_seconds(s.try_cast("long"))))


def placeholder(c: Column) -> Column:
    """The marker by which a text looks like a placeholder or an error page, in a fixed order; else null."""
    low = F.lower(c)
    hard = [F.when(low.contains(m), F.lit(m)) for m in HARD_MARKERS]
    soft = [F.when((F.length(c) < SOFT_LENGTH) & low.contains(m), F.lit(m)) for m in SOFT_MARKERS]
    return F.coalesce(*hard, *soft)


def canonical_json(c: Column) -> Column:
    """JSON with sorted keys, compact; equal values have equal text."""
    return F.to_json(F.parse_json(c))


def sha256(c: Column) -> Column:
    return F.sha2(c.cast("binary"), 256)


def one_trailing_newline(c: Column) -> Column:
    return F.when(F.regexp_replace(c, r"\n+\z", "") == "", F.lit("")).otherwise(F.concat(F.regexp_replace(c, r"\n+\z", ""), F.lit("\n")))


def verdict(c: Column) -> Column:
    """struct(unsafe, reason) of a guard model's one-line answer; what cannot be read is unsafe."""
    line = r"(?is)\A(SAFE|UNSAFE):\s*(.*)\z"
    t = F.trim(c)
    known = F.coalesce(t.rlike(line), F.lit(False))
    return F.struct(F.when(known, F.upper(F.regexp_extract(t, line, 1)) == "UNSAFE").otherwise(True).alias("unsafe"), F.when(known, F.trim(F.regexp_extract(t, line, 2))).otherwise(F.concat(F.lit("unparseable output: "), F.coalesce(t, F.lit("")))).alias("reason"))


def guard_prefix(c: Column, chars: int = 8000) -> Column:
    return F.substring(c, 1, chars)


# soft checks of extraction tests
def at_least(c: Column, n: int) -> Column:
    return F.length(c) >= n


def contains_all(c: Column, needles: list[str]) -> Column:
    return F.forall(F.array(*map(F.lit, needles)), lambda n: F.lower(c).contains(F.lower(n)))


def number_at_least(c: Column, n: int) -> Column:
    """The whole number in a value, nothing counting as 0, is no less."""
    return F.coalesce(c.try_cast("decimal(38,9)"), F.lit(0)) >= n


#: Suffixes of soft rules, the longer first, and the check that each makes of a field.
SOFT = {"_min_length": at_least, "_must_contain": contains_all, "_min": number_at_least}


def soft_failures(rules: dict[str, object], values: dict[str, Column]) -> Column:
    """array of the names of the rules that fail. A rule is a field's name with a suffix of SOFT, and what the check needs; a field that is
    null fails all but a least number of 0. Raises ValueError on another suffix, KeyError on another field."""
    failed = []
    for rule, wanted in rules.items():
        suffix = next((x for x in SOFT if rule.endswith(x)), None)
        if suffix is None:
            raise ValueError(f"unknown soft rule: {rule}")
        value = values[rule.removesuffix(suffix)].cast("string")
        failed.append(F.when(~F.coalesce(SOFT[suffix](value, wanted), F.lit(False)), F.lit(rule)))
    return F.filter(F.array(*failed), lambda x: x.isNotNull())


def includes(actual: Column, expected: Column) -> Column:
    return F.size(F.array_except(expected, actual)) == 0
