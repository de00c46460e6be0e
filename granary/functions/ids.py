"""Identities of pages: source and id from a URL, ids by source, URLs of items and listings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Where each source's pages are.
BASES = {
    "docs_python_org": "https://docs.python.org/3/",
    "developer_mozilla_org": "https://developer.mozilla.org/en-US/docs/",
    "anthropic_news": "https://www.anthropic.com/news/",
    "scrapethissite_com": "https://www.scrapethissite.com/pages/",
    "dummyjson_com": "https://dummyjson.com/products/",
}


def derived_source(url: Column) -> Column:
    """The URL's authority without www., or synthetic."""
    return F.coalesce(F.nullif(F.regexp_replace(F.try_parse_url(url, F.lit("AUTHORITY")), r"^www\.", ""), F.lit("")), F.lit("synthetic"))


def derived_id(url: Column) -> Column:
    return F.substring(F.sha2(url.cast("binary"), 256), 1, 16)


def without_base(url: Column, name: str) -> Column:
    base = BASES[name]
    return F.when(url.startswith(base), F.substring(url, len(base) + 1, 1 << 30)).otherwise(url)


def source_id(source: Column, url: Column) -> Column:
    """The id that a source gives its page; null for an unknown source."""
    python = without_base(url, "docs_python_org")
    slug = F.regexp_replace(without_base(url, "scrapethissite_com"), "/+$", "")
    return (
        F.when(source == "docs_python_org", F.regexp_replace(python, r"\.html\z", ""))
        .when(source == "developer_mozilla_org", without_base(F.substring_index(url, "#", 1), "developer_mozilla_org"))
        .when(source == "anthropic_news", without_base(url, "anthropic_news"))
        .when(source == "scrapethissite_com", F.when(slug == "", F.lit("index")).otherwise(slug))
        .when(source == "dummyjson_com", F.substring_index(F.substring_index(without_base(url, "dummyjson_com"), "/", 1), "?", 1))
    )


def item_url(item_id: Column, base: str = BASES["dummyjson_com"]) -> Column:
    """Null unless the id is an integer."""
    return F.concat(F.lit(base), item_id.try_cast("bigint").cast("string"))


def listing_url(limit: int, skip: Column, template: str = "https://dummyjson.com/products?limit=%d&skip=%d") -> Column:
    return F.format_string(template, F.lit(limit), skip)


def robots_url(url: Column) -> Column:
    """Where the rules for a URL are; null for what has no scheme and host. Characters that a URL should not have do no harm."""
    host = r"\A([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)"
    return F.when(url.rlike(host), F.concat(F.lower(F.regexp_extract(url, host, 1)), F.lit("://"), F.regexp_extract(url, host, 2), F.lit("/robots.txt")))


def is_article_url(url: Column, prefix: str) -> Column:
    """Below the prefix there is one slug: no further path, fragment or query."""
    slug = F.regexp_replace(F.substring(url, len(prefix) + 1, 1 << 30), "^/+|/+$", "")
    return url.startswith(prefix) & (slug != "") & ~slug.rlike("[/#?]")
