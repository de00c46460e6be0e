"""Typed records from pages: one builder per page type over Markdown and markup columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.functions import html, ids, text
from granary.schema import SANITIZED


def article(md: Column, markup: Column, url: Column, extra: dict[str, Column]) -> dict[str, Column]:
    return {"title": F.coalesce(text.first_heading(md), F.lit("Untitled")), "author": text.byline(md), "published_at": extra["published"], "body_md": md, "language": F.coalesce(text.html_lang(markup), F.lit("en"))}


def docs(md: Column, markup: Column, url: Column, extra: dict[str, Column]) -> dict[str, Column]:
    return {"title": F.coalesce(text.first_heading(md), F.lit("Untitled")), "section_path": extra["section_path"], "body_md": md, "code_block_count": text.code_blocks(md), "last_updated": F.lit(None).cast("string")}


def product(md: Column, markup: Column, url: Column, extra: dict[str, Column]) -> dict[str, Column]:
    price = text.price(md)
    return {"name": text.first_heading(md), "price": price["price_text"], "currency": price["currency"], "in_stock": text.in_stock(markup), "description": md}


def reference(md: Column, markup: Column, url: Column, extra: dict[str, Column]) -> dict[str, Column]:
    return {"term": F.coalesce(text.term(text.first_heading(md)), F.lit("Unknown")), "definition": md, "examples": F.array().cast("array<string>"), "last_updated": F.lit(None).cast("string")}


PARSERS: dict[str, Callable[..., dict[str, Column]]] = {"article": article, "docs": docs, "product": product, "reference": reference}


def fields(page_type: str, url: Column) -> dict[str, Column]:
    """The page type's fields from a staged `_page` (html.page_parts); source and id are derived from the URL."""
    found = PARSERS[page_type](F.col("_page.md"), F.col("_page.html"), url, {"section_path": F.col("_page.section_path"), "published": F.col("_page.published")})
    return {"source": ids.derived_source(url), "source_url": url, "source_id": ids.derived_id(url)} | found


def parsed(df: DataFrame, page_type: str, raw: str = "raw", url: str = "url") -> DataFrame:
    """df with record, a struct of the page type's fields as found."""
    staged = df.withColumn("_page", html.page_parts(F.col(raw)))
    return staged.withColumn("record", F.struct(*[v.alias(k) for k, v in fields(page_type, F.col(url)).items()])).drop("_page")


def local(df: DataFrame, page_type: str, raw: str = "raw", url: str = "url", source: str = "synthetic", language: str = "en", sanitized: bool = True) -> DataFrame:
    """df with payload (JSON) and warnings: the local path from a raw page to what is validated. source, the given id column
    `source_id` (if df has one) and, for articles, language replace what was found."""
    if sanitized:
        df = df.withColumn("_seen", html.normalized_visible(F.col(raw)))
        df = df.withColumn("_clean", text.sanitize(F.col("_seen.text"), F.col("_seen.warnings")))
        df = df.withColumns({"warnings": F.col("_clean.warnings"), "_raw": F.col("_clean.text")}).drop("_seen", "_clean")
    else:
        df = df.withColumns({"warnings": F.array().cast("array<string>"), "_raw": F.col(raw)})
    staged = df.withColumn("_page", html.page_parts(F.col("_raw")))
    found = fields(page_type, F.col(url)) | {"source": F.lit(source)}
    if "source_id" in df.columns:
        found["source_id"] = F.col("source_id")
    if page_type == "article":
        found["language"] = F.lit(language)
    for f in SANITIZED:
        if f in found:
            found[f] = text.sanitize(found[f])["text"]
    return staged.withColumn("payload", F.to_json(F.struct(*[v.alias(k) for k, v in found.items()]), {"ignoreNullFields": "false"})).drop("_page", "_raw")
