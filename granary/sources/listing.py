"""limit/skip listings: which pages count, their items' URLs, and a batch data source that fetches them."""

from __future__ import annotations

import json
import logging
import math
import time
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import window as W
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from granary.functions.ids import item_url

LIMIT, MAX_PAGES = 30, 100


def pages_read(pages: DataFrame, limit: int = LIMIT, max_pages: int = MAX_PAGES, by: list[str] | None = None) -> DataFrame:
    """pages(page, n_items, total) up to and with the first that ends a listing: empty, short, all seen, or the page cap."""
    by = by or []
    upto = W.Window.partitionBy(*by).orderBy("page").rowsBetween(W.Window.unboundedPreceding, 0)
    earlier = W.Window.partitionBy(*by).orderBy("page").rowsBetween(W.Window.unboundedPreceding, -1)
    seen = pages.withColumn("seen", F.sum("n_items").over(upto)).withColumn("known", F.first("total", ignorenulls=True).over(upto))
    ends = (F.col("n_items") < limit) | F.coalesce(F.col("seen") >= F.col("known"), F.lit(False)) | (F.col("page") + 1 >= max_pages)
    return seen.withColumn("ends", ends).withColumn("_over", F.coalesce(F.max("ends").over(earlier), F.lit(False))).where(~F.col("_over")).drop("_over", "known")


def listed_urls(pages: DataFrame, limit: int = LIMIT, max_pages: int = MAX_PAGES, items_key: str = "products", total_key: str = "total", to_url: Callable[[Column], Column] = item_url) -> DataFrame:
    """seq, url of the items of pages(page, body JSON). Items that are no objects are dropped, but shorten their page; an
    item without an integer id raises when it runs."""
    doc = F.parse_json("body")
    items = F.coalesce(F.try_variant_get(doc, f"$.{items_key}", "array<variant>"), F.array().cast("array<variant>"))
    objects = F.filter(items, lambda x: F.schema_of_variant(x).startswith("OBJECT"))
    counted = pages.select("page", objects.alias("items"), F.try_variant_get(doc, f"$.{total_key}", "bigint").alias("total")).withColumn("n_items", F.size("items"))
    read = pages_read(counted, limit, max_pages)
    ident = F.try_variant_get(F.col("item"), "$.id", "bigint")
    rows = read.select("page", F.posexplode("items").alias("pos", "item"))
    url = F.when(ident.isNull(), F.raise_error(F.lit("item without an integer id")).cast("string")).otherwise(to_url(ident))
    return rows.select((F.col("page") * limit + F.col("pos")).cast("long").alias("seq"), url.alias("url"))


class _Page(InputPartition):
    """A page, or with `on` all from it on until the listing ends. Calls may start in the slots `page + m * pages` of a clock that
    ticks 1 / rps apart from `clock` on: no two pages share a slot, however late their tasks are or how often they run."""

    def __init__(self, page: int, pages: int, clock: float, on: bool = False, body: str | None = None):
        super().__init__(page)
        self.page, self.pages, self.clock, self.on, self.body = page, pages, clock, on, body


def next_slot(page: int, pages: int, clock: float, rps: float, now: float) -> float:
    """When a page's call may start: in the first of its slots that is not over."""
    first = clock + page / rps
    return first if now <= first else first + math.ceil((now - first) * rps / pages) * pages / rps


class ListingSource(DataSource):
    """spark.read.format("limit_skip").option("template", ...).load(): page, body. Where the first page says how many items there
    are, each page is a partition of its own; else one partition asks page after page and stops at the first that is short or
    empty, so that no page is fetched behind the end. spark.readStream reads a listing with a total, `pages_a_batch` pages a
    micro-batch, and goes on behind the last page that was committed. Options: rps (calls a second, required), limit, max_pages, items_key, total_key."""

    fetch: Callable[[str], str] | None = None

    @classmethod
    def name(cls) -> str:
        return "limit_skip"

    def schema(self):
        return "page int, body string"

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _ListingReader(dict(self.options), type(self).fetch)

    def streamReader(self, schema: T.StructType) -> DataSourceStreamReader:  # noqa: N802
        return _ListingStream(dict(self.options), type(self).fetch)


def http_get(url: str, agent: str = "granary/1.0 (+contact@example.com)", timeout: float = 30.0) -> str:
    import urllib.request

    request = urllib.request.Request(url, headers={"User-Agent": agent, "Accept": "application/json"})
    with urllib.request.urlopen(request, timeout=timeout) as answer:
        kind, body = answer.headers.get("Content-Type", ""), answer.read().decode("utf-8")
    if not kind.startswith("application/json"):
        logging.getLogger(__name__).warning("%s answers with Content-Type %r; read as JSON all the same", url, kind)
    if not isinstance(json.loads(body), dict):
        raise ValueError(f"expected a JSON object from {url}")
    return body


class _Listing:
    def __init__(self, options: dict, fetch: Callable[[str], str] | None):
        self.template, self.limit = options["template"], int(options.get("limit", LIMIT))
        self.max_pages, self.total_key = int(options.get("max_pages", MAX_PAGES)), options.get("total_key", "total")
        self.items_key, self.fetch = options.get("items_key", "products"), fetch or http_get
        if "rps" not in options or float(options["rps"]) <= 0:
            raise ValueError("a listing needs rps, the calls a second that its source allows")
        self.rps, self.pages_a_batch = float(options["rps"]), int(options.get("pages_a_batch", 10))

    def url(self, page: int) -> str:
        return self.template.format(limit=self.limit, skip=page * self.limit)

    def first(self) -> tuple[str, int | None]:
        """The first page, and how many pages there are, if it tells."""
        body = self.fetch(self.url(0))
        page = json.loads(body)
        total = page.get(self.total_key)
        if not isinstance(total, int):
            return body, None
        if len(page.get(self.items_key) or []) < self.limit:
            return body, 1
        return body, min(self.max_pages, max(1, -(-total // self.limit)))

    def read(self, partition: _Page) -> Iterator[tuple]:
        page, body = partition.page, partition.body
        while True:
            if body is None:
                time.sleep(max(0.0, next_slot(page, partition.pages, partition.clock, self.rps, time.time()) - time.time()))
                body = self.fetch(self.url(page))
            yield page, body
            page += 1
            if not partition.on or page >= self.max_pages or len(json.loads(body).get(self.items_key) or []) < self.limit:
                return
            body = None


class _ListingReader(_Listing, DataSourceReader):
    def partitions(self):
        asked = time.time()
        body, pages = self.first()
        if pages is None:
            return [_Page(0, self.max_pages, asked, on=True, body=body)]
        return [_Page(k, pages, asked, body=None if k else body) for k in range(pages)]


class _ListingStream(_Listing, DataSourceStreamReader):
    """Offsets are pages."""

    pages: int | None = None
    ahead = 0

    def initialOffset(self) -> dict:  # noqa: N802
        return {"page": 0}

    def latestOffset(self) -> dict:  # noqa: N802
        if self.pages is None:
            _, self.pages = self.first()
            if self.pages is None:
                raise ValueError("a listing that is read as a stream must tell its total")
        self.ahead = min(self.pages, self.ahead + self.pages_a_batch)
        return {"page": self.ahead}

    def partitions(self, start: dict, end: dict):
        self.ahead = max(self.ahead, end["page"])
        clock = time.time() + 1 / self.rps
        return [_Page(k, max(1, end["page"]), clock - start["page"] / self.rps) for k in range(start["page"], end["page"])]

    def commit(self, end: dict) -> None:
        self.ahead = max(self.ahead, end["page"])
