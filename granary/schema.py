"""Fixed schemas of the four tables and of the traces, and what each page type's records hold."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


_KINDS = {"BIGINT": T.LongType(), "STRING": T.StringType(), "TIMESTAMP": T.TimestampType(), "DOUBLE": T.DoubleType(), "DATE": T.DateType(), "BOOLEAN": T.BooleanType(), "MAP": T.MapType(T.StringType(), T.StringType())}


def _table(spec: str) -> T.StructType:
    """Columns as name TYPE [NOT NULL], without a session."""
    parts = [c.split() for c in spec.split(", ")]
    return T.StructType([T.StructField(p[0], _KINDS[p[1]], len(p) < 3) for p in parts])


RAW = _table("id BIGINT NOT NULL, source STRING NOT NULL, source_id STRING NOT NULL, url STRING NOT NULL, content_hash STRING NOT NULL, raw_payload STRING NOT NULL, scraped_at TIMESTAMP NOT NULL, trace_id STRING NOT NULL")
CANONICAL = _table("source STRING NOT NULL, source_id STRING NOT NULL, url STRING NOT NULL, payload STRING NOT NULL, valid_from TIMESTAMP NOT NULL, raw_id BIGINT NOT NULL")
CHANGES = _table("id BIGINT NOT NULL, source STRING NOT NULL, source_id STRING NOT NULL, field STRING NOT NULL, old_value STRING, new_value STRING, changed_at TIMESTAMP NOT NULL")
FAILED = _table("id BIGINT NOT NULL, source STRING NOT NULL, url STRING NOT NULL, raw_id BIGINT NOT NULL, error STRING NOT NULL, detected_at TIMESTAMP NOT NULL, resolved_at TIMESTAMP, resolution STRING")
SPANS = _table("span_id STRING, parent_id STRING, name STRING, started DOUBLE, attrs MAP, status STRING, error STRING, duration_ms BIGINT")
SOURCES = _table("domain STRING, added_by STRING, reviewed_at DATE, legal_basis STRING, rate_limit_rps DOUBLE, adapter STRING, api_available BOOLEAN, api_check_notes STRING")

TABLES = {"raw_content": RAW, "canonical_records": CANONICAL, "change_history": CHANGES, "validation_failed": FAILED}
RESOLUTIONS = ("fixed", "discarded", "source_changed")


@dataclass(frozen=True)
class Field:
    """A record's field: its type, whether it must be there, its bounds, and the rules after them."""

    name: str
    kind: str  # str, int, bool, decimal, datetime, list, url
    required: bool = False
    low: int | None = None
    high: int | None = None
    pattern: str | None = None
    before: str | None = None  # language, date
    after: str | None = None  # placeholder, positive
    default: str | None = None  # of a list


COMMON = (Field("source", "str", True, 1, 64), Field("source_url", "url", True), Field("source_id", "str", True, 1, 256))
RECORDS: dict[str, tuple[Field, ...]] = {
    "article": (*COMMON, Field("title", "str", True, 1, 500), Field("author", "str"), Field("published_at", "datetime", before="date"), Field("body_md", "str", True, 10, after="placeholder"), Field("language", "str", True, pattern=r"\A[a-z]{2}\z", before="language")),
    "docs": (*COMMON, Field("title", "str", True, 1), Field("section_path", "list", default="[]"), Field("body_md", "str", True, 10, after="placeholder"), Field("code_block_count", "int", True, 0), Field("last_updated", "datetime")),
    "product": (*COMMON, Field("name", "str", True, 1, 300), Field("sku", "str"), Field("price", "decimal", after="positive"), Field("currency", "str", pattern=r"\A[A-Z]{3}\z"), Field("in_stock", "bool", True), Field("description", "str", after="placeholder")),
    "reference": (*COMMON, Field("term", "str", True, 1, 300), Field("definition", "str", True, 10, after="placeholder"), Field("examples", "list", default="[]"), Field("last_updated", "datetime")),
}
#: Text fields that are sanitized before a record is stored.
SANITIZED = ("body_md", "definition", "description")
