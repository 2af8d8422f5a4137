"""Content-derived identifiers as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def content_hash(content: Column) -> Column:
    """sha256 of a text (utf-8) or binary, as hex."""
    return F.sha2(content, 256)


def document_id(sha256: Column) -> Column:
    return F.concat(F.lit("doc_"), F.substring(sha256, 1, 12))


def page_id(document: Column, number: Column) -> Column:
    return F.format_string("%s_p%04d", document, number.cast("int"))


def chunk_id(page: Column, index: Column) -> Column:
    """Chunk indexes count from 1."""
    return F.format_string("%s_c%04d", page, index.cast("int"))


def entity_id(kind: Column, value: Column) -> Column:
    norm = F.trim(F.regexp_replace(F.lower(value), r"\s+", " "))
    return F.concat(F.lit("ent_"), F.substring(F.sha1(F.concat(kind, F.lit(":"), norm)), 1, 12))


def _joined(parts: tuple[Column, ...], null: str) -> Column:
    return F.concat_ws("|", *(F.coalesce(p.cast("string"), F.lit(null)) for p in parts))


def edge_id(subject: Column, predicate: Column, target: Column, document: Column, page: Column, start: Column, end: Column) -> Column:
    """Nulls print as None, so that an edge without page differs from one with an empty page."""
    return F.substring(F.sha1(_joined((subject, predicate, target, document, page, start, end), "None")), 1, 16)


def fallback_event_id(document: Column, page: Column, reason: Column, page_hash: Column) -> Column:
    return F.substring(F.sha1(_joined((document, page, reason, page_hash), "")), 1, 16)


def payment_id(document: Column, index: Column, pay_date: Column, document_type: Column) -> Column:
    return F.substring(F.sha1(_joined((document, index, pay_date, document_type), "None")), 1, 16)


def model_cache_key(model: Column, task: Column, system: Column, user: Column) -> Column:
    return F.sha2(F.concat_ws("|", model, task, system, user), 256)


def tier_cache_key(tier: Column, model: Column, page_hash: Column) -> Column:
    return F.sha2(F.concat_ws("|", tier, model, page_hash), 256)
