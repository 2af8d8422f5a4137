"""Overlapping chunks of pages and the decision what to embed again."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafmill.functions.ids import chunk_id, content_hash
from leafmill.functions.text import hash_embedding, stripped, token_estimate

SIZE, OVERLAP = 2_000, 200


def chunks(pages: DataFrame, size: int = SIZE, overlap: int = OVERLAP) -> DataFrame:
    """(document_id, page_id, page_number, chunk_id, chunk_index, char_start, char_end, token_estimate, chunk_text_hash, text).

    Windows over the stripped text; a text of at most `size` characters is one chunk, a blank one none.  Starts follow from
    the index alone, so the chunks of a page are one generated array: no loop and no shuffle."""
    step = size - overlap
    body = pages.filter(F.col("page_id").isNotNull()).select("document_id", "page_id", "page_number", stripped(F.col("text")).alias("body"))
    n = F.length("body")
    count = F.when(n <= size, 1).otherwise(F.ceil((n - size) / F.lit(float(step))).cast("int") + 1)
    each = body.filter(n > 0).select("*", F.explode(F.sequence(F.lit(1), count)).alias("chunk_index"))
    start = (F.col("chunk_index") - 1) * step
    piece = F.substring("body", start + 1, F.lit(size))
    rows = each.withColumns({"char_start": start, "text": piece})
    return rows.select(
        "document_id",
        "page_id",
        "page_number",
        chunk_id(F.col("page_id"), F.col("chunk_index")).alias("chunk_id"),
        "chunk_index",
        "char_start",
        (F.col("char_start") + F.length("text")).alias("char_end"),
        token_estimate(F.col("text")).alias("token_estimate"),
        content_hash(F.col("text")).alias("chunk_text_hash"),
        "text",
    )


def to_embed(current: DataFrame, stored: DataFrame, version: str) -> DataFrame:
    """The chunks whose text hash and version no stored vector has; only these reach a model.

    `stored`: chunk_id, chunk_text_hash, embedding_version."""
    done = stored.filter(F.col("embedding_version") == version).select("chunk_id", "chunk_text_hash").distinct()
    return current.join(done, ["chunk_id", "chunk_text_hash"], "left_anti")


def embedded_offline(current: DataFrame, dimensions: int, version: str) -> DataFrame:
    """Vectors of the deterministic stand-in model, made inside the JVM."""
    return current.select(
        "chunk_id",
        F.lit("deterministic-local").alias("embedding_model"),
        F.lit(version).alias("embedding_version"),
        hash_embedding(F.col("text"), dimensions).cast("array<float>").alias("embedding"),
    )


def scan(current: DataFrame, documents: DataFrame, pages: DataFrame) -> DataFrame:
    """Chunks of embedded documents with the family of the document and the type of the page, if the page is known."""
    ready = documents.filter(F.col("status_embed") == "done").select("document_id", "doc_family").distinct()
    kinds = pages.select("page_id", "page_type")
    return current.join(ready, "document_id").join(kinds, "page_id", "left")
