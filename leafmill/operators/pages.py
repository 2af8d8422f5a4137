"""Catalogue and page extraction: which files are new, which text of a page is best, which tier a page needs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leafmill.functions.text import page_type, with_quality

#: Confidence from which a page needs no further tier.
ENOUGH = 0.5
VISUAL = ("table", "form", "handwritten", "invoice")
CLEANED = 0.75


def first_of_each(rows: DataFrame, key: str, *order: str | Column) -> DataFrame:
    """The first row of each key by an order; ties go to whatever the order leaves, so give a total one."""
    w = Window.partitionBy(key).orderBy(*order)
    return rows.withColumn("_first", F.row_number().over(w)).filter("_first = 1").drop("_first")


def new_documents(files: DataFrame, catalogue: DataFrame | None = None) -> DataFrame:
    """Files by content: of equal contents the least path, without those that the catalogue holds."""
    once = first_of_each(files.filter(F.col("document_id").isNotNull()), "document_id", "path")
    if catalogue is None:
        return once
    return once.join(catalogue.select("document_id"), "document_id", "left_anti")


def best_candidates(candidates: DataFrame) -> DataFrame:
    """(document_id, page_number, backend, candidate, score): of a page's candidate texts the best by quality, the first of
    equals by rank; a text that scores nothing never wins.  Columns: document_id, page_number, rank, backend, candidate."""
    scored = with_quality(candidates, "candidate")
    w = Window.partitionBy("document_id", "page_number").orderBy(F.col("score").desc(), "rank")
    # the score is tested after the window, else it would be worked out twice
    return scored.withColumn("_first", F.row_number().over(w)).filter("_first = 1 AND score > 0").drop("_first", "rank")


def escalated(pages: DataFrame) -> DataFrame:
    """Pages after the cascade of tiers, as far as it goes without models.

    Columns: document_id, page_number, text, source_tier, ocr_text, ocr_confidence.  A good text layer stays.  A bad one
    gives way to recognised text of higher quality; without recognised text its confidence is 0.  Where confidence then
    stays low, text clean-up takes the page, except that pages of visual types wait for a vision model (`needs_vision`)."""
    rows = with_quality(with_quality(pages, "text", "score", "fault"), "ocr_text", "ocr_score")
    bad, better = F.col("fault").isNotNull(), F.col("ocr_score") > F.col("score")
    takes_ocr = bad & F.col("ocr_text").isNotNull() & better
    rows = rows.withColumns(
        {
            "text": F.when(takes_ocr, F.col("ocr_text")).otherwise(F.col("text")),
            "confidence": F.when(takes_ocr, F.col("ocr_confidence")).when(bad & F.col("ocr_text").isNull(), 0.0).otherwise(F.col("score")),
            "source_tier": F.when(takes_ocr, "tier1_ocr_pdf").otherwise(F.col("source_tier")),
        }
    )
    kind = page_type(F.col("text"), F.col("confidence"))
    low = bad & (F.col("confidence") < ENOUGH)
    rows = rows.withColumns({"_kind": kind, "_low": low})
    rows = rows.withColumn("needs_vision", F.col("_low") & F.col("_kind").isin(*VISUAL))
    cleaned = F.col("_low") & (F.lit(CLEANED) >= F.col("confidence"))
    rows = rows.withColumns(
        {
            "confidence": F.when(cleaned, CLEANED).otherwise(F.col("confidence")),
            "source_tier": F.when(cleaned, "tier2a_llm_cleanup").otherwise(F.col("source_tier")),
            "fallback_region": F.when(cleaned, "full_page"),
        }
    )
    final = page_type(F.col("text"), F.col("confidence"))
    return rows.withColumn("page_type", final).withColumnRenamed("fault", "fallback_trigger_reason").drop("_kind", "_low", "score", "ocr_score", "ocr_text", "ocr_confidence")


def ocr_confidence(words: Column) -> Column:
    """The mean of the word confidences that are not negative, by 100, clamped to 0..1."""
    kept = F.filter(words, lambda x: x >= 0)
    mean = F.try_divide(F.aggregate(kept, F.lit(0.0), lambda s, x: s + x.cast("double")), F.size(kept))
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(mean / 100.0, F.lit(0.0))))
