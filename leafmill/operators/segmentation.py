"""Segments of long documents at drops of page similarity, and the offline summaries built on them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leafmill.functions.text import jaccard, word_set

DROP, SHORTEST, LONG_PAGES = 0.35, 3, 20


def adjacent_similarity(pages: DataFrame) -> DataFrame:
    """(document_id, page_number, page_type, similarity): Jaccard similarity of a page's words to those of the page before;
    null on the first.  A page number that stands twice must have been reduced to one row."""
    w = Window.partitionBy("document_id").orderBy("page_number")
    rows = pages.select("document_id", "page_number", "page_type", word_set(F.coalesce("text", F.lit(""))).alias("words"))
    before = F.lag("words").over(w)
    return rows.withColumn("similarity", F.when(before.isNotNull(), jaccard(before, F.col("words")))).drop("words")


def segments(similar: DataFrame) -> DataFrame:
    """Adds `segment`, from 1: a new one begins where similarity drops below .35; any but the first that has fewer than three
    pages joins the one before.  Running sums instead of a loop: whether a segment is kept depends on its own length."""
    pages = Window.partitionBy("document_id").orderBy("page_number").rowsBetween(Window.unboundedPreceding, 0)
    raw = similar.withColumn("_raw", F.sum(F.when(F.col("similarity") < DROP, 1).otherwise(0)).over(pages))
    sized = raw.withColumn("_size", F.count("*").over(Window.partitionBy("document_id", "_raw")))
    opens = (F.col("_raw") == 0) | (F.col("_size") >= SHORTEST)
    first = F.row_number().over(Window.partitionBy("document_id", "_raw").orderBy("page_number")) == 1
    return sized.withColumn("segment", F.sum(F.when(opens & first, 1).otherwise(0)).over(pages)).drop("_raw", "_size")


def segment_index(pages: DataFrame) -> DataFrame:
    """(document_id, segment, first_page, last_page, pages, dominant_type): the most frequent page type, ties by name."""
    counts = pages.groupBy("document_id", "segment", F.coalesce("page_type", F.lit("text")).alias("kind")).agg(
        F.count("*").alias("n"), F.min("page_number").alias("first_page"), F.max("page_number").alias("last_page")
    )
    best = F.min(F.struct((-F.col("n")).alias("less"), "kind"))
    return counts.groupBy("document_id", "segment").agg(
        F.min("first_page").alias("first_page"), F.max("last_page").alias("last_page"), F.sum("n").alias("pages"), best["kind"].alias("dominant_type")
    )


def summary_route(documents: DataFrame, pages: DataFrame, chunk_counts: DataFrame) -> DataFrame:
    """(document_id, pages, route): `empty` without chunks, `segmented` from 20 pages on, else `flat`."""
    sizes = pages.groupBy("document_id").agg(F.countDistinct("page_number").alias("pages"))
    held = chunk_counts.select("document_id").distinct().withColumn("_held", F.lit(True))
    rows = documents.select("document_id").distinct().join(sizes, "document_id", "left").join(held, "document_id", "left")
    n = F.coalesce("pages", F.lit(0))
    route = F.when(F.col("_held").isNull(), "empty").when(n >= LONG_PAGES, "segmented").otherwise("flat")
    return rows.select("document_id", n.alias("pages"), route.alias("route"))


def toc_line(summary: str = "summary"):
    """A segment's summary as one line: contents, types, five entities, three dates, three amounts, two uncertainties."""
    listed = lambda field, n, sep: F.array_join(F.slice(F.col(f"{summary}.{field}"), 1, n), sep)
    part = lambda name, field, n, sep=", ": F.when(F.size(f"{summary}.{field}") > 0, F.concat(F.lit(f"{name}: "), listed(field, n, sep)))
    return F.concat_ws(
        " | ",
        F.nullif(F.trim(f"{summary}.what_this_segment_contains"), F.lit("")),
        part("Types", "likely_document_types", 1_000),
        part("Entities", "key_entities", 5),
        part("Dates", "key_dates", 3),
        part("Amounts", "key_amounts", 3),
        part("Uncertainties", "uncertainties", 2, "; "),
    )


NOTHING = "No readable content."


def page_range(pages: DataFrame, first: int, last: int) -> DataFrame:
    return pages.filter(F.col("page_number").between(first, last))


def section_lines(index: DataFrame, readable: DataFrame, summaries: DataFrame | None = None) -> DataFrame:
    """(document_id, segment, line): a line for each segment of `index`: its number, range, dominant type and summary.

    `readable`: document_id, segment of segments with any text; `summaries`: document_id, segment, summary of a model.  A segment
    without text says so; one with text that no model has summarised says that."""
    total = F.max("segment").over(Window.partitionBy("document_id"))
    rows = index.withColumn("total", total).join(readable.select("document_id", "segment", F.lit(True).alias("_held")).distinct(), ["document_id", "segment"], "left")
    given = F.lit(None).cast("string")
    if summaries is not None:
        rows = rows.join(summaries.select("document_id", "segment", "summary"), ["document_id", "segment"], "left")
        given = F.nullif(F.trim("summary"), F.lit(""))
    number, first, last = (F.col(c).cast("string") for c in ("segment", "first_page", "last_page"))
    blank = F.concat(F.lit("[Segment "), number, F.lit(" of "), F.col("total").cast("string"), F.lit(", pages "), first, F.lit("–"), last, F.lit(": no readable content]"))
    unread = F.concat(F.lit("[Segment "), number, F.lit(": could not summarize]"))
    said = F.when(F.col("_held").isNull(), blank).otherwise(F.coalesce(given, unread))
    line = F.concat(F.lit("Section "), number, F.lit(" (pages "), first, F.lit("–"), last, F.lit(", type: "), "dominant_type", F.lit("): "), said)
    return rows.select("document_id", "segment", line.alias("line"))


def document_summaries(routes: DataFrame, sections: DataFrame, flat: DataFrame | None = None, composed: DataFrame | None = None) -> DataFrame:
    """(document_id, route, summary): segmented documents by their sections, below a model's composed summary if there is one; flat
    ones by a model's summary; without one, and for documents without chunks, the text that says so.

    A document's sections are one row here, as the summary is one text."""
    toc = sections.groupBy("document_id").agg(F.array_sort(F.collect_list(F.struct("segment", "line"))).alias("s"))
    toc = toc.select("document_id", F.size("s").alias("n"), F.array_join(F.transform("s", lambda x: x["line"]), "\n").alias("toc"))
    rows = routes.join(toc, "document_id", "left")
    for name, given in (("_flat", flat), ("_composed", composed)):
        rows = rows.withColumn(name, F.lit(None).cast("string")) if given is None else rows.join(given.select("document_id", F.col("summary").alias(name)), "document_id", "left")
    count = F.concat(F.lit("\n\n---\nSections detected: "), F.col("n").cast("string"), F.lit("\n"), "toc")
    segmented = F.coalesce(F.concat("_composed", count), F.col("toc"))
    text = F.when(F.col("route") == "segmented", segmented).when(F.col("route") == "flat", F.col("_flat"))
    return rows.select("document_id", "route", F.coalesce(F.nullif(F.trim(text), F.lit("")), F.lit(NOTHING)).alias("summary"))


def changed_summaries(made: DataFrame, stored: DataFrame) -> DataFrame:
    """The summaries that differ from the stored ones, by hash; only these are written."""
    same = stored.select("document_id", F.sha2("summary", 256).alias("_h")).distinct()
    rows = made.withColumn("_h", F.sha2("summary", 256))
    return rows.join(same, ["document_id", "_h"], "left_anti").drop("_h")
