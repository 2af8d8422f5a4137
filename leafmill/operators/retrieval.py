"""Vector retrieval under a token budget, and the context that is built from it."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leafmill.functions.text import cosine_distance, stripped, without_code_fence


def nearest(vectors: DataFrame, query: list[float], k: int, key: str = "chunk_id", vector: str = "embedding") -> DataFrame:
    """The k rows nearest to a query vector by cosine distance, ties by key.  Each task keeps its own k first, so nothing
    else is shuffled.  Null, all-zero and differently long vectors have no distance and are left out."""
    q = F.array(*(F.lit(float(x)) for x in query))
    rows = vectors.withColumn("distance", cosine_distance(F.col(vector), q)).filter(F.col("distance").isNotNull())
    return rows.orderBy("distance", key).limit(k)


def within_budget(ranked: DataFrame, tokens: str, budget: int, *order: str) -> DataFrame:
    """The longest prefix of ranked rows whose tokens sum up to the budget at most; it ends before the first that would
    exceed it.  For the few rows of a retrieval: they are ordered in one task."""
    w = Window.partitionBy(F.lit(1)).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    rows = ranked.withColumn("running_tokens", F.sum(F.greatest(F.lit(1), F.col(tokens))).over(w))
    return rows.filter(F.col("running_tokens") <= budget)


def retrieve(
    chunks: DataFrame, vectors: DataFrame, query: list[float], top_k: int, max_chunks: int, max_tokens: int, document: str | None = None
) -> DataFrame:
    """The nearest chunks to a query, of one document or of all, under a token budget."""
    if top_k > max_chunks:
        raise ValueError(f"top_k ({top_k}) exceeds max_chunks ({max_chunks})")
    if document is not None:
        chunks = chunks.filter(F.col("document_id") == document)
    found = nearest(chunks.join(vectors.select("chunk_id", "embedding"), "chunk_id"), query, top_k)
    return within_budget(found, "token_estimate", max_tokens, "distance", "chunk_id")


def contexts(chunks: DataFrame, group: str, limit: int) -> DataFrame:
    """(group, context, entries): per group the chunks in order, each under a `[chunk_id:… page:…]` line, as many as fit into
    `limit` characters.  Blank chunks are left out first.  A group is one document's chunks of one retrieval or segment."""
    rows = chunks.withColumn("body", stripped(F.col("text"))).filter("body <> ''")
    head = F.concat(F.lit("[chunk_id:"), "chunk_id", F.lit(" page:"), F.coalesce(F.col("page_number").cast("string"), F.lit("None")), F.lit("]\n"))
    rows = rows.withColumn("entry", F.concat(head, "body", F.lit("\n")))
    w = Window.partitionBy(group).orderBy("page_number", "chunk_id").rowsBetween(Window.unboundedPreceding, 0)
    kept = rows.withColumn("running", F.sum(F.length("entry")).over(w)).filter(F.col("running") <= limit)
    parts = F.array_sort(F.collect_list(F.struct("page_number", "chunk_id", "entry")))
    return kept.groupBy(group).agg(
        F.trim(F.array_join(F.transform(parts, lambda x: x["entry"]), "\n")).alias("context"), F.count("*").alias("entries")
    )


NO_CHUNKS, NO_ANSWER = "No relevant chunks found.", "No model response."


def answer_of(found: DataFrame, query: str, reply: str | None = None) -> DataFrame:
    """One row: query, chunks_used, chunk_ids, answer, citations, uncertainties: a retrieval's answer.

    `reply` is what a model said to the contexts: a JSON object with answer, citations and uncertainties; without chunks there
    is no answer, and without a usable reply the row says so.  The retrieval is bounded by its budget."""
    parsed = F.from_json(without_code_fence(F.lit(reply)), "answer string, citations array<string>, uncertainties array<string>")
    none = F.array().cast("array<string>")
    rows = found.agg(F.array_sort(F.collect_list(F.struct("distance", "chunk_id"))).alias("c")).withColumn("r", parsed)
    ids = F.transform("c", lambda x: x["chunk_id"])
    return rows.select(
        F.lit(query).alias("query"),
        F.size("c").alias("chunks_used"),
        ids.alias("chunk_ids"),
        F.when(F.size("c") == 0, NO_CHUNKS).otherwise(F.coalesce("r.answer", F.lit(NO_ANSWER))).alias("answer"),
        F.when(F.size("c") == 0, none).otherwise(F.coalesce("r.citations", none)).alias("citations"),
        F.when(F.size("c") == 0, none).otherwise(F.coalesce("r.uncertainties", none)).alias("uncertainties"),
    )
