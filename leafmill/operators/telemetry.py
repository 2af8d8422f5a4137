"""Observability: costly calls, status counts and stage metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafmill.functions.text import percentage

STEPS = ("stage", "step", "call_type", "location")


def _measures() -> list:
    return [
        F.count("*").alias("calls"),
        F.sum("duration_ms").alias("total_ms"),
        F.avg("duration_ms").alias("avg_ms"),
        F.percentile("duration_ms", F.lit(0.95)).alias("p95_ms"),
    ]


def hotspots(calls: DataFrame, top: int, stage: str | None = None) -> DataFrame:
    """The costliest steps: counts, sums, mean and 95th percentile of durations, rates of cache hits and successes."""
    rows = calls if stage is None else calls.filter(F.col("stage") == stage)
    found = rows.groupBy(*STEPS).agg(
        *_measures(), F.count_if(F.col("cache_hit")).alias("cache_hits"), F.count_if(F.col("success")).alias("successes")
    )
    rates = {"cache_hit_rate": percentage(F.col("cache_hits"), F.col("calls")), "success_rate": percentage(F.col("successes"), F.col("calls"))}
    return found.withColumns(rates).orderBy(F.desc("total_ms"), *STEPS).limit(max(1, top))


def by_stage(calls: DataFrame, stage: str | None = None) -> DataFrame:
    rows = calls if stage is None else calls.filter(F.col("stage") == stage)
    return rows.groupBy("stage").agg(*_measures()).orderBy(F.desc("total_ms"), "stage")


def status(tables: dict[str, DataFrame]) -> DataFrame:
    """(item, n): rows of each table, and how many documents each stage has done; one pass over each table."""
    docs = tables["documents"]
    done = {f"{s}_done": F.count_if(F.col(f"status_{s}") == "done") for s in ("ocr", "embed", "entities")}
    counts = docs.agg(F.count("*").alias("documents"), *(v.alias(k) for k, v in done.items()))
    rows = counts.select(F.explode(F.map_from_arrays(F.array(*map(F.lit, counts.columns)), F.array(*counts.columns))).alias("item", "n"))
    for name, table in tables.items():
        if name != "documents":
            rows = rows.unionByName(table.agg(F.count("*").alias("n")).select(F.lit(name).alias("item"), "n"))
    return rows


def tier_histogram(pages: DataFrame) -> DataFrame:
    return pages.groupBy("source_tier").agg(F.count("*").alias("pages"))


def confidence_means(pages: DataFrame) -> DataFrame:
    """(document_id, mean_confidence)."""
    return pages.groupBy("document_id").agg(F.avg("confidence").alias("mean_confidence"))


def fallback_events(pages: DataFrame, stored: DataFrame | None = None) -> DataFrame:
    """Events of pages that fell back, by content id, without those stored before."""
    from leafmill.functions.ids import fallback_event_id

    key = fallback_event_id(F.col("document_id"), F.col("page_number"), F.col("fallback_trigger_reason"), F.col("hash_value"))
    rows = pages.filter(F.col("fallback_trigger_reason").isNotNull()).select(
        key.alias("event_id"), "document_id", "page_number", "source_tier", F.col("fallback_trigger_reason").alias("trigger_reason"), F.col("hash_value").alias("page_hash")
    )
    rows = rows.dropDuplicates(["event_id"])
    return rows if stored is None else rows.join(stored.select("event_id"), "event_id", "left_anti")


def mean_of_means(pages: DataFrame) -> DataFrame:
    """(documents, mean_confidence): the unweighted mean of the documents' means."""
    return confidence_means(pages).agg(F.count("mean_confidence").alias("documents"), F.avg("mean_confidence").alias("mean_confidence"))


def stage_metrics(attempts: DataFrame, keys: tuple[str, ...] = ("stage", "run_id")) -> DataFrame:
    """(keys, processed, skipped, failed): what a run did, from its attempts' outcomes; other outcomes count nowhere."""
    outcome = F.lower(F.trim("outcome"))
    names = {"processed": "done", "skipped": "skipped", "failed": "failed"}
    return attempts.groupBy(*keys).agg(*(F.count_if(outcome == v).alias(k) for k, v in names.items()))


def call_records(calls: DataFrame) -> DataFrame:
    """Calls as they are recorded: no negative duration or token count, durations to two digits, null counts as 0."""
    whole = lambda c: F.greatest(F.lit(0), F.coalesce(F.col(c).cast("long"), F.lit(0)))
    return calls.withColumns(
        {
            "duration_ms": F.round(F.greatest(F.lit(0.0), F.col("duration_ms").cast("double")), 2),
            "token_input": whole("token_input"),
            "token_output": whole("token_output"),
        }
    )


def usage(calls: DataFrame, *keys: str) -> DataFrame:
    """(keys, calls, token_input, token_output, total_ms): sums over recorded calls."""
    sums = [F.sum(c).alias(c) for c in ("token_input", "token_output")]
    return calls.groupBy(*keys).agg(F.count("*").alias("calls"), *sums, F.sum("duration_ms").alias("total_ms"))


def without_stages(lines: DataFrame, stages: list[str], column: str = "value") -> DataFrame:
    """JSON lines without those of some stages; lines that do not parse, or name no stage, stay; blank ones go."""
    stage = F.get_json_object(column, "$.stage")
    return lines.filter((F.trim(column) != "") & F.coalesce(~stage.isin(*stages), F.lit(True)))
