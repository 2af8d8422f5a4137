"""Chat exports and media segments as pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafmill.functions.ids import page_id

CHAT_ROW = "timestamp string, date string, sender string, `from` string, message string, text string"
PLACEHOLDER = "[UNTRANSCRIBED - ASR unavailable]"
STEP_SECONDS = 30
KEYFRAME_MS = 15_000


def chat_lines(rows: DataFrame, key: str, order: str, payload: str) -> DataFrame:
    """(key, text): the messages of each export as `[time] sender: message` lines, in order.

    The time is timestamp, else date; the sender sender, else from, else unknown; the text message, else text.
    Rows whose payload is no JSON object have no message; an export without any keeps an empty text."""
    is_object = F.trim(payload).startswith("{") & F.try_parse_json(payload).isNotNull()
    message = F.when(is_object, F.from_json(payload, CHAT_ROW, {"mode": "PERMISSIVE"}))
    parsed = rows.select(F.col(key), F.col(order).alias("_o"), message.alias("m"))
    first = lambda a, b, other: F.coalesce(F.nullif(F.col(f"m.{a}"), F.lit("")), F.nullif(F.col(f"m.`{b}`"), F.lit("")), F.lit(other))
    line = F.format_string("[%s] %s: %s", first("timestamp", "date", ""), first("sender", "from", "unknown"), first("message", "text", ""))
    lines = parsed.select(key, F.struct("_o", F.when(F.col("m").isNotNull(), F.trim(line)).alias("line")).alias("l"))
    ordered = F.array_sort(F.collect_list("l"))
    return lines.groupBy(key).agg(F.array_join(F.array_compact(F.transform(ordered, lambda x: x["line"])), "\n").alias("text"))


def csv_rows(rows: DataFrame, payload: str, header: str) -> DataFrame:
    """Lines of CSV exports with their fields by name, as the JSON payload that `chat_lines` reads."""
    fields = ", ".join(f"`{c.strip()}` string" for c in header.split(","))
    return rows.withColumn(payload, F.to_json(F.from_csv(F.col(payload), fields)))


def with_raw_text(lines: DataFrame, raw: DataFrame, key: str) -> DataFrame:
    """Exports whose messages are blank, with the file's own text in their place."""
    own = raw.select(key, F.col("text").alias("_raw"))
    kept = F.coalesce(F.nullif(F.trim("text"), F.lit("")), F.trim("_raw"), F.lit(""))
    return lines.join(own, key, "left").withColumn("text", kept).drop("_raw")


def dispatched(documents: DataFrame, families: dict) -> DataFrame:
    """Pages of all documents: each family's rows by its own function, in one table; families without a function yield none."""
    pages = None
    for family, extract in families.items():
        own = extract(documents.filter(F.col("doc_family") == family))
        pages = own if pages is None else pages.unionByName(own, allowMissingColumns=True)
    return pages


def media_segments(documents: DataFrame) -> DataFrame:
    """(document_id, page_id, page_number, start_ms, end_ms, source_pointer, text, confidence): stand-in segments of 30 s
    for audio and video that nothing has transcribed; 30 s where the duration is unknown, 1 s at least."""
    seconds = F.greatest(F.lit(1), F.floor(F.coalesce("audio_duration_seconds", "video_duration_seconds", F.lit(30.0)))).cast("int")
    media = documents.filter(F.col("doc_family").isin("audio", "video")).select("document_id", "doc_family", seconds.alias("d"))
    each = media.select("document_id", "doc_family", "d", F.posexplode(F.sequence(F.lit(0), F.col("d") - 1, F.lit(STEP_SECONDS))).alias("i", "s"))
    start, end = F.col("s") * 1000, F.least(F.col("d"), F.col("s") + STEP_SECONDS) * 1000
    frames = F.when(F.col("doc_family") == "video", f";keyframe_every_ms:{KEYFRAME_MS}").otherwise("")
    return each.select(
        "document_id",
        page_id(F.col("document_id"), F.col("i") + 1).alias("page_id"),
        (F.col("i") + 1).alias("page_number"),
        start.alias("start_ms"),
        end.alias("end_ms"),
        F.concat(F.format_string("timestamp:%d-%d", start, end), frames).alias("source_pointer"),
        F.lit(PLACEHOLDER).alias("text"),
        F.lit(0.1).alias("confidence"),
    )


def transcribed_segments(documents: DataFrame, segments: str = "segments") -> DataFrame:
    """Pages of media that a model has transcribed: one per segment of the array column, confidence .8, as media_segments has them."""
    each = documents.select("document_id", "doc_family", F.posexplode(segments).alias("i", "s"))
    frames = F.when(F.col("doc_family") == "video", f";keyframe_every_ms:{KEYFRAME_MS}").otherwise("")
    return each.select(
        "document_id",
        page_id(F.col("document_id"), F.col("i") + 1).alias("page_id"),
        (F.col("i") + 1).alias("page_number"),
        F.concat(F.format_string("timestamp:%d-%d", F.col("s.start_ms"), F.col("s.end_ms")), frames).alias("source_pointer"),
        F.col("s.start_ms").alias("start_ms"),
        F.col("s.end_ms").alias("end_ms"),
        F.trim("s.text").alias("text"),
        F.lit(0.8).alias("confidence"),
    )
