"""Incremental runs as a stream of files: each trigger takes what is new and ends."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery


def available_now(
    spark: SparkSession, folder: str, schema: str, state: str, work: Callable[[DataFrame, int], None], files_at_once: int = 1_000
) -> StreamingQuery:
    """Process the parquet files of a folder that no earlier run has processed, then stop.

    `state` holds the progress: a run that dies is repeated from its last committed batch, a run without new files does
    nothing.  `work(rows, batch)` must write idempotently by content id (see VersionedTarget and insert_absent), as a batch
    may come twice."""
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_at_once).parquet(folder)
    return rows.writeStream.option("checkpointLocation", state).trigger(availableNow=True).foreachBatch(work).start()


def first_of_content(rows: DataFrame, key: str = "document_id") -> DataFrame:
    """Each content id once over the whole stream; the ids seen are the stream's state."""
    return rows.dropDuplicates([key])
