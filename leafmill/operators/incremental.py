"""Problem 7: processing only new or changed records.

The target is the state.  Every output row carries the key and the version (content hash) of the
record it was made from, so the work that is left is the source anti-joined with the target; there
is no watermark and no status flag that could run ahead of the data.  A run becomes visible by one
atomic rename of its manifest, and only if no other run was published since it read the target: a run
that dies before that leaves no trace, one that dies after it has finished, and repeating either
neither skips nor repeats a record.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.lineage import scratch

STAGES = ("ocr", "embed", "entities")
#: Segments of a target from which a run also writes them together as one.
COMPACT_AFTER = 32


def completed(attempts: DataFrame, runs: DataFrame, stages: tuple[str, ...] = STAGES) -> DataFrame:
    """(document_id, stage, sha256): the work that the log knows to be done, each once, as rows of a target.

    An attempt counts if its outcome is done and its run was not rolled back; a run that is missing
    from `runs` was not rolled back.  Repeated and late rows fall together in the aggregation, which
    combines before the shuffle, so a document with very many attempts is no hot key.
    """
    stage = F.lower(F.trim("stage"))
    rolled_back = (
        runs.filter(F.lower(F.trim("outcome")) == "rolled_back").select(F.col("run_id").alias("_undone")).distinct()
    )
    done = attempts.filter((F.lower(F.trim("outcome")) == "done") & stage.isin(*stages))
    done = done.select("document_id", stage.alias("stage"), "sha256", "run_id")
    return (
        done.filter(F.col("document_id").isNotNull() & F.col("sha256").isNotNull())
        .join(rolled_back, F.col("run_id") == F.col("_undone"), "left_anti")
        .select("document_id", "stage", "sha256")
        .distinct()
    )


def present_work(documents: DataFrame, stages: tuple[str, ...] = STAGES) -> DataFrame:
    """(document_id, stage, sha256): the source, a row for each stage of a document's present content.

    A document without id is no document.  Of several rows of one document the latest updated_at holds, then the greatest hash."""
    present = (
        documents.filter(F.col("document_id").isNotNull())
        .groupBy("document_id")
        .agg(F.max(F.struct("updated_at", "sha256"))["sha256"].alias("sha256"))
    )
    return present.select("document_id", F.explode(F.array(*map(F.lit, stages))).alias("stage"), "sha256")


def pending_work(
    documents: DataFrame, attempts: DataFrame, runs: DataFrame, stages: tuple[str, ...] = STAGES, path: str | None = None
) -> DataFrame:
    """(document_id, stage): what the next run of each stage has to work on.

    The log is published as the first version of a target of (document_id, stage) with the content's hash as version, and the
    source is anti-joined with that; where `path` names a target that already has a version, the log is not read again.  Without
    `path` the target stands in the session's shared folder.  Nulls: a document without hash matches no attempt and is pending for
    every stage.  Empty tables: no documents give no rows, no attempts give every stage.  Extra columns of any name are not read.
    """
    spark = documents.sparkSession
    target = VersionedTarget(spark, path or scratch(spark, "stages"), ("document_id", "stage"), "sha256")
    if not target.head():
        target.publish(completed(attempts, runs, stages), base=0)
    return target.pending(present_work(documents, stages)).select("document_id", "stage")


class StaleTarget(RuntimeError):
    """Another run has published since the version that this one read."""


class VersionedTarget:
    """A target table of immutable segments, published by manifests.

    `path/_manifests/NNNNNNNN.json` lists the segments of version N.  `pending` pins the version that it reads.  Publishing
    writes the segment, then the manifest under a temporary name, then renames it to the number after the pinned one; where
    another run has published since, it is refused and nothing of it becomes visible, so no record is worked on by two runs.
    The rename must be one step that fails if the name is taken, as on HDFS and local disks; an object store needs a committer
    with a conditional write in its place.
    """

    def __init__(self, spark: SparkSession, path: str, key: str | tuple[str, ...] = "key", version: str = "version"):
        self.spark, self.path, self.version = spark, path.rstrip("/"), version
        self.key = (key,) if isinstance(key, str) else tuple(key)
        self.base: int | None = None
        jvm = spark._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def head(self) -> int:
        """The number of the newest published version; 0 before the first."""
        folder = self._path(f"{self.path}/_manifests")
        if not self._fs.exists(folder):
            return 0
        names = (s.getPath().getName() for s in self._fs.listStatus(folder))
        return max((int(n[:8]) for n in names if n.endswith(".json") and n[:8].isdigit()), default=0)

    def _segments(self, number: int) -> list[str]:
        if not number:
            return []
        stream = self._fs.open(self._path(f"{self.path}/_manifests/{number:08d}.json"))
        try:
            return json.loads(bytes(stream.readAllBytes()))
        finally:
            stream.close()

    def read(self, number: int | None = None) -> DataFrame | None:
        """The rows of a published version (the newest, if none is named), the latest segment of each key; None before the first.

        All rows that a segment holds for a key stand together, so a record may yield many rows.  The segments are one scan,
        however many there are."""
        segments = self._segments(self.head() if number is None else number)
        if not segments:
            return None
        rows = self.spark.read.option("mergeSchema", len(segments) > 1).parquet(*(f"{self.path}/{s}" for s in segments))
        if len(segments) == 1:
            return rows
        # a segment's name begins with the number of the version that brought it
        rows = rows.withColumn("_segment", F.regexp_extract("_metadata.file_path", r"segment-(\d{8})-[0-9a-f]+/[^/]*$", 1))
        same = [F.col(f"_k{i}") == F.col(k) for i, k in enumerate(self.key)]
        newest = rows.groupBy(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(self.key))).agg(F.max("_segment").alias("_newest"))
        return rows.join(newest, [*same, F.col("_segment") == F.col("_newest")], "left_semi").drop("_segment")

    def pending(self, source: DataFrame) -> DataFrame:
        """The source rows whose (key, version) no row of the newest version was made from; that version is pinned.

        Null keys are not records; a null version equals a null version only."""
        self.base = self.head()
        for k in self.key:
            source = source.filter(F.col(k).isNotNull())
        done = self.read(self.base)
        if done is None:
            return source
        seen = done.select(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(self.key)), F.col(self.version).alias("_v"))
        same = [F.col(k) == F.col(f"_k{i}") for i, k in enumerate(self.key)]
        return source.join(seen, [*same, F.col(self.version).eqNullSafe(F.col("_v"))], "left_anti")

    def publish(self, rows: DataFrame, base: int | None = None) -> int:
        """Write `rows` as a new segment and make it visible; the number of the version.

        `base` is the version that the rows were made against: the pinned one, if it is not given, or else the newest.
        StaleTarget is raised if another version has come after it."""
        base = base if base is not None else self.base if self.base is not None else self.head()
        segment = self._segment(base + 1)
        rows.write.parquet(f"{self.path}/{segment}")
        return self._commit(base, [*self._segments(base), segment])

    def compact(self) -> int:
        """Write the segments of the newest version together as one and publish that; the number of the version."""
        base = self.head()
        rows = self.read(base)
        if rows is None:
            return base
        segment = self._segment(base + 1)
        rows.write.parquet(f"{self.path}/{segment}")
        return self._commit(base, [segment])

    def _segment(self, number: int) -> str:
        return f"segment-{number:08d}-{uuid.uuid4().hex}"

    def _commit(self, base: int, segments: list[str]) -> int:
        temporary = self._path(f"{self.path}/_manifests/.{segments[-1]}")
        out = self._fs.create(temporary, True)
        out.write(bytearray(json.dumps(segments).encode()))
        out.close()
        target = self._path(f"{self.path}/_manifests/{base + 1:08d}.json")
        if self._fs.exists(target) or not self._fs.rename(temporary, target):
            self._fs.delete(temporary, False)
            self._fs.delete(self._path(f"{self.path}/{segments[-1]}"), True)
            raise StaleTarget(f"version {base + 1} was published by another run; nothing of this one is visible")
        self.base = base + 1
        return base + 1

    def run(self, source: DataFrame, work) -> int:
        """One incremental run: `work` maps pending source rows to output rows that keep key and version.
        A record for which `work` gives no row is tried again by the next run.  Many segments are then written as one."""
        number = self.publish(work(self.pending(source)))
        return self.compact() if len(self._segments(number)) > COMPACT_AFTER else number


def source_version(*columns: Column | str) -> Column:
    """A content version over columns: equal for equal values, and nulls differ from empty strings."""
    return F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)
