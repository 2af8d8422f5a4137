import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from leafmill.lineage import artifact
from leafmill.operators import incremental as I
from leafmill.operators.incremental import StaleTarget, VersionedTarget, pending_work, source_version
from tests.conftest import rows

DOCS = "document_id string, sha256 string, updated_at timestamp, done string, extra int"
ATTEMPTS = "document_id string, sha256 string, run_id int, stage string, outcome string, n int"
RUNS = "run_id int, outcome string"
T = dt.datetime(2025, 1, 1)


def test_pending_work_counts_done_attempts_of_the_present_content(spark):
    docs = spark.createDataFrame(
        [("a", "1", T, "x", 1), ("b", "2", T, None, 2), ("c", None, T, None, 3), ("d", "4", T, None, 4), (None, "9", T, None, 5), ("e", "5", T, None, 6), ("e", "6", T + dt.timedelta(1), None, 7)], DOCS
    )
    attempts = spark.createDataFrame(
        [
            ("a", "1", 1, "ocr", "done", 0), ("a", "1", 1, "ocr", "done", 0), ("a", "1", 2, "embed", "done", 0), ("a", "1", 3, "entities", "done", 0),
            ("b", "old", 1, "ocr", "done", 0), ("b", "2", 4, "embed", "done", 0), ("b", "2", 2, "entities", "failed", 0),
            ("d", "4", 5, "ocr", "done", 0), ("d", "4", None, "embed", "done", 0), ("d", None, 1, "entities", "done", 0), ("e", "5", 1, "ocr", "done", 0), (None, None, None, None, None, None),
        ], ATTEMPTS)
    runs = spark.createDataFrame([(1, "succeeded"), (2, "failed"), (3, "succeeded"), (4, "rolled_back"), (None, "rolled_back"), (4, "rolled_back")], RUNS)
    found = rows(pending_work(docs, attempts, runs))
    assert ("a", "ocr") not in found and ("a", "embed") not in found and ("a", "entities") not in found
    assert [s for d, s in found if d == "b"] == ["embed", "entities", "ocr"]
    assert [s for d, s in found if d == "c"] == ["embed", "entities", "ocr"]
    assert [s for d, s in found if d == "d"] == ["entities"]  # run 5 is unknown, so it was not rolled back
    assert [s for d, s in found if d == "e"] == ["embed", "entities", "ocr"]  # the later row holds
    assert None not in {d for d, _ in found}


def test_pending_work_on_empty_tables(spark):
    docs, attempts, runs = (spark.createDataFrame([], s) for s in (DOCS, ATTEMPTS, RUNS))
    assert pending_work(docs, attempts, runs).count() == 0
    one = spark.createDataFrame([("a", "1", T, None, None)], DOCS)
    assert pending_work(one, attempts, runs).count() == 3


def test_target_runs_each_record_once_and_again_after_a_change(spark, tmp_path):
    target = VersionedTarget(spark, str(tmp_path / "t"))
    source = spark.createDataFrame([("a", "1"), ("b", "1"), (None, "1"), ("c", None)], "key string, version string")
    double = lambda df: df.withColumn("out", F.concat("key", F.lit("!")))
    assert target.run(source, double) == 1
    assert target.pending(source).count() == 0
    changed = spark.createDataFrame([("a", "2"), ("b", "1"), ("c", None), ("d", "1")], "key string, version string")
    assert rows(target.pending(changed).select("key")) == [("a",), ("d",)]
    assert target.run(changed, double) == 2
    assert rows(target.read().select("key", "version", "out")) == [("a", "2", "a!"), ("b", "1", "b!"), ("c", None, "c!"), ("d", "1", "d!")]


def test_a_failed_run_leaves_nothing_visible(spark, tmp_path):
    target = VersionedTarget(spark, str(tmp_path / "t"))
    source = spark.createDataFrame([("a", "1")], "key string, version string")

    def broken(df):
        return df.withColumn("out", F.raise_error(F.lit("lost")).cast("string"))

    with pytest.raises(Exception):
        target.run(source, broken)
    assert target.read() is None and target.pending(source).count() == 1
    assert target.run(source, lambda df: df) == 1


def test_the_second_of_two_interleaved_runs_is_refused(spark, tmp_path):
    source = spark.createDataFrame([("a", "1"), ("b", "1")], "key string, version string")
    one, two = (VersionedTarget(spark, str(tmp_path / "t")) for _ in range(2))
    work = [t.pending(source) for t in (one, two)]  # both read version 0
    assert one.publish(work[0]) == 1
    with pytest.raises(StaleTarget):
        two.publish(work[1])
    assert two.read().count() == 2 and two.pending(source).count() == 0
    assert len([p for p in (tmp_path / "t").iterdir() if p.name.startswith("segment")]) == 1
    later = spark.createDataFrame([("a", "2")], "key string, version string")
    assert two.run(later, lambda df: df) == 2
    with pytest.raises(StaleTarget):
        one.publish(later)  # still at version 1


def test_segments_are_compacted_without_a_change_of_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(I, "COMPACT_AFTER", 3)
    target = VersionedTarget(spark, str(tmp_path / "t"), ("key", "part"))
    for i in range(4):
        source = spark.createDataFrame([("a", i, str(i)), ("b", 0, "x"), (f"c{i}", None, "1"), (f"c{i}", 7, "1")], "key string, part int, version string")
        target.run(source, lambda df: df.withColumn("out", F.lit(i)))
    assert target.head() == 5 and len(target._segments(5)) == 1
    assert rows(target.read().select("key", "part", "version", "out")) == sorted(
        [("a", i, str(i), i) for i in range(4)] + [("b", 0, "x", 0)] + [(f"c{i}", 7, "1", i) for i in range(4)], key=repr
    )
    assert rows(target.read(4).select("key", "part", "version", "out")) == rows(target.read(5).select("key", "part", "version", "out"))


def test_pending_work_reads_a_published_target(spark, tmp_path):
    docs = spark.createDataFrame([("a", "1", T, "x", 1), ("b", "2", T, None, 2)], DOCS)
    attempts = spark.createDataFrame([("a", "1", 1, "ocr", "done", 0)], ATTEMPTS)
    runs = spark.createDataFrame([], RUNS)
    path = str(tmp_path / "t")
    assert pending_work(docs, attempts, runs, path=path).count() == 5
    target = VersionedTarget(spark, path, ("document_id", "stage"), "sha256")
    target.run(I.present_work(docs), lambda df: df.filter("stage = 'embed'"))
    assert rows(pending_work(docs, attempts, runs, path=path)) == [("a", "entities"), ("b", "entities"), ("b", "ocr")]


def test_source_version_tells_null_from_empty(spark):
    frame = spark.createDataFrame([(None, "a"), ("", "a"), ("", "a")], "x string, y string")
    a, b, c = (r.v for r in frame.select(source_version("x", "y").alias("v")).collect())
    assert a != b and b == c


def test_an_artifact_is_made_once(spark):
    made = []
    make = lambda: made.append(1) or bytes(range(256))
    name = f"model-{uuid.uuid4().hex}"
    assert artifact(spark, name, make) == artifact(spark, name, make) == bytes(range(256)) and len(made) == 1
