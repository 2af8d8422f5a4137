"""Cutting a plan's lineage in storage that every executor can read."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; where a local session leaves it unset, a temporary one that goes with the process.

    On a cluster spark.cleaner.referenceTracking.cleanCheckpoints removes what no plan refers to any more."""
    named = spark.sparkContext.getConf().get(SETTING) or spark.conf.get(SETTING, None)
    if named:
        return named
    if not (spark.sparkContext.master or "").startswith("local["):
        raise RuntimeError(f"set {SETTING} to a folder that all executors share")
    made = getattr(spark, "_leafmill_checkpoint", None)
    if made is None:
        made = spark._leafmill_checkpoint = tempfile.mkdtemp(prefix="leafmill-")
        atexit.register(shutil.rmtree, made, ignore_errors=True)
    return made


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder for tables of this application below the checkpoint folder; it can be removed after the application."""
    return f"{checkpoint_dir(spark).rstrip('/')}/leafmill-{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def artifact(spark: SparkSession, name: str, make: Callable[[], bytes]) -> bytes:
    """The bytes of a fitted model, from the shared folder if a session has left them there, else made and left there.

    The name must hold a digest of all that the model is made from."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    folder = f"{checkpoint_dir(spark).rstrip('/')}/leafmill-models"
    path = hadoop(f"{folder}/{name}")
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(path):
        stream = fs.open(path)
        try:
            return bytes(stream.readAllBytes())
        finally:
            stream.close()
    data = make()
    own = hadoop(f"{folder}/.{name}-{uuid.uuid4().hex}")
    out = fs.create(own, True)
    out.write(bytearray(data))
    out.close()
    if not fs.rename(own, path):  # another session was first
        fs.delete(own, False)
    return data


def cut(df: DataFrame) -> DataFrame:
    """The same rows, read back from a reliable checkpoint: later stages survive a lost executor and
    do not run the work above again."""
    context = df.sparkSession.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(checkpoint_dir(df.sparkSession))
    return df.checkpoint(eager=True)
