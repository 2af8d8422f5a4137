"""What a session needs so that executors find this package."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def share_code(spark: SparkSession) -> SparkSession:
    """Put this checkout on the Python path of the workers; a cluster without it takes the package by --py-files."""
    environment = spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in known:
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, *known]))
    return spark


def spread(df: DataFrame) -> DataFrame:
    """Rows of a scan in at least as many parts as tasks run at once, for work that costs far more than reading.

    A small file is one part however much work its rows are; a large table has many parts and is left alone, without a
    shuffle.  Plans that already hold a shuffle are left alone too."""
    plan = df._jdf.queryExecution().executedPlan()
    if plan.nodeName().startswith("AdaptiveSparkPlan"):
        return df
    at_once = df.sparkSession.sparkContext.defaultParallelism
    parts = df._jdf.queryExecution().toRdd().getNumPartitions()
    return df.repartition(at_once) if parts < at_once else df
