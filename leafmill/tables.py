"""Reading the tables of a data directory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The parquet table `name` of a data directory (a file or a folder of part files)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(df: DataFrame, *columns: str) -> DataFrame:
    """Only the named columns, each taken by name, so that extra columns never clash."""
    return df.select(*(F.col(f"`{c}`") for c in columns))
