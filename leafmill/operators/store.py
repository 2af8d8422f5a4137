"""Tables as versioned snapshots: upserts, inserts of what is absent, deletes and derived statuses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest(rows: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """The last row of each key by an order; a key is read as nulls being equal."""
    w = Window.partitionBy(*keys).orderBy(*(F.col(o).desc_nulls_last() if isinstance(o, str) else o for o in order))
    return rows.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def upsert(table: DataFrame, changes: DataFrame, keys: list[str], order: str | None = None) -> DataFrame:
    """The table with the changes in place of rows of the same key; of several changes to a key the last by `order`.

    Only the changes are ranked; the table loses its replaced rows by an anti-join and is not sorted."""
    last = latest(changes, keys, [order]) if order else changes.dropDuplicates(keys)
    return table.join(last.select(*keys), keys, "left_anti").unionByName(last, allowMissingColumns=True)


def insert_absent(table: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """The table and those rows whose key it does not hold, one row a key."""
    new = rows.dropDuplicates(keys).join(table.select(*keys), keys, "left_anti")
    return table.unionByName(new, allowMissingColumns=True)


def without(table: DataFrame, column: str, values: list[str]) -> DataFrame:
    """The table without the rows of the given values; null values stay."""
    return table.filter(F.coalesce(~F.col(column).isin(*values), F.lit(True)))


def derived_status(documents: DataFrame, outputs: dict[str, DataFrame]) -> DataFrame:
    """(document_id, stage, status): done where a stage's output holds the document, else pending: no flag can lag behind."""
    rows = None
    for stage, table in outputs.items():
        held = table.select("document_id").distinct().withColumn("_held", F.lit(True))
        one = documents.select("document_id").join(held, "document_id", "left").select(
            "document_id", F.lit(stage).alias("stage"), F.when(F.col("_held"), "done").otherwise("pending").alias("status")
        )
        rows = one if rows is None else rows.unionByName(one)
    return rows


def append_json(rows: DataFrame, path: str) -> None:
    """Append rows as JSON lines with their keys in alphabetical order."""
    rows.select(*sorted(rows.columns)).write.mode("append").json(path)


def write_catalogue(documents: DataFrame, path: str) -> None:
    """The catalogue as JSON lines in order of creation, rewritten whole."""
    documents.orderBy("created_at", "document_id").write.mode("overwrite").json(path)
