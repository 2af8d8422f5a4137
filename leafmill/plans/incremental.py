"""Registered queries of problem 7."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from leafmill.operators.incremental import pending_work
from leafmill.tables import table


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pending_work(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "stage_attempts"), table(spark, sf_dir, "stage_runs")
    )


QUERIES = {"p7_found": p7_found}

SQL = {
    "p7_found": """
        SELECT d.document_id, s.stage
        FROM documents d CROSS JOIN (VALUES ('ocr'), ('embed'), ('entities')) AS s(stage)
        WHERE NOT EXISTS (
            SELECT 1 FROM stage_attempts a
            WHERE a.document_id = d.document_id AND a.stage = s.stage AND a.sha256 = d.sha256 AND a.outcome = 'done'
              AND NOT EXISTS (SELECT 1 FROM stage_runs r WHERE r.run_id = a.run_id AND r.outcome = 'rolled_back'))
    """,
}
