"""The test tables as the inputs of the operators, in DataFrames and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.functions.text import ascii_only
from leafmill.operators.pages import first_of_each
from leafmill.tables import table

#: White space of any kind, for patterns of either engine.
SPACE = r"\t-\r \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
STRIP = f"'^[{SPACE}]+|[{SPACE}]+$'"
PAGES_SQL = "(SELECT * FROM page_results QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY created_at) = 1)"
FOLD_SQL = r"regexp_replace(text, '[^\x00-\x7F]', '_', 'g')"


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each page once: repeated rows fall to the earliest."""
    return first_of_each(table(spark, sf_dir, "page_results"), "page_id", "created_at")


def folded_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages(spark, sf_dir).withColumn("text", ascii_only(F.col("text")))


def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges without the rows that are repeated in all columns."""
    return table(spark, sf_dir, "relationships").distinct()


def calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as costly calls."""
    k = F.get_json_object("props", "$.k").cast("int")
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("stage"),
        F.concat(F.lit("step"), (k % 3).cast("string")).alias("step"),
        F.when(k % 5 == 0, "vision").otherwise("text").alias("call_type"),
        F.concat(F.lit("site"), (F.col("user_id") % 4).cast("string")).alias("location"),
        F.col("value").alias("duration_ms"),
        (k % 2 == 0).alias("cache_hit"),
        (F.col("event_type") != "error").alias("success"),
    )


CALLS_SQL = """(SELECT event_type AS stage, 'step' || (k % 3) AS step, CASE WHEN k % 5 = 0 THEN 'vision' ELSE 'text' END AS call_type,
    'site' || (user_id % 4) AS location, value AS duration_ms, k % 2 = 0 AS cache_hit, event_type <> 'error' AS success
    FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events))"""


def invoices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(document_id, text): an invoice or a pay stub for each order, with its line items."""
    orders, lines = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    money = lambda cents: F.concat((cents.cast("long") / F.lit(100)).cast("long").cast("string"), F.lit("."), F.lpad((cents.cast("long") % 100).cast("string"), 2, "0"))
    cents = lambda c: F.round(F.col(c) * 100).cast("long")
    sign = F.element_at(F.array(F.lit("$"), F.lit("€"), F.lit("£"), F.lit("")), (F.col("l_linenumber") % 4 + 1).cast("int"))
    item = F.concat(F.lit("Part "), F.col("l_partkey").cast("string"), F.lit(" delivered  "), sign, money(cents("l_extendedprice")))
    listed = lines.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", item.alias("t")))), lambda x: x["t"]), "\n").alias("items")
    )
    total = cents("o_totalprice")
    net = F.floor(total * F.when(F.col("o_orderkey") % 10 == 0, 11).otherwise(8) / 10).cast("long")
    head = F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit("Pay period: "), F.date_format("o_orderdate", "yyyy-MM"), F.lit("\nPay date: "), F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("\nGross pay: $"), money(total), F.lit("\nNet pay: $"), money(net)))
    other = F.when(F.col("o_orderkey") % 3 == 1, F.concat(F.lit("INVOICE "), F.col("o_orderkey").cast("string"), F.lit("\nTotal: €"), money(total))).otherwise(F.lit("Receipt for your order"))
    rows = orders.join(listed, "o_orderkey", "left")
    text = F.concat_ws("\n", F.coalesce(head, other), F.when(F.col("o_orderkey") % 7 != 0, F.col("items")))
    return rows.select(F.concat(F.lit("order_"), F.col("o_orderkey").cast("string")).alias("document_id"), text.alias("text"))


INVOICES_SQL = """(
    SELECT 'order_' || o_orderkey AS document_id, concat_ws(chr(10),
        CASE o_orderkey % 3
            WHEN 0 THEN 'Pay period: ' || strftime(o_orderdate, '%Y-%m') || chr(10) || 'Pay date: ' || strftime(o_orderdate, '%Y-%m-%d') || chr(10)
                || 'Gross pay: $' || (c // 100) || '.' || lpad((c % 100)::VARCHAR, 2, '0') || chr(10) || 'Net pay: $' || (n // 100) || '.' || lpad((n % 100)::VARCHAR, 2, '0')
            WHEN 1 THEN 'INVOICE ' || o_orderkey || chr(10) || 'Total: €' || (c // 100) || '.' || lpad((c % 100)::VARCHAR, 2, '0')
            ELSE 'Receipt for your order' END,
        CASE WHEN o_orderkey % 7 <> 0 THEN items END) AS text
    FROM (SELECT *, CAST(round(o_totalprice * 100) AS BIGINT) AS c,
            CAST(floor(CAST(round(o_totalprice * 100) AS BIGINT) * CASE WHEN o_orderkey % 10 = 0 THEN 11 ELSE 8 END / 10) AS BIGINT) AS n FROM orders)
    LEFT JOIN (SELECT l_orderkey, string_agg('Part ' || l_partkey || ' delivered  ' || [ '$', '€', '£', '' ][l_linenumber % 4 + 1]
            || (p // 100) || '.' || lpad((p % 100)::VARCHAR, 2, '0'), chr(10) ORDER BY l_linenumber, l_partkey) AS items
        FROM (SELECT *, CAST(round(l_extendedprice * 100) AS BIGINT) AS p FROM lineitem) GROUP BY l_orderkey) ON l_orderkey = o_orderkey)"""
