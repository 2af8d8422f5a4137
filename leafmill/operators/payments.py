"""Payment records from texts and from a model's answers."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leafmill.functions import payments as P
from leafmill.functions.ids import payment_id
from leafmill.functions.text import without_code_fence


def extracted(texts: DataFrame, key: str, text: str) -> DataFrame:
    """(key, document_type, pay_period, pay_date, gross_pay, net_pay, total, currency, items, notes) by patterns alone."""
    t = F.col(text)
    raw = {name: P.found(t, pattern) for name, pattern in (("gross", P.GROSS), ("net", P.NET), ("total", P.TOTAL))}
    rows = texts.select(
        key,
        P.payment_type(t).alias("document_type"),
        P.found(t, P.PERIOD).alias("pay_period"),
        P.found(t, P.DATE).alias("pay_date"),
        *(P.amount(v).alias(f"{n}_pay" if n != "total" else n) for n, v in raw.items()),
        F.coalesce(*(P.currency(v) for v in raw.values())).alias("_currency"),
        P.line_items(t).alias("items"),
    )
    rows = rows.withColumn("currency", F.coalesce("_currency", F.get("items", F.lit(0))["currency"])).drop("_currency")
    return rows.withColumn("notes", P.notes(F.col("gross_pay"), F.col("net_pay"), F.col("items"), others=F.col("total")))


def normalised(records: DataFrame) -> DataFrame:
    """A model's records with defaults, clean items, numbers and notes.

    Columns: document_type, pay_period, pay_date, gross_pay, net_pay, currency (strings), items, notes."""
    text = lambda c: F.nullif(F.trim(c), F.lit(""))
    number = lambda c: F.col(c).try_cast("double")
    wrong = (F.col("gross_pay").isNotNull() & number("gross_pay").isNull()) | (F.col("net_pay").isNotNull() & number("net_pay").isNull())
    items = P.clean_items(F.col("items"))
    notes = F.concat_ws(",", P.notes(number("gross_pay"), number("net_pay"), items), F.when(wrong, "invalid_numeric_pay_fields"), text("notes"))
    return records.withColumns(
        {
            "document_type": F.coalesce(text(F.lower("document_type")), F.lit("payment_record")),
            "pay_period": text("pay_period"),
            "pay_date": text("pay_date"),
            "currency": text(F.upper("currency")),
            "notes": F.nullif(notes, F.lit("")),
            "items": items,
            "gross_pay": number("gross_pay"),
            "net_pay": number("net_pay"),
        }
    )


def with_ids(records: DataFrame, order: str) -> DataFrame:
    """Adds paystub_id: records of a document count from 1 in the given order."""
    index = F.row_number().over(Window.partitionBy("document_id").orderBy(order))
    return records.withColumn("paystub_id", payment_id(F.col("document_id"), index, F.col("pay_date"), F.col("document_type")))


def evidence_page(records: DataFrame, chunk_pages: DataFrame) -> DataFrame:
    """(paystub_id, page_number): the page of the first evidence chunk that has one."""
    each = records.select("paystub_id", F.posexplode("evidence_chunk_ids").alias("pos", "chunk_id"))
    joined = each.join(chunk_pages.select("chunk_id", "page_number"), "chunk_id", "left").filter(F.col("page_number").isNotNull())
    return joined.groupBy("paystub_id").agg(F.min_by("page_number", "pos").alias("page_number"))


RECORDS = (
    "records array<struct<document_type: string, pay_period: string, pay_date: string, gross_pay: string, net_pay: string, currency: string,"
    " items: array<struct<description: string, amount: double, currency: string>>, notes: string, evidence_chunk_ids: array<string>>>"
)


def records_of(answers: DataFrame, answer: str = "answer") -> DataFrame:
    """(document_id, record_index, record fields): the records of a model's answers, from 1, in order; an answer that is no object with
    a list of records gives none."""
    parsed = F.from_json(without_code_fence(F.col(answer)), RECORDS)
    rows = answers.select("document_id", F.posexplode(parsed["records"]).alias("_i", "r"))
    return rows.filter(F.col("r").isNotNull()).select("document_id", (F.col("_i") + 1).alias("record_index"), "r.*")


def payments_from(answers: DataFrame, chunk_pages: DataFrame) -> DataFrame:
    """Payment records ready to be upserted: normalised, with id, validation_status and the page of their evidence."""
    rows = with_ids(normalised(records_of(answers)), "record_index")
    rows = rows.withColumn("validation_status", F.when(F.col("notes").isNull(), "valid").otherwise("needs_review"))
    return rows.join(evidence_page(rows, chunk_pages), "paystub_id", "left")
