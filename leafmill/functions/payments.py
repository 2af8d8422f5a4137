"""Payment fields, line items and checks as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- Fixed values: the forms in which payments are written. --------------------------------------------------------

AMOUNT = r"[$€£]?\s*[0-9,]+(?:\.[0-9]{2})?"
PERIOD = r"(?i)pay\s*period\s*[:\-]?\s*([^\n]+)"
DATE = r"(?i)pay\s*date\s*[:\-]?\s*([^\n]+)"
GROSS = rf"(?i)gross\s*pay\s*[:\-]?\s*({AMOUNT})"
NET = rf"(?i)net\s*pay\s*[:\-]?\s*({AMOUNT})"
TOTAL = rf"(?i)\b(?:total|amount\s*due|subtotal|balance)\b\s*[:\-]?\s*({AMOUNT})"
ITEM = rf"(?i)^\s*([A-Za-z][A-Za-z0-9\s\-/,&().]{{1,80}}?)\s+({AMOUNT})\s*$"
HINTS = ("receipt", "invoice", "payment", "paid", "subtotal", "total", "amount due", "line item", "qty")
CURRENCIES = {"$": "USD", "€": "EUR", "£": "GBP"}

ITEM_TYPE = "array<struct<description:string,amount:double,currency:string>>"


def found(text: Column, pattern: str, group: int = 1) -> Column:
    """The first match's group, trimmed, or null."""
    return F.nullif(F.trim(F.regexp_extract(text, pattern, group)), F.lit(""))


def amount(value: Column) -> Column:
    """The number of a written amount, or null."""
    return F.regexp_replace(value, r"[$€£,\s]", "").try_cast("double")


def currency(value: Column) -> Column:
    """The code of a written amount's sign, USD without one, null where there is no amount."""
    sign = F.substring(F.trim(value), 1, 1)
    code = F.coalesce(*(F.when(sign == s, c) for s, c in CURRENCIES.items()), F.lit("USD"))
    return F.when(amount(value).isNotNull(), code)


def payment_type(text: Column) -> Column:
    low = F.lower(text)
    has = lambda *words: F.coalesce(*(F.when(low.contains(w), True) for w in words), F.lit(False))
    return (
        F.when(has("pay period", "gross pay", "net pay"), "pay_stub")
        .when(has("receipt"), "receipt")
        .when(has("invoice"), "invoice")
        .when(has("payment", "amount due"), "payment_sheet")
        .otherwise("payment_record")
    )


def looks_like_payment(text: Column) -> Column:
    low = F.lower(text)
    hint = F.coalesce(*(F.when(low.contains(w), True) for w in HINTS), F.lit(False))
    return hint | (F.regexp_count(text, F.lit(AMOUNT)) >= 2)


def line_items(text: Column) -> Column:
    """The lines that are a description and an amount."""
    # one match of the costly pattern a line: its groups come back parted by a control character
    lines = F.split(text, r"\r\n|[\n\r]")
    parted = F.filter(F.transform(lines, lambda x: F.split(F.regexp_replace(x, ITEM, "$1\u0001$2"), "\u0001")), lambda x: F.size(x) == 2)
    item = lambda x: F.struct(F.trim(x[0]).alias("description"), amount(x[1]).alias("amount"), currency(x[1]).alias("currency"))
    return F.filter(F.transform(parted, item), lambda x: x["amount"].isNotNull())


def clean_items(items: Column) -> Column:
    """Items given by a model: without those that hold neither description nor amount; null items are none."""
    kept = F.filter(items, lambda x: (F.coalesce(F.trim(x["description"]), F.lit("")) != "") | x["amount"].isNotNull())
    fixed = F.transform(
        kept,
        lambda x: F.struct(
            F.coalesce(F.nullif(F.trim(x["description"]), F.lit("")), F.lit("item")).alias("description"),
            x["amount"].alias("amount"),
            F.nullif(F.upper(F.trim(x["currency"])), F.lit("")).alias("currency"),
        ),
    )
    return F.coalesce(fixed, F.array().cast(ITEM_TYPE))


def notes(gross: Column, net: Column, items: Column, given: Column | None = None, others: Column | None = None) -> Column:
    """What is odd about a record, joined by commas, or null.  `others`: a further amount that counts as one."""
    amounts = F.coalesce(gross, net, others if others is not None else F.lit(None).cast("double"))
    found_none = F.when(amounts.isNull() & (F.size(items) == 0), "no_detectable_payment_amounts")
    exceeds = F.when(net > gross, "net_pay_exceeds_gross_pay")
    own = F.nullif(F.trim(given), F.lit("")) if given is not None else F.lit(None).cast("string")
    return F.nullif(F.concat_ws(",", found_none, exceeds, own), F.lit(""))
