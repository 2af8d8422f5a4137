"""Text scoring, classification and shaping as Column expressions; all run inside the JVM.

`ascii_only` folds every other character to an underscore, which makes word boundaries mean the same
in every SQL engine; the same expressions take unfolded text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Below this score the text layer of a page is not good enough.
QUALITY_LEAST = 0.45

# --- Fixed values: words and marks of each page type. ---------------------------------------------------------------

INVOICE_WORDS = r"(?i)\b(invoice|receipt|bill to|ship to|subtotal|total due|tax|amount due|payment|line item)\b"
CHECK_BOXES = r"[☐☑✓✗□■]|\[\s*[xX\s]\s*\]"
FORM_LABELS = r"(?i)\b(name|date|signature|address|phone|email|ssn|dob)\s*[:\-_]"
COMMENT_WORDS = r"(?i)\b(comment|response|author|reply|note by|reviewed by)\b"
NUMBER_TOKEN = r"\b[\d,.$%]+\b"
WORD_OF_THREE = r"\b[a-zA-Z]{3,}\b"
LINE_END = r"\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85  ]"


def ascii_only(text: Column) -> Column:
    return F.regexp_replace(text, r"[^\x00-\x7F]", "_")


def stripped(text: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def collapsed(text: Column) -> Column:
    """Runs of white space as one space, none at the ends."""
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def filled_lines(text: Column) -> Column:
    """The lines that are not blank, stripped."""
    return F.filter(F.transform(F.split(text, LINE_END), stripped), lambda x: x != "")


def share(part: Column, whole: Column) -> Column:
    return F.try_divide(part.cast("double"), whole.cast("double"))


def quality_parts(text: Column) -> dict[str, Column]:
    """The measures that the quality score and the text layer gate read."""
    body = stripped(text)
    lines = filled_lines(body)
    return {
        "size": F.length(body),
        "alpha": share(F.length(F.regexp_replace(body, r"[^\p{L}]+", "")), F.length(body)),
        "printable": share(F.length(F.regexp_replace(body, r"[\p{C}\p{Z}&&[^ ]]+", "")), F.length(body)),
        "unique": share(F.size(F.array_distinct(F.split(body, ""))), F.least(F.length(body), F.lit(200))),
        "short_lines": share(F.size(F.filter(lines, lambda x: F.length(x) <= 2)), F.size(lines)),
        "spaces": share(F.length(F.regexp_replace(text, r"(?U)\S+", "")), F.greatest(F.lit(1), F.length(text))),
        "words": share(F.regexp_count(body, F.lit(WORD_OF_THREE)), F.greatest(F.lit(1.0), F.length(body) / 5.0)),
    }


def _score(p: dict[str, Column]) -> Column:
    one = F.lit(1.0)
    score = (
        0.25 * F.least(one, p["alpha"] / 0.5)
        + 0.20 * p["printable"]
        + 0.15 * F.least(one, p["unique"] / 0.3)
        + 0.15 * (one - F.coalesce(p["short_lines"], one))
        + 0.10 * (one - p["spaces"])
        + 0.15 * F.least(one, p["words"])
    )
    clamped = F.round(F.greatest(F.lit(0.0), F.least(one, score)), 3)
    size = F.coalesce(p["size"], F.lit(0))
    return F.when(size == 0, 0.0).when(size < 30, 0.1).otherwise(clamped)


def _fault(p: dict[str, Column]) -> Column:
    return (
        F.when(F.coalesce(p["size"], F.lit(0)) < 30, "empty_or_near_empty")
        .when(p["alpha"] < 0.20, "low_alpha_ratio")
        .when(p["short_lines"] > 0.5, "vertical_or_fragmented_text")
        .when(_score(p) < QUALITY_LEAST, "bad_text_layer")
    )


def quality_score(text: Column) -> Column:
    """0 to 1: letters, printable characters, variety, line lengths, white space and words; 0 for null and blank texts."""
    return _score(quality_parts(text))


def text_layer_fault(text: Column) -> Column:
    """Why a text layer is not good enough, or null where it is; the reasons are tried in this order."""
    return _fault(quality_parts(text))


def with_quality(df: DataFrame, text: str, score: str = "score", fault: str | None = None) -> DataFrame:
    """Adds the quality score of a text column, and its fault; the measures are worked out once for both."""
    parts = quality_parts(F.col(text))
    held = df.withColumn("_quality", F.struct(*(v.alias(k) for k, v in parts.items())))
    p = {k: F.col(f"_quality.{k}") for k in parts}
    added = {score: _score(p)} | ({fault: _fault(p)} if fault else {})
    return held.withColumns(added).drop("_quality")


def page_type(text: Column, confidence: Column) -> Column:
    """The kind of page by its words, marks and layout, tried from invoice to text."""
    body = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(body, LINE_END), lambda x: stripped(x) != "")
    n = F.size(lines)
    numeric = F.size(F.filter(lines, lambda x: F.regexp_count(x, F.lit(NUMBER_TOKEN)) >= 3))
    aligned = F.size(F.filter(lines, lambda x: F.regexp_count(x, F.lit(r"\s{2,}")) >= 2))
    tokens = F.filter(F.split(body, r"\s+"), lambda x: x != "")
    short = F.size(F.filter(tokens, lambda x: F.length(x) <= 3))
    return (
        F.when(stripped(body) == "", F.when(confidence < 0.2, "handwritten").otherwise("blank"))
        .when(F.regexp_count(body, F.lit(INVOICE_WORDS)) >= 2, "invoice")
        .when((F.regexp_count(body, F.lit(CHECK_BOXES)) >= 2) | (F.regexp_count(body, F.lit(FORM_LABELS)) >= 3), "form")
        .when((share(numeric, n) > 0.30) | (share(aligned, n) > 0.40), "table")
        .when((confidence < 0.35) & (confidence > 0) & (share(short, F.size(tokens)) > 0.5), "handwritten")
        .when(body.rlike(COMMENT_WORDS), "comment_box")
        .otherwise("text")
    )


def token_estimate(text: Column) -> Column:
    """About the tokens of a text: its length by four, at least one."""
    return F.greatest(F.lit(1), F.floor(F.length(text) / 4)).cast("int")


def word_set(text: Column) -> Column:
    """The different words of at least three letters, nothing else in them, in lower case."""
    tokens = F.filter(F.split(text, r"\s+"), lambda x: x.rlike(r"^\p{L}{3,}$"))
    return F.array_distinct(F.transform(tokens, F.lower))


def jaccard(a: Column, b: Column) -> Column:
    """Of two sets; 1 if both are empty, 0 if one is."""
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, 1.0).otherwise(F.size(F.array_intersect(a, b)) / union)


def first_sentence(text: Column) -> Column:
    return F.split(collapsed(text), r"(?<=[.!?])\s+", 2)[0]


def compact(text: Column, limit: int = 240) -> Column:
    """Collapsed text of at most `limit` characters, cut at a space and marked with an ellipsis."""
    body = collapsed(text)
    clipped = F.rtrim(F.substring(body, 1, limit - 1))
    return F.when(F.length(body) <= limit, body).otherwise(F.concat(F.regexp_replace(clipped, r" [^ ]*$", ""), F.lit("…")))


def label(text: Column, otherwise: str = "uncategorized documents") -> Column:
    """A group's label: collapsed, lower case, 80 characters."""
    return F.coalesce(F.nullif(F.rtrim(F.substring(F.lower(collapsed(text)), 1, 80)), F.lit("")), F.lit(otherwise))


def excerpt(text: Column, start: Column, end: Column, margin: int = 60) -> Column:
    """The text around [start, end), 0-based, with a margin; empty where end lies before start by more than the margins."""
    first = F.greatest(F.lit(0), start - margin)
    size = F.greatest(F.lit(0), F.least(F.length(text), end + margin) - first)
    return collapsed(F.substring(text, first + 1, size))


def safe_confidence(value: Column) -> Column:
    """Clamped to 0..1, a half where it is no number."""
    number = value.try_cast("double")  # greatest and least skip nulls
    return F.when(number.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(1.0), number))).otherwise(0.5)


def percentage(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part * 100.0, whole), F.lit(0.0))


def without_code_fence(text: Column) -> Column:
    """A model's reply without the fence of a code block around it."""
    return F.trim(F.regexp_replace(text, r"(?s)^\s*```[a-zA-Z]*\s*|\s*```\s*$", ""))


def hash_embedding(text: Column, dimensions: int) -> Column:
    """A deterministic stand-in for a hosted embedding: bytes of the text's sha256, from -1 to 1, over and over."""
    digest = F.sha2(text, 256)
    byte = lambda i: F.conv(F.substring(digest, (2 * (i % 32) + 1).cast("int"), F.lit(2)), 16, 10).cast("double")
    return F.transform(F.sequence(F.lit(0), F.lit(dimensions - 1)), lambda i: byte(i) / 255.0 * 2.0 - 1.0)


def cosine_distance(a: Column, b: Column) -> Column:
    """1 less the cosine; null where a vector is all zero or the lengths differ."""
    total = lambda v: F.aggregate(v, F.lit(0.0), lambda s, x: s + x)
    product = lambda v, w: total(F.zip_with(v, w, lambda x, y: x.cast("double") * y.cast("double")))
    return F.when(F.size(a) == F.size(b), 1.0 - F.try_divide(product(a, b), F.sqrt(product(a, a)) * F.sqrt(product(b, b))))
