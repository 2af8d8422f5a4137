import hashlib

import pytest
from pyspark.sql import functions as F

from leafmill.functions import ids, payments
from leafmill.functions import text as T


def one(spark, value, expression, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(expression(F.col("x")).alias("y")).first().y


def test_ids_are_those_of_the_hashes(spark):
    digest = hashlib.sha256(b"abc").hexdigest()
    assert one(spark, "abc", lambda x: ids.document_id(ids.content_hash(x))) == "doc_" + digest[:12]
    assert one(spark, "d", lambda x: ids.chunk_id(ids.page_id(x, F.lit(3)), F.lit(12))) == "d_p0003_c0012"
    assert one(spark, " John  Smith", lambda x: ids.entity_id(F.lit("name"), x)) == "ent_" + hashlib.sha1(b"name:john smith").hexdigest()[:12]
    none = F.lit(None)
    edge = one(spark, "s", lambda x: ids.edge_id(x, F.lit("p"), F.lit("o"), F.lit("d"), none, none, F.lit(5)))
    assert edge == hashlib.sha1(b"s|p|o|d|None|None|5").hexdigest()[:16]
    event = one(spark, "d", lambda x: ids.fallback_event_id(x, none, F.lit("r"), none))
    assert event == hashlib.sha1(b"d||r|").hexdigest()[:16]


@pytest.mark.parametrize(
    "text,fault",
    [(None, "empty_or_near_empty"), ("", "empty_or_near_empty"), ("a" * 29, "empty_or_near_empty"), ("1 2 3 4 5 6 7 8 9 " * 4, "low_alpha_ratio"), ("a\n" * 40, "vertical_or_fragmented_text"),
     ("The committee met in March and heard the report of the harbour office.", None)],
)
def test_text_layer_faults(spark, text, fault):
    assert one(spark, text, T.text_layer_fault) == fault


def test_quality_score_bounds(spark):
    assert one(spark, None, T.quality_score) == 0.0
    assert one(spark, " \n ", T.quality_score) == 0.0
    assert one(spark, "x" * 29, T.quality_score) == 0.1
    assert 0.9 < one(spark, "The committee met in March and heard the report of the harbour office.", T.quality_score) <= 1.0


@pytest.mark.parametrize(
    "text,confidence,kind",
    [("", 0.19, "handwritten"), ("", 0.2, "blank"), ("invoice with subtotal and [x] [ ] boxes", 0.9, "invoice"), ("[x] yes [ ] no", 0.9, "form"), ("name: a date: b phone: c", 0.9, "form"),
     ("1 2 3\n4 5 6\nplain words here", 0.9, "table"), ("a  b  c\nd  e  f\nthird", 0.9, "table"), ("ab cd ef gh ij long words", 0.34, "handwritten"), ("ab cd ef gh ij long words", 0.0, "text"),
     ("a comment of the author", 0.9, "comment_box"), ("nothing special at all", 0.9, "text")],
)
def test_page_types_in_order(spark, text, confidence, kind):
    assert one(spark, text, lambda x: T.page_type(x, F.lit(confidence))) == kind


def test_shaping(spark):
    assert one(spark, "One. Two", T.first_sentence) == "One."
    assert one(spark, "word " * 60, T.compact).endswith("…") and len(one(spark, "word " * 60, T.compact)) <= 240
    assert one(spark, "  A  Label ", T.label) == "a label"
    assert one(spark, " ", T.label) == "uncategorized documents"
    assert one(spark, "x" * 50 + " here " + "y" * 50, lambda x: T.excerpt(x, F.lit(51), F.lit(55), 3)) == "xx here yy"
    assert one(spark, "0123456789", lambda x: T.excerpt(x, F.lit(9), F.lit(1), 2)) == ""
    assert [one(spark, v, T.safe_confidence) for v in ("0.3", "1.7", "-1", "abc", None)] == [0.3, 1.0, 0.0, 0.5, 0.5]
    assert one(spark, "```json\n{}\n```", T.without_code_fence) == "{}"


def test_jaccard_of_empty_sets(spark):
    pair = spark.createDataFrame([([], []), (["a"], []), (["a", "b"], ["b", "c"])], "a array<string>, b array<string>")
    assert [round(r.j, 3) for r in pair.select(T.jaccard(F.col("a"), F.col("b")).alias("j")).collect()] == [1.0, 0.0, 0.333]


def test_hash_embedding_is_the_bytes_of_the_hash(spark):
    digest = hashlib.sha256("text".encode()).digest()
    assert one(spark, "text", lambda x: T.hash_embedding(x, 40)) == [digest[i % 32] / 255.0 * 2.0 - 1.0 for i in range(40)]


def test_cosine_distance_leaves_out_what_has_none(spark):
    frame = spark.createDataFrame([([1.0, 0.0],), ([0.0, 0.0],), ([1.0],), (None,), ([-1.0, 0.0],)], "v array<double>")
    q = F.array(F.lit(1.0), F.lit(0.0))
    assert [r.d for r in frame.select(T.cosine_distance(F.col("v"), q).alias("d")).collect()] == [0.0, None, None, None, 2.0]


def test_payment_expressions(spark):
    assert [one(spark, v, payments.amount) for v in ("$1,234.50", "€ 5", "x", "", None)] == [1234.5, 5.0, None, None, None]
    assert [one(spark, v, payments.currency) for v in ("$1", "€2", "£3", "4", "x")] == ["USD", "EUR", "GBP", "USD", None]
    items = one(spark, "Bolts  $3.50\nno amount here\nLong nuts, M8  1,200\n", payments.line_items)
    assert [(i.description, i.amount, i.currency) for i in items] == [("Bolts", 3.5, "USD"), ("Long nuts, M8", 1200.0, "USD")]
    assert one(spark, "Your PAYMENT is due", payments.payment_type) == "payment_sheet"
    assert one(spark, "nothing", payments.looks_like_payment) is False
