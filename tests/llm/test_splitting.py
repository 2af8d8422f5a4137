import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from leafmill.llm import splitting as S
from tests.conftest import rows

KIND = "page_id string, document_id string, page_number int, text string, body string, rank int"


def whole(text, pieces, limit, overlap):
    """Whether pieces cover a text in order, within the limit, with exactly the overlap."""
    assert pieces[0][0] == 0 and pieces[-1][1] == len(text)
    for (a, b, _), (c, _, _) in zip(pieces, pieces[1:]):
        assert c == b - overlap and b - a <= limit
    assert all(b - a <= limit for a, b, _ in pieces)


@settings(max_examples=80, deadline=None)
@given(st.text(alphabet="ab .\n!。　", max_size=900), st.integers(20, 120))
def test_pieces_cover_any_text(text, limit):
    whole(text, S.cuts(text, limit, limit // 10), limit, limit // 10)


def test_hard_cuts_where_there_is_no_boundary():
    pieces = S.cuts("x" * 10_000)
    whole("x" * 10_000, pieces, 2_000, 200)
    assert {k for _, _, k in pieces[:-1]} == {"none"}


def test_the_cut_falls_where_the_topic_changes():
    r = random.Random(1)
    def topic(words, n):
        return " ".join(" ".join(r.choice(words) for _ in range(9)).capitalize() + "." for _ in range(n))

    first = topic("harbour vessel cargo quay crane tide anchor pilot".split(), 26)
    second = topic("patient clinic nurse dosage ward surgeon therapy blood".split(), 26)
    text = first + " " + second
    a, b, kind = S.cuts(text, 2_000, 200)[0]
    assert kind == "sentence" and abs(b - len(first) - 1) <= 70


def test_kinds_of_items(spark):
    words = "The clerk met the board. " * 100
    data = [
        ("p1", "d1", 1, words, "", 0), ("p1", "d1", 1, words, "", 0), ("p2", "d1", 2, "　" * 50 + "x" * 2000 + "\n", "", 0), ("p3", "d1", 3, "y" * 2001, "", 0),
        ("p4", "d1", 4, "z" * 1999 + " " + "z" * 1999, "", 0), ("p5", "d1", None, None, "", 0), ("p6", "d1", 5, "", "", 0), (None, "d1", 6, words, "", 0),
    ]
    data += [(f"b{i}", "big", i, "some text", "", 0) for i in range(1, 22)] + [("b1", "big", 1, "some text", "", 0)] + [(f"c{i}", "fair", i % 20, "text", "", 0) for i in range(60)]
    frame = spark.createDataFrame(data, KIND)
    assert rows(S.oversized(frame)) == [("big", "document"), ("p1", "page"), ("p3", "page_no_boundary"), ("p4", "page")]
    assert S.oversized(frame.limit(0)).count() == 0


@pytest.mark.parametrize("n", [21, 40, 499, 500, 501, 1_300])
def test_document_pieces_overlap_and_cover(spark, n):
    numbers = [3 * i for i in range(n)]
    frame = spark.createDataFrame([(f"p{i}", "d", i, f"word{i % 7} and word{i // 50}", "", 0) for i in numbers], KIND)
    pieces = sorted((r.first_page, r.last_page, r.pages) for r in S.document_pieces(frame).collect())
    assert pieces[0][0] == 0 and pieces[-1][1] == numbers[-1]
    assert all(p <= 20 for _, _, p in pieces)
    for (_, last, _), (first, _, _) in zip(pieces, pieces[1:]):
        assert first == last


def test_overlap_must_be_small():
    with pytest.raises(ValueError):
        S.cuts("x", 100, 50)
