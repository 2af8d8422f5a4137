import os
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from leafmill.llm.tokens import TOKENIZER_DIR, VOCABULARY, Encoder, token_counts, token_ids

tokenizers = pytest.importorskip("tokenizers")
PATH = os.path.join(TOKENIZER_DIR, VOCABULARY)
pytestmark = pytest.mark.skipif(not os.path.exists(PATH), reason="no vocabulary files here")


@pytest.fixture(scope="module")
def both():
    library = tokenizers.Tokenizer.from_file(PATH)
    library.encode_special_tokens = True
    own = Encoder()
    return (lambda t: library.encode(t, add_special_tokens=False).ids), (lambda t: own.encode([t])[0].tolist())


CASES = ["", " ", "\n\n", "a", "don't we'll they've I'M", "aaaa" * 300, "ab" * 900, "x" * 5000, "½ ¾ ² № Ⅷ", "\x01\x1c\x1f\x85  ", "<|endoftext|> stays text", "naïve café – cópia 請求書 🇩🇪👩‍🔬", "tabs\tand\r\nline ends\r\n\r\nkept  "]


@pytest.mark.parametrize("text", CASES)
def test_ids_equal_the_librarys(both, text):
    library, own = both
    assert own(text) == library(text)


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60))
def test_any_text(both, text):
    library, own = both
    assert own(text) == library(text)


def test_long_and_short_words_merge_alike(both):
    library, own = both
    r = random.Random(1)
    for size in (390, 400, 401, 2000):
        word = "".join(r.choice("abcdefgh") for _ in range(size))
        assert own(word) == library(word)


def test_null_empty_repeated_rows_and_clashing_columns(spark):
    frame = spark.createDataFrame([(1, None, "k"), (2, "", "k"), (3, "hello world", "k"), (3, "hello world", "k"), (None, "x", "k")], "doc_id long, text string, _key string")
    got = sorted(((r.doc_id, list(r.ids)) for r in token_ids(frame).collect()), key=repr)
    assert [i for k, i in got if k in (1, 2)] == [[], []]
    assert [i for k, i in got if k == 3] == [[31373, 995]] * 2
    assert [k for k, _ in got].count(None) == 1
    assert {r.doc_id: r.tokens for r in token_counts(frame).collect()}[3] == 2
    assert token_ids(frame.limit(0)).count() == 0


def test_flat_ids_and_counts_line_up():
    flat, counts = Encoder().encode(["one two", None, "", "three"])
    assert len(flat) == counts.sum() and counts.tolist()[1:3] == [0, 0] and isinstance(flat, np.ndarray)
