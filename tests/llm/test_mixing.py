import os

import pytest
from pyspark.sql import functions as F

from leafmill.llm import mixing as M
from leafmill.llm.tokens import TOKENIZER_DIR, VOCABULARY

pytestmark = pytest.mark.skipif(not os.path.exists(os.path.join(TOKENIZER_DIR, VOCABULARY)), reason="no vocabulary files here")
KIND = "doc_id long, source string, text string, tokens string, bucket int"


@pytest.fixture(scope="module")
def made(spark):
    docs = [(i, "big" if i % 2 else "Big ", f"word number {i} " * (5 + i % 40), "", 0) for i in range(300)]
    docs += [(1000 + i, "small-one", "tiny text here " * 80, "", 0) for i in range(4)]
    docs += [(2000, None, "no source", "", 0), (2001, "big", None, "", 0), (2002, "big", "", "", 0), (2003, "other", "no target", "", 0), (1, "big", "word number 1 " * 6, "", 0)]
    targets = spark.createDataFrame([("big", 0.7, 1), ("small_one", 0.2, 3), ("absent", 0.1, 5)], "source string, target_share double, max_repeats int")
    mix, report = M.mixed(spark.createDataFrame(docs, KIND), targets, slot_tokens=32)
    return mix.toPandas(), {r.source: r for r in report.collect()}


def test_shares_reach_their_targets(made):
    mix, report = made
    assert report["absent"].mixed_tokens == 0 and report["absent"].target_share == 0.1
    for name in ("big", "small_one"):
        assert abs(report[name].reached_share - report[name].feasible_share) < 0.03
    assert report["big"].feasible_share == pytest.approx(0.7 / 0.9, abs=1e-6)


def test_no_document_is_used_too_often(made):
    mix, _ = made
    assert mix[mix.source == "small_one"].repeat.max() == 3 and mix[mix.source == "big"].repeat.max() == 1
    assert not mix.duplicated(["doc_id", "repeat", "first_token"]).any()


def test_slots_are_full_and_of_one_source(made):
    mix, _ = made
    assert (mix.groupby("slot").source.nunique() == 1).all()
    assert (mix.groupby("slot").tokens.sum() == 32).all()


def test_every_stretch_holds_the_sources_in_their_shares(made):
    mix, report = made
    order = mix.drop_duplicates("slot").sort_values("slot")
    if len(order) < 60:
        pytest.fail("too few slots")
    part = order.head(len(order) // 2)
    assert abs((part.source == "big").mean() - report["big"].feasible_share) < 0.06


def test_empty_tables(spark):
    docs = spark.createDataFrame([], KIND)
    targets = spark.createDataFrame([("big", 0.7, 1)], "source string, target_share double, max_repeats int")
    mix, report = M.mixed(docs, targets)
    assert mix.count() == 0 and report.first().reached_share == 0.0
    full = spark.createDataFrame([(1, "big", "a b c " * 100, "", 0)], KIND)
    mix, report = M.mixed(full, targets.limit(0))
    assert mix.count() == 0 and report.count() == 0


def test_a_total_bounds_the_mix(spark):
    docs = spark.createDataFrame([(i, "big", "a b c d e f g h " * 50, "", 0) for i in range(40)], KIND)
    targets = spark.createDataFrame([("big", 1.0, 1)], "source string, target_share double, max_repeats int")
    mix, _ = M.mixed(docs, targets, total_tokens=2_000)
    assert 1_900 <= mix.agg(F.sum("tokens")).first()[0] <= 2_000


@pytest.mark.parametrize("n", [60, 900])
def test_every_planned_slot_is_delivered(spark, n):
    docs = [(i, f"s{i % 7 % 3}", f"word {i} and some more of it " * (1 + i % 23), "", 0) for i in range(n)]
    targets = spark.createDataFrame([("s0", 0.5, 2), ("s1", 0.31, 3), ("s2", 0.19, 1)], "source string, target_share double, max_repeats int")
    mix, report = M.mixed(spark.createDataFrame(docs, KIND), targets, slot_tokens=64)
    rows = report.collect()
    assert all(r.planned_slots == r.mixed_slots and r.mixed_tokens == 64 * r.mixed_slots for r in rows)
    total = sum(r.mixed_slots for r in rows)
    assert total > 20 and sorted(r.slot for r in mix.select("slot").distinct().collect()) == list(range(total))
    assert all(abs(r.mixed_slots - r.feasible_share * total) < 3 for r in rows)


def test_a_bucketed_order_is_the_same_as_one_bucket(spark, monkeypatch):
    stock = spark.createDataFrame([(i, "a", 1 + i % 9, 1.0, 2) for i in range(500)], "doc_id long, source string, tokens long, target_share double, max_repeats int")
    targets = spark.createDataFrame([("a", 1.0, 2)], "source string, target_share double, max_repeats int")
    rows = M.plan(stock, targets, None, 16)
    turns = spark.createDataFrame([("a", 250)], "source string, turns long")
    one = {(r.doc_id, r.repeat): r.begin for r in M.laid_out(stock, turns, rows, 16).collect()}
    monkeypatch.setattr(M, "BUCKET_DOCUMENTS", 50)
    many = {(r.doc_id, r.repeat): r.begin for r in M.laid_out(stock, turns, rows, 16).collect()}
    assert one == many and len(one) > 500 and max(one.values()) < 4_000
