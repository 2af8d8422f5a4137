import numpy as np
import pytest

from leafmill.llm import names as N
from tests.conftest import rows

REGISTRY = [
    ("e1", "Judith Halvorsen", "person", []),
    ("e2", "Victor Halvorsen", "person", ["V. Halvorsen"]),
    ("e3", "Elizabeth K. Brandtmoor", "person", []),
    ("e4", "Jürgen Köhlerström", "person", []),
    ("e5", "Brandtfeld Foods Ltd", "organization", ["BRAFL"]),
    ("e6", "Brandtfeld Logistics Group", "organization", []),
    ("e7", "Skovgard Software GmbH", "organization", []),
]
CASES = [
    ("Judith Halvorsen", [], "e1"), ("HALVORSEN Judy", [], "e1"), ("Halvorsen, J.", [], "e1"), ("Ms. Judith  Halvrosen", [], "e1"), ("JudithHalvorsen", [], "e1"),
    ("judyhalvorsen", [], "e1"), ("Vic Halvorsen", [], "e2"), ("Anna Halvorsen", [], None), ("A. Halvorsen", [], None), ("Beth Brandtmoor", [], "e3"),
    ("Brandtmoor, Elizabeth K.", [], "e3"), ("Elizabeth T. Brandtmoor", [], None), ("Juergen Koehlerstroem", [], "e4"), ("Dr. Jurgen Kohlerstrom", [], "e4"),
    ("Brandtfeld Fds Limited", [], "e5"), ("The Brandtfeld Foods Company", [], "e5"), ("Foods Brandtfeld, Ltd", [], "e5"), ("BRAFL", [], "e5"), ("B.R.A.F.L.", [], "e5"),
    ("Brandtfeld Log. Grp", [], "e6"), ("Brandtfeld Dental Ltd", [], None), ("Skovgard S/W", [], "e7"), ("SkovgardSoftware", [], "e7"), ("Skovgard Software (Halden)", [], "e7"),
    ("J. Halvorsen", ["James Halvorsen"], None), ("Halden Depot", [], None), ("", ["Judith Halvorsen"], "e1"), (None, [], None),
]


@pytest.fixture(scope="module")
def registry(spark):
    return spark.createDataFrame(REGISTRY, "entity_id string, canonical_name string, kind string, aliases array<string>")


def test_cards_find_their_entity(spark, registry):
    cards = spark.createDataFrame([(i, "x", name, aliases, "e") for i, (name, aliases, _) in enumerate(CASES)], "card_id long, kind string, canonical_name string, aliases array<string>, entity_id string")
    got = dict(rows(N.linked_cards(cards, registry)))
    assert {CASES[i][0]: got.get(i) for i in range(len(CASES))} == {name: want for name, _, want in CASES}


def test_blocks_of_the_registry_give_the_same(spark, registry, monkeypatch):
    cards = spark.createDataFrame([(i, name, aliases) for i, (name, aliases, _) in enumerate(CASES)], "card_id long, canonical_name string, aliases array<string>")
    whole = rows(N.linked_cards(cards, registry))
    monkeypatch.setattr(N, "BLOCK_ENTRIES", 2)
    monkeypatch.setattr(N, "BLOCK_NAMES", 5)
    assert rows(N.linked_cards(cards, registry)) == whole


def test_repeats_null_aliases_and_empty_tables(spark, registry):
    kind = "card_id long, canonical_name string, aliases array<string>"
    cards = spark.createDataFrame([(1, "Judith Halvorsen", None), (1, "Judith Halvorsen", None), (2, None, None), (3, "請求書", ["", None])], kind)
    assert rows(N.linked_cards(cards, registry)) == [(1, "e1")]
    assert N.linked_cards(cards.limit(0), registry).count() == 0
    assert N.linked_cards(cards, registry.limit(0)).count() == 0


@pytest.mark.parametrize("a,b,d", [("abcd", "abcd", 0), ("abcd", "abdc", 1), ("abcd", "abc", 1), ("abcd", "wxyz", 3), ("abcd", "xbcd", 1)])
def test_distance(a, b, d):
    assert N.distance(a, b, 2) == min(d, 3)


def test_cosines_equal_brute_force():
    weights = np.random.default_rng(1).uniform(0.5, 3, 2 << N.BITS).astype(np.float32)
    ids, names, kinds, aliases = zip(*REGISTRY)
    block = N.Block(ids, names, kinds, aliases, weights)
    typed = [name for name, _, _ in CASES if name and name.strip()]

    def vector(name):
        _, gram, weight = N.weighted([name], weights)
        return dict(zip(gram.tolist(), weight.tolist()))

    found = {(i, int(e)): s for i, entries, linkage in block.near(typed) for e, s in zip(entries, linkage)}
    for i, name in enumerate(typed):
        v = vector(name)
        for e, (n, k, a) in enumerate(zip(names, kinds, aliases)):
            cosines = [sum(x * vector(f).get(g, 0) for g, x in v.items()) for f in N.forms(k, n, a)]
            assert (max(cosines) >= N.LEAST) == ((i, e) in found)
            if (i, e) in found:
                assert found[i, e] == pytest.approx(np.mean(cosines), abs=1e-5)


def test_no_list_of_candidates_is_cut(spark):
    """Forty entries of one surname: the one that a nickname means is found, however many look nearer."""
    first = [g.split()[0] for g in N.FAMILIAR.replace("\n", " ").split("|")]
    entries = [(f"e{i:02d}", f"{f} Bobberstromsen", "person", []) for i, f in enumerate(f for f in first if f not in ("robert", "hubert"))]
    entries += [("robert", "Robert Bobberstromsen", "person", [])]
    registry = spark.createDataFrame(entries, "entity_id string, canonical_name string, kind string, aliases array<string>")
    cards = spark.createDataFrame([(1, "Bobby Bobberstromsen", [])], "card_id long, canonical_name string, aliases array<string>")
    assert len(entries) > 60 and rows(N.linked_cards(cards, registry)) == [(1, "robert")]


def test_alike_by_pairs_of_letters_is_no_narrower_than_by_distance():
    r = np.random.default_rng(5)
    for _ in range(3_000):
        word = "".join(r.choice(list("abcdeghilmnorstu"), r.integers(4, 16)))
        other = list(word)
        for _ in range(r.integers(0, 4)):
            i = int(r.integers(0, len(other)))
            other[i : i + r.integers(0, 2)] = list(r.choice(list("abcdet"), r.integers(0, 2)))
            if len(other) < 3:
                break
            if r.random() < 0.5:
                j = int(r.integers(0, len(other) - 1))
                other[j], other[j + 1] = other[j + 1], other[j]
        other = "".join(other)
        most = N.allowed(max(len(word), len(other)))
        p, q = N.plain_umlauts(word), N.plain_umlauts(other)
        assert N.alike(word, other) == (N.distance(word, other, most) <= most or N.distance(p, q, most) <= most - (most > 1))


def test_distance_equals_the_table_of_distances():
    r = np.random.default_rng(6)
    for _ in range(2_000):
        a, b = ("".join(r.choice(list("abc"), r.integers(0, 9))) for _ in range(2))
        table = np.zeros((len(a) + 1, len(b) + 1), int)
        table[:, 0], table[0, :] = np.arange(len(a) + 1), np.arange(len(b) + 1)
        for i in range(1, len(a) + 1):
            for j in range(1, len(b) + 1):
                table[i, j] = min(table[i - 1, j] + 1, table[i, j - 1] + 1, table[i - 1, j - 1] + (a[i - 1] != b[j - 1]))
                if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                    table[i, j] = min(table[i, j], table[i - 2, j - 2] + 1)
        for most in (1, 2, 9):
            assert N.distance(a, b, most) == min(table[-1, -1], most + 1)
