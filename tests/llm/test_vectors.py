import datetime as dt

import numpy as np
import pytest

from leafmill.llm import vectors as V
from tests.conftest import rows

KIND = "chunk_id string, embedding array<float>, embedding_version string, updated_at timestamp, unit string"
T = dt.datetime(2025, 1, 1)


def clusters(n, size, seed):
    r = np.random.default_rng(seed)
    centre = np.repeat(r.normal(size=(n, 64)), size, axis=0)
    return (centre + 0.12 * r.normal(size=centre.shape)) * r.uniform(0.2, 5, size=(len(centre), 1))


def brute(x, ids, k, least):
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    s = u @ u.T
    np.fill_diagonal(s, -2)
    found = set()
    for i in range(len(x)):
        for j in np.lexsort((ids, -s[i]))[:k]:
            if s[i, j] >= least:
                found.add(tuple(sorted((ids[i], ids[j]))))
    return found


def test_pairs_equal_brute_force(spark):
    x = clusters(150, 8, 1)
    ids = np.array([f"c{i:05d}" for i in range(len(x))])
    frame = spark.createDataFrame([(i, [float(v) for v in row], "v3", T, "u") for i, row in zip(ids, x)], KIND)
    got = {tuple(r) for r in V.similar_pairs(frame).collect()}
    want = brute(x.astype(np.float32).astype(float), ids, 5, 0.9)
    assert len(want) > 1_000 and len(got & want) / len(want) > 0.97 and len(got & want) / len(got) > 0.99


def test_equal_vectors_are_nearest_by_least_id(spark):
    x = clusters(5, 1, 2)
    data = [(f"a{i:03d}", [float(v) for v in x[0]], "v3", T, "") for i in range(300)] + [(f"b{i}", [float(v) for v in row], "v3", T, "") for i, row in enumerate(x[1:])]
    got = rows(V.similar_pairs(spark.createDataFrame(data, KIND)))
    ids = [f"a{i:03d}" for i in range(300)]
    want = {tuple(sorted((i, j))) for i in ids for j in [o for o in ids if o != i][:5]}
    assert set(got) == want


def test_only_live_vectors_count(spark):
    one = [1.0] * 64
    data = [
        ("a", one, "v3", T, ""), ("a", one, "v3", T, ""), ("b", [2.0] * 64, "v3", T, ""), ("c", one, "v2", T, ""), ("d", None, "v3", T, ""), ("e", [0.0] * 64, "v3", T, ""),
        ("f", [float("nan")] + [1.0] * 63, "v3", T, ""), ("g", [1.0] * 63, "v3", T, ""), (None, one, "v3", T, ""), ("h", one, None, T, ""), ("i", [None] + [1.0] * 63, "v3", T, ""),
    ]
    frame = spark.createDataFrame(data, KIND)
    assert rows(V.similar_pairs(frame)) == [("a", "b")]
    assert V.similar_pairs(frame.limit(0)).count() == 0
    assert V.similar_pairs(frame.filter("chunk_id = 'a'")).count() == 0


@pytest.mark.parametrize("axes,bits", [(2, 4), (3, 3)])
def test_hilbert_keys_walk_through_every_cell_by_single_steps(axes, bits):
    side = 1 << bits
    cells = np.stack(np.meshgrid(*[np.arange(side)] * axes, indexing="ij"), axis=-1).reshape(-1, axes)
    keys = V.hilbert_keys(cells, bits)
    assert sorted(keys.tolist()) == list(range(side**axes))
    path = cells[np.argsort(keys)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_recall_against_brute_force(spark):
    x = clusters(120, 8, 5)
    ids = [f"c{i:05d}" for i in range(len(x))]
    frame = spark.createDataFrame([(i, [float(v) for v in row], "v3", T, "u") for i, row in zip(ids, x)], KIND)
    got = V.recall(frame).first()
    assert got.queries > 5 and got.true_neighbours >= got.queries and got.recall >= 0.9
    live = V.live_vectors(frame)
    exact = {(r.chunk_id, r.other) for r in V.exact_neighbours(live, live, 5).collect()}
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    s = u @ u.T
    np.fill_diagonal(s, -2)
    want = {(ids[i], ids[j]) for i in range(len(x)) for j in np.argsort(-s[i])[:5]}
    assert len(exact & want) / len(want) > 0.999
    assert V.recall(frame.limit(0)).first().recall == 1.0


def test_windows_run_on_over_the_boundaries_of_ranges(spark, monkeypatch):
    x = clusters(200, 5, 7)
    x[400:700] = x[400] + 1e-4 * np.random.default_rng(3).normal(size=(300, 64))  # a third of all in one cell
    ids = np.array([f"c{i:05d}" for i in range(len(x))])
    frame = spark.createDataFrame([(i, [float(v) for v in row], "v3", T, "u") for i, row in zip(ids, x)], KIND)
    live = V.live_vectors(frame)
    monkeypatch.setattr(V, "WINDOW", 1_000)
    whole = {(r.a, r.b) for r in V.near_points(V.cut(V.points(live, 3)), 3).collect()}
    monkeypatch.setattr(V, "RANGE", 128)
    monkeypatch.setattr(V, "WINDOW", 60)
    found = V.cut(V.points(live, 3))
    keyed = V._keyed(found, 2, 64)
    bounds = V._bounds(keyed, 2, 1_000)
    assert bounds.shape == (2, 7, 3) and (np.diff(bounds, axis=2) >= 0).all()
    parts = {(r.a, r.b) for r in V.near_points(found, 3).collect()}
    assert len(whole & parts) / len(whole) > 0.6 and len({a for a, _ in parts}) == 1_000


def test_query_vectors_are_held_against_all(spark):
    x = clusters(40, 8, 9)
    frame = spark.createDataFrame([(f"c{i:05d}", [float(v) for v in row], "v3", T, "u") for i, row in enumerate(x)], KIND)
    some = V.neighbours(frame, 5, asked=V.every_fiftieth())
    every = V.neighbours(frame, 5).filter(V.every_fiftieth())
    assert rows(some) == rows(every) and len(rows(some)) > 0
