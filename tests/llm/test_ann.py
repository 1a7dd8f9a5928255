from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyledger.llm import ann

SCHEMA = "vec_id long, embedding array<float>, node string, vector string"


def brute(vectors: dict[int, np.ndarray], queries, k: int) -> dict[int, list[int]]:
    ids = np.array(sorted(vectors))
    x = np.array([vectors[i] for i in ids], dtype=np.float64)
    norms = np.linalg.norm(x, axis=1)
    out = {}
    for q in queries:
        own = vectors[q].astype(np.float64)
        score = x @ own / (norms * np.linalg.norm(own))
        order = sorted((i for i in range(len(ids)) if ids[i] != q), key=lambda i: (-round(score[i], 12), ids[i]))
        out[q] = [int(ids[i]) for i in order[:k]]
    return out


def found_by(rows) -> dict[int, list[int]]:
    out: dict[int, list[int]] = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append(r.vec_id)
    return out


def table(frame, vectors: dict, *more):
    return frame(SCHEMA, *[(int(k), [float(c) for c in v], "clash", "x") for k, v in vectors.items()], *more)


def test_small_tables_copies_ties_and_odd_vectors(frame):
    chance = np.random.default_rng(1)
    vectors = {k: chance.normal(size=6).astype(np.float32) for k in range(60)}
    for k in range(60, 90):
        vectors[k] = vectors[10]  # 31 equal vectors
    vectors[90] = (vectors[10] * 2).astype(np.float32)
    odd = [(200, None), (201, []), (202, [0.0] * 6), (203, [1.0, None] + [0.0] * 4), (204, [float("nan")] * 6), (205, [float("inf")] + [1.0] * 5), (206, [1.0, 2.0]), (None, [1.0] * 6)]
    docs = table(frame, vectors, *[(k, v, "", "") for k, v in odd])
    rows = ann.nearest_neighbours(docs, F.col("vec_id") % 5 == 0, 5).collect()
    want = brute(vectors, [k for k in vectors if k % 5 == 0], 5)
    assert found_by(rows) == want
    for r in rows:
        x, y = vectors[r.query_id].astype(float), vectors[r.vec_id].astype(float)
        assert r.score == pytest.approx(x @ y / np.sqrt((x @ x) * (y @ y)), abs=1e-12)


def test_fewer_candidates_repeated_rows_and_none(frame):
    docs = table(frame, {0: [1, 0], 1: [0, 1], 2: [1, 1]}, (2, [1.0, 1.0], "", ""), (50, [3.0, 0.0], "", ""))
    rows = ann.nearest_neighbours(docs, F.col("vec_id") % 50 == 0, 5).collect()
    assert found_by(rows) == {0: [50, 2, 1], 50: [0, 2, 1]}
    assert ann.nearest_neighbours(table(frame, {0: [1, 0]}), F.col("vec_id") == 0, 5).count() == 0
    assert ann.nearest_neighbours(docs.where("false"), F.col("vec_id") == 0, 5).count() == 0


def test_recall_with_several_buckets(frame, monkeypatch):
    monkeypatch.setattr(ann, "BUCKET", 60)
    chance = np.random.default_rng(2)
    vectors = {k: chance.normal(size=16).astype(np.float32) for k in range(900)}
    for k in range(900, 960):
        vectors[k] = (vectors[3] + 0.01 * chance.normal(size=16)).astype(np.float32)  # a dense group
    queries = [k for k in vectors if k % 50 == 0]
    found = found_by(ann.nearest_neighbours(table(frame, vectors), F.col("vec_id") % 50 == 0, 5).collect())
    want = brute(vectors, queries, 5)
    assert np.mean([len(set(found[q]) & set(want[q])) / 5 for q in queries]) >= 0.95


def test_near_copies_come_in_their_true_order(frame):
    chance = np.random.default_rng(5)
    first = chance.normal(size=64)
    vectors = {k: (first + 0.004 * chance.normal(size=64)).astype(np.float32) for k in range(400)}
    queries = [k for k in vectors if k % 20 == 0]
    found = found_by(ann.nearest_neighbours(table(frame, vectors), F.col("vec_id") % 20 == 0, 5).collect())
    want = brute(vectors, queries, 5)
    assert np.mean([len(set(found[q]) & set(want[q])) / 5 for q in queries]) >= 0.99


def test_best_lists():
    node, other = np.array([1, 1, 1, 2, 1]), np.array([5, 6, 5, 7, 8])
    got = ann.best_lists(node, other, np.array([0.1, 0.5, 0.1, 0.3, 0.5]), 2)
    assert [x.tolist() for x in got] == [[1, 1, 2], [6, 8, 7], [0.5, 0.5, 0.3]]


@pytest.mark.parametrize("scale", [1e200, 1e-200, 1e300, 1e-290])
def test_huge_and_tiny_components(frame, scale):
    chance = np.random.default_rng(9)
    plain = {k: chance.normal(size=8) for k in range(60)}
    rows = [(k, [float(c) for c in v * (scale if k % 2 else 1.0)], "", "") for k, v in plain.items()]
    docs = frame(SCHEMA.replace("float", "double"), *rows)
    got = ann.nearest_neighbours(docs, F.col("vec_id") % 10 == 0, 5).collect()
    assert found_by(got) == brute(plain, [k for k in plain if k % 10 == 0], 5)
    for r in got:
        x, y = plain[r.query_id], plain[r.vec_id]
        assert r.score == pytest.approx(x @ y / np.sqrt((x @ x) * (y @ y)), abs=1e-12)


def test_scaling_changes_no_score():
    x = np.random.default_rng(1).normal(size=(50, 16)).astype(np.float32).astype(np.float64)
    y = ann.in_range(x)
    assert ((x * x).sum(1) / (np.sqrt((x * x).sum(1)) * np.sqrt((x * x).sum(1))) == (y * y).sum(1) / (np.sqrt((y * y).sum(1)) * np.sqrt((y * y).sum(1)))).all()
    assert ((0.5 <= abs(y).max(1)) & (abs(y).max(1) < 1)).all()
