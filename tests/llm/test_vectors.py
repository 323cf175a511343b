from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from quartier.llm import vectors


def exact(rows: dict[int, np.ndarray], queries: list[int], k: int) -> dict[int, list[int]]:
    ids = np.array(list(rows))
    matrix = np.stack(list(rows.values()))
    out = {}
    for q in queries:
        scores = (matrix * rows[q]).sum(axis=1)
        order = [int(i) for i in ids[np.lexsort((ids, -scores))] if i != q]
        out[q] = order[:k]
    return out


def table(spark, rows, more=()):
    data = [(i, v if v is None or isinstance(v, list) else [float(x) for x in v], "?", "?") for i, v in [*rows.items(), *more]]
    return spark.createDataFrame(data, "vec_id long, embedding array<float>, rank string, list string").repartition(3)


def test_recall_and_scores(spark):
    random = np.random.default_rng(2)
    rows = {i: (random.normal(size=24) * (1 + i % 3)).astype(np.float32).astype(float) for i in range(1500)}
    got = vectors.neighbours(table(spark, rows), F.col("vec_id") % 20 == 0, k=10).collect()
    want = exact(rows, [i for i in rows if i % 20 == 0], 10)
    found = {(r.query_id, r.vec_id) for r in got}
    assert len(found) == len(got) == 75 * 10
    assert sum((q, v) in found for q, own in want.items() for v in own) / 750 >= 0.9
    for r in got:
        assert r.query_id != r.vec_id and abs(r.score - float(rows[r.query_id] @ rows[r.vec_id])) < 1e-9
    for q in want:
        own = sorted((r for r in got if r.query_id == q), key=lambda r: r.rank)
        assert [r.rank for r in own] == list(range(1, 11))
        assert [(-r.score, r.vec_id) for r in own] == sorted((-r.score, r.vec_id) for r in own)


def test_all_lists_probed_is_exact(spark):
    random = np.random.default_rng(3)
    rows = {i: random.normal(size=8).round(1).astype(np.float32).astype(float) for i in range(200)}
    got = vectors.neighbours(table(spark, rows), F.col("vec_id") % 20 == 0, k=5, probed=1.0).collect()
    for q, own in exact(rows, [i for i in rows if i % 20 == 0], 5).items():
        assert [r.vec_id for r in sorted(got, key=lambda r: r.rank) if r.query_id == q] == own


def test_edge_rows(spark, monkeypatch):
    monkeypatch.setattr(vectors, "TILE", 16)
    same = {i: np.array([1.0, 2.0]) for i in range(100)}
    odd = [(200, None), (220, [0.0, 0.0]), (240, [1.0, None]), (260, [float("nan"), 1.0]), (280, [float("inf"), 1.0]),
           (300, []), (320, [1.0, 2.0, 3.0]), (None, [1.0, 2.0]), (0, [1.0, 2.0])]
    got = vectors.neighbours(table(spark, same, odd), F.col("vec_id") % 20 == 0, k=20).collect()
    assert {r.query_id for r in got} == {0, 20, 40, 60, 80}
    for q in (0, 20, 40, 60, 80):
        own = [r.vec_id for r in sorted(got, key=lambda r: r.rank) if r.query_id == q]
        assert own == [i for i in range(21) if i != q][:20]
    few = table(spark, {0: np.array([1.0, 0.0]), 1: np.array([0.0, 1.0])})
    assert [(r.query_id, r.vec_id) for r in vectors.neighbours(few, F.col("vec_id") == 0).collect()] == [(0, 1)]
    assert vectors.neighbours(few.limit(0), F.col("vec_id") == 0).count() == 0


def scanned(rows, queries, k):
    which, place = vectors.scan(np.ascontiguousarray(rows.T, dtype=np.float32), queries.astype(np.float32), k)
    far = ((queries[:, None, :] - rows[None, :, :]) ** 2).sum(axis=2)
    return [place[which == q] for q in range(len(queries))], np.argsort(far, axis=1, kind="stable")[:, :k]


def test_scan_takes_many_queries_and_keeps_little_more_than_the_nearest():
    random = np.random.default_rng(5)
    even = random.normal(size=(3000, 64))
    even /= np.linalg.norm(even, axis=1)[:, None]
    places = random.normal(size=(150, 64)) * 4
    clustered = (places[:, None, :] + random.normal(size=(150, 20, 64)) * 0.05).reshape(-1, 64)
    for rows in (even, clustered, clustered * 1e4):
        kept, nearest = scanned(rows, rows[::40], 21)
        assert all(set(near) <= set(own) for own, near in zip(kept, nearest))
        assert sum(map(len, kept)) <= 3 * 21 * len(kept)
    same = np.repeat(even[:3], 50, axis=0)
    assert all(set(range(50 * q, 50 * q + 50)) <= set(own) for q, own in enumerate(scanned(same, even[:3], 21)[0]))
    assert [list(own) for own in scanned(even[:4], even[:2], 21)[0]] == [[0, 1, 2, 3]] * 2


def test_best_of_pairs_breaks_ties_by_id_and_leaves_the_query_out(monkeypatch):
    monkeypatch.setattr(vectors, "PAIRS", 3)
    rows, ids = np.array([[1.0, 0.0], [1.0, 0.0], [0.5, 0.0], [2.0, 0.0]]), np.array([9, 4, 7, 5])
    which, place = np.nonzero(np.ones((2, 4), dtype=bool))
    got = vectors.best(rows, ids, np.array([[1.0, 0.0], [2.0, 1.0]]), np.array([4, 8]), which, place, 2)
    assert [list(column) for column in got] == [[4, 4, 8, 8], [5, 9, 5, 4], [2.0, 1.0, 4.0, 2.0]]
