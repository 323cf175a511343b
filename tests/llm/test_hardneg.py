from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from compare import connect, differences
from quartier.llm import hardneg, queries


def brute(rows):
    """The query's rows over (vec_id, embedding, label) with distinct ids, score by score."""
    taken = []
    for i, vector, label in rows:
        if i is None or label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        taken.append((i, [math.floor(256 * x) for x in vector], (label + 1) % 10 if i % 7 == 0 else label))
    out = []
    for i, vector, label in taken:
        if i % 50:
            continue
        scored = [(-sum(a * b for a, b in zip(vector, other)), j, kind) for j, other, kind in taken if j != i]
        scored.sort()
        for minus, j, kind in [s for s in scored if s[2] == label][:5]:
            fit = [(s, n) for s, n, kind in scored if kind != label and 50 * -minus <= 100 * -s <= 95 * -minus][:3]
            out += [(i, j, rank, n, -minus, -s) for rank, (s, n) in enumerate(fit, 1)]
    return sorted(out)


def vectors(seed: int, n: int, size: int):
    pick = random.Random(seed)
    centres = [[pick.gauss(0, 1) for _ in range(size)] for _ in range(6)]
    rows = []
    for i in range(n):
        centre = pick.choice(centres)
        rows.append((i, [float(np.float32(c + pick.gauss(0, 0.7))) for c in centre], pick.choice([0, 0, 0, 1, 2, 7])))
    same = rows[3][1]
    rows += [(n + k, same, pick.choice([0, 5])) for k in range(40)]  # ties
    rows += [(n + 50, None, 1), (n + 51, [1.0, None] + [0.0] * (size - 2), 1), (n + 52, [math.nan] * size, 1)]
    rows += [(n + 53, [math.inf] + [0.0] * (size - 1), 1), (n + 54, same, None), (n + 55, [0.0] * size, 0)]
    return rows


@pytest.mark.parametrize("block, size", [(8192, 13), (40, 13), (40, 64)])
def test_equals_all_scores(spark, tmp_path, monkeypatch, block, size):
    monkeypatch.setattr(hardneg, "BLOCK", block)
    rows = vectors(block + size, 400, size)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    df = df.select("*", F.lit("?").alias("id"), F.lit("?").alias("rank"), F.lit("?").alias("block")).repartition(4)
    df.write.parquet(f"{tmp_path}/embeddings.parquet")
    got = queries.op13_hard_negatives(spark, str(tmp_path))
    want = brute(rows)
    assert sorted(tuple(r) for r in got.collect()) == want and len(want) > 50


def test_edge_rows(spark):
    def mined(rows):
        df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
        return sorted(tuple(r) for r in hardneg.mine(df, F.col("vec_id") == 0, F.col("label")).collect())

    assert mined([]) == []
    assert mined([(0, None, 1), (1, [1.0], None), (None, [1.0], 1)]) == []
    assert mined([(1, [1.0], 1), (2, [1.0], 2)]) == []  # no anchor
    assert mined([(0, [], 1), (1, [], 1)]) == []
    assert mined([(0, [-1.0], 1), (1, [1.0], 1), (2, [0.9], 2)]) == []  # a positive below zero has no window
    pairs = [(0, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [0.75, 9.0], 2), (2, [0.75, 9.0], 2), (3, [0.5, -9.0], 3),
             (4, [0.99, 0.0], 2), (5, [1e9, 0.0], 2), (6, [0.9], 2), (7, [0.6, 0.0], 2), (8, [0.6, 5.0], 2)]
    full = 256 * 256
    assert mined(pairs) == [
        (0, 1, 1, 2, full, 256 * 192), (0, 1, 2, 7, full, 256 * 153), (0, 1, 3, 8, full, 256 * 153),
    ]


def test_the_scan_drops_no_needed_candidate_and_reads_less():
    rng = np.random.default_rng(3)
    vectors = (rng.normal(size=(2000, 32)) * 40).astype(int)
    block = hardneg.Vertical(np.arange(2000), rng.integers(0, 4, 2000), vectors)
    query = vectors[5].astype(np.int64)
    scores = vectors @ query
    seen = []

    def keep(lower, upper):
        seen.append(len(lower))
        return upper >= np.sort(lower)[-5]

    alive, score = block.scan(query, np.arange(2000), keep)
    assert set(np.argsort(-scores)[:5]) <= set(alive.tolist()) and (scores[alive] == score).all()
    assert seen[-1] < 200


def test_query_equals_sql(spark):
    sf_dir, name = "/root/testdata/sf0.001", "op13_hard_negatives"
    assert differences(queries.QUERIES[name](spark, sf_dir), connect(sf_dir), queries.ORACLE_SQL[name]) == []
