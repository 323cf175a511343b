from __future__ import annotations

import random
from decimal import Decimal

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quartier.operators.ranking import match, ranks_desc, top_ranks


def _scores(spark, seed, n=400):
    """Groups with NULL among them, a third of the rows in one group, a third on one value, close values apart."""
    rng = random.Random(seed)

    def value():
        roll = rng.random()
        if roll < 0.33:
            return Decimal("5.0000000000")
        near = Decimal(rng.randint(0, 9)) * Decimal("0.0000000001")
        return Decimal(rng.choice(["1.2345600000", "1.2345700000", "3.0000000000"])) + near

    rows = [(i, "hot" if rng.random() < 0.33 else rng.choice(["a", "b", None]), value()) for i in range(n)]
    return spark.createDataFrame(rows, "id int, g string, v decimal(38,10)")


@pytest.mark.parametrize("seed", range(2))
@pytest.mark.parametrize("by, dense", [([], True), ([], False), (["g"], False), (["g"], True)])
def test_ranks_equal_the_plain_window(spark, as_rows, seed, by, dense):
    df = _scores(spark, seed)
    window = W.partitionBy(*by).orderBy(F.desc("v"))
    plain = df.withColumn("r", (F.dense_rank() if dense else F.rank()).over(window))
    assert as_rows(match(df, ranks_desc(df, "v", "r", by=by, dense=dense), [*by, "v"])) == as_rows(plain)


@pytest.mark.parametrize("k", [1, 5, 20, 1000])
def test_top_ranks_keep_all_ties(spark, as_rows, k):
    df = _scores(spark, 7).withColumn("n", (F.col("id") % 3).cast("long"))
    plain = df.withColumn("r", F.rank().over(W.orderBy(F.desc("v"), "n"))).filter(F.col("r") <= k)
    found = top_ranks(df, "v", "n", k, "r").select(plain.columns)
    assert as_rows(found) == as_rows(plain)
    if k == 1:
        assert found.count() > 1


def test_ranking_many_values_gathers_only_slices(spark):
    df = spark.range(20000).selectExpr("cast(1 + id * 0.0002 AS decimal(38,10)) AS v")
    ranked = ranks_desc(df, "v", "r")
    assert ranked.filter("r != 20000 - cast(round((v - 1) / 0.0002) AS int)").count() == 0
