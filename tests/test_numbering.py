"""Gapless numbers and keys that stay."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from quartier.operators.numbering import extended_keys, numbered


def test_numbers_follow_the_order_within_each_group(spark):
    pick = random.Random(1)
    rows = [(pick.choice(["a", "a", "a", "b", None]), pick.choice([None, *range(40)]), str(k)) for k in range(4000)]
    rows += [("a", 7, "same")] * 3000 + [("alone", 1, "x")]
    df = spark.createDataFrame(rows, "g string, v int, t string").repartition(16)
    got = numbered(df, [F.col("v"), F.col("t")], ["g"], "n").collect()
    assert len(got) == len(rows)
    for group in ("a", "b", None, "alone"):
        mine = sorted((r for r in got if r.g == group), key=lambda r: r.n)
        assert [r.n for r in mine] == list(range(len(mine)))
        order = [(r.v is not None, r.v or 0, r.t) for r in mine]
        assert order == sorted(order)


def test_numbers_of_a_whole_table_and_of_none(spark):
    got = numbered(spark.range(0, 1000, 1, 7), [-F.col("id")], name="n").collect()
    assert sorted((r.n, r.id) for r in got) == [(k, 999 - k) for k in range(1000)]
    assert numbered(spark.range(0), [F.col("id")]).count() == 0


def test_keys_stay_over_loads(spark):
    def load(names, known):
        return extended_keys(spark.createDataFrame([(n,) for n in names], "name string"), known, "name", "key")

    first = load(["b", "a", "a", None, "d"], None)
    assert {r.name: r.key for r in first.collect()} == {"a": 1, "b": 2, "d": 3}
    second = load(["c", "a", "e"], first)
    assert {r.name: r.key for r in second.collect()} == {"a": 1, "b": 2, "d": 3, "c": 4, "e": 5}
    assert {r.name: r.key for r in load([], second).collect()} == {r.name: r.key for r in second.collect()}
