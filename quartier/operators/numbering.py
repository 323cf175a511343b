"""Gapless numbers over distributed rows, and surrogate keys that stay from one load to the next."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quartier.session import cut_lineage

_PLACE_BITS = 33  # monotonically_increasing_id: partition above, place in it below (documented by Spark)


def numbered(df: DataFrame, order: Sequence[Column], within: Sequence[str] = (), name: str = "position") -> DataFrame:
    """``df`` with ``name``: 0, 1, 2, ... in ``order``, anew for each value of the columns ``within``. Null is a value.

    Rows are dealt to tasks by range and sorted there; a row's number is its place in its task plus what the earlier tasks
    hold of its group, a prefix sum over one row per task and group. So no group, however large, meets in one task, and
    equal rows are split over tasks too. ``df`` is read twice (ranges are sampled first); the result is a kept table, so
    numbers never change under a reader. Columns named ``_by0``, ``_task``, ``_place`` and alike are taken.
    """
    keys = [f"_by{i}" for i in range(len(order))]
    rows = df.withColumns(dict(zip(keys, order))).withColumn("_tie", F.monotonically_increasing_id())
    by = [F.col(c).asc_nulls_first() for c in [*within, *keys, "_tie"]]
    dealt = rows.repartitionByRange(*by).sortWithinPartitions(*by).drop("_tie", *keys)
    kept = cut_lineage(dealt.withColumn("_id", F.monotonically_increasing_id()))
    kept = kept.select(
        "*", F.shiftright("_id", _PLACE_BITS).alias("_task"),
        F.col("_id").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1)).alias("_place"),
    ).drop("_id")
    runs = kept.groupBy("_task", *within).agg(F.count(F.lit(1)).alias("_n"), F.min("_place").alias("_first"))
    earlier = Window.partitionBy(*within).orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    ahead = F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first")
    runs = cut_lineage(runs.select("_task", *within, ahead.alias("_ahead")))
    other = runs.toDF("_task2", *(f"_g{i}" for i in range(len(within))), "_ahead")
    same = F.col("_task") == F.col("_task2")
    for i, column in enumerate(within):
        same = same & F.col(column).eqNullSafe(F.col(f"_g{i}"))
    joined = kept.join(other, same)
    return joined.select(*df.columns, (F.col("_place") + F.col("_ahead")).alias(name))


def extended_keys(natural: DataFrame, known: DataFrame | None, column: str, key: str, first: int = 1) -> DataFrame:
    """The key map (``column``, ``key``) over all values of ``natural`` and of the map ``known`` before it.

    Known values keep their keys; new ones get the next keys, in their own order and without gaps. Null gets no key.
    Repeated values count once. Feeding the result back as ``known`` makes keys stable over any number of loads; a value that no
    longer occurs keeps its key, so a key is never given twice.
    """
    values = natural.select(column).where(F.col(column).isNotNull()).distinct()
    if known is None:
        fresh, start, old = cut_lineage(values), first, None
    else:
        old = known.select(column, F.col(key).cast("long").alias(key))
        fresh = cut_lineage(values.join(old.select(column), column, "left_anti"))
        start = old.agg(F.max(key)).first()[0]
        start = first if start is None else start + 1
    made = numbered(fresh, [F.col(column)], name=key).select(column, (F.col(key) + start).alias(key))
    return made if old is None else old.union(made)
