"""Grains the reports are built on: one row per business, business-year or business-category.

A mean score is the unweighted mean of monthly means, kept as (sum, count) until the last step.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def with_months(fact: DataFrame, calendar: DataFrame, *columns: str) -> DataFrame:
    return fact.join(F.broadcast(calendar.select("time_id", *columns)), "time_id")


def scored(fact: DataFrame) -> DataFrame:
    return fact.filter(F.col("score_mean").isNotNull())


# The two halves of a mean score.
SCORE_PARTS = ["score_sum", "score_n"]


def sums(*names: str) -> list[Column]:
    return [F.sum(name).alias(name) for name in names]


def parts(*counts: str) -> list[Column]:
    """Count totals plus the two halves of the mean score."""
    return [*sums(*counts), F.sum("score_mean").alias("score_sum"), F.count("score_mean").alias("score_n")]


def mean_score(weight: Column | None = None) -> Column:
    """Mean score of a group of partial rows, each counted ``weight`` times."""
    weight = F.lit(1) if weight is None else weight
    return F.sum(F.col("score_sum") * weight) / F.nullif(F.sum(F.col("score_n") * weight), F.lit(0))


def row_count() -> Column:
    return F.count(F.lit(1))


def business_years(
    fact: DataFrame, location: DataFrame, calendar: DataFrame, aggregates: list[Column], places: list[str]
) -> DataFrame:
    """One row per business and year. Joined before grouping, so that one shuffle on the business serves both."""
    joined = with_months(fact, calendar, "year").join(location.select("business_id", *places), "business_id")
    return joined.groupBy("business_id", *places, "year").agg(*aggregates)


def mark_first(rows: DataFrame, order: str, mark: str) -> DataFrame:
    """Mark one row per business with 1, so that summing the mark counts businesses across ``order``.

    The window holds the rows of one business, one per value of ``order``.
    """
    first = F.row_number().over(W.partitionBy("business_id").orderBy(order)) == 1
    return rows.withColumn(mark, first.cast("long"))


def category_weights(bridge: DataFrame) -> DataFrame:
    """One row per business and category, with how often the bridge holds the pair."""
    return bridge.groupBy("business_id", "category_id").agg(row_count().alias("weight"))


def businesses(fact: DataFrame, *counts: str) -> DataFrame:
    """One row per business over its scored months."""
    return scored(fact).groupBy("business_id").agg(*parts(*counts))
