"""Summary tables: computed from the mart on demand and stored whole."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quartier.functions import half_up
from quartier.operators.grains import business_years, category_weights, mean_score, parts, row_count
from quartier.plans.mart import Mart, Store


def state_years(mart: Mart) -> DataFrame:
    """M1: businesses, reviews, check-ins and mean score per state and year, over all fact rows."""
    aggregates = parts("review_count", "checkin_count")
    years = business_years(mart.performance_fact, mart.location, mart.calendar, aggregates, ["state"])
    return years.groupBy("state", "year").agg(
        row_count().alias("nb_commerces"),
        F.sum("review_count").alias("total_reviews"),
        F.sum("checkin_count").alias("total_checkins"),
        half_up(mean_score(), 2).alias("note_moyenne"),
    )


def _activity(fact: DataFrame) -> DataFrame:
    """Fact rows and reviews per business."""
    return fact.groupBy("business_id").agg(
        row_count().alias("months"), F.sum("review_count").alias("review_count")
    )


def _weighted_stars(weight: str) -> Column:
    """Mean stars in which a business counts once per fact row; businesses without stars do not count."""
    counted = F.when(F.col("stars").isNotNull(), F.expr(weight))
    return half_up(F.sum(F.col("stars") * F.expr(weight)) / F.nullif(F.sum(counted), F.lit(0)), 2)


def gems_by_city(mart: Mart, min_stars: float = 4.2, max_reviews: int = 150) -> DataFrame:
    """M2: open businesses with high stars per city, where they average fewer than ``max_reviews`` reviews."""
    gems = mart.business.filter((F.col("stars") >= min_stars) & (F.col("is_open") == 1))
    return (
        _activity(mart.performance_fact)
        .join(gems.select("business_id", "stars"), "business_id")
        .join(mart.location.select("business_id", "state", "city"), "business_id")
        .groupBy("state", "city")
        .agg(
            row_count().alias("nb_pepites"),
            _weighted_stars("months").alias("note_moyenne"),
            F.sum("review_count").alias("reviews"),
        )
        .filter(F.col("reviews") < max_reviews * F.col("nb_pepites"))
        .drop("reviews")
    )


def category_stats(mart: Mart) -> DataFrame:
    """M3: businesses, mean stars and reviews per category.

    A pair that the bridge holds more than once adds its rows that often, but its business once.
    """
    return (
        _activity(mart.performance_fact)
        .join(mart.business.select("business_id", "stars"), "business_id")
        .join(category_weights(mart.business_category), "business_id")
        .groupBy("category_id")
        .agg(
            row_count().alias("nb_commerces"),
            _weighted_stars("months * weight").alias("note_moyenne"),
            F.sum(F.col("review_count") * F.col("weight")).alias("total_reviews"),
        )
        .join(mart.category, "category_id")
        .select("category_name", "nb_commerces", "note_moyenne", "total_reviews")
    )


# Stored name of each summary (fixed values).
SUMMARIES: dict[str, Callable[[Mart], DataFrame]] = {
    "mv_perf_by_state_year": state_years,
    "mv_pepites_by_state": gems_by_city,
    "mv_category_stats": category_stats,
}


def refresh(name: str, mart: Mart, store: Store) -> DataFrame:
    """Recompute a summary from the mart, replace its stored table and return the stored rows."""
    store.save(SUMMARIES[name](mart), name)
    return store.load(name)


def refresh_all(mart: Mart, store: Store) -> dict[str, DataFrame]:
    return {name: refresh(name, mart, store) for name in SUMMARIES}
