"""The monthly performance fact: reviews, tips and check-ins per business and month."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quartier.functions import event_date, time_id

KEYS = ["business_id", "time_id"]
COUNTS = ["review_count", "tip_count", "checkin_count"]


def with_time_id(events: DataFrame) -> DataFrame:
    """Add the month key of the ``date`` column."""
    return events.withColumn("time_id", time_id(event_date(events, "date")))


def _keyed(events: DataFrame, *columns: str) -> DataFrame:
    """Events with their month key, without those that have none: they could never reach the fact."""
    return with_time_id(events.select("business_id", "date", *columns)).dropna(subset=KEYS)


def review_facts(reviews: DataFrame) -> DataFrame:
    return _keyed(reviews, "review_id", "stars").groupBy(*KEYS).agg(
        F.count("review_id").alias("review_count"), F.avg("stars").alias("score_mean")
    )


def tip_facts(tips: DataFrame) -> DataFrame:
    return _keyed(tips).groupBy(*KEYS).agg(F.count(F.lit(1)).alias("tip_count"))


def checkin_facts(checkins: DataFrame) -> DataFrame:
    return _keyed(checkins).groupBy(*KEYS).agg(F.count(F.lit(1)).alias("checkin_count"))


def merge_facts(reviews: DataFrame, tips: DataFrame, checkins: DataFrame) -> DataFrame:
    """Full outer join of the three fact sets, for sets that were aggregated separately."""
    return reviews.join(tips, KEYS, "full").join(checkins, KEYS, "full")


def activity(reviews: DataFrame, tips: DataFrame, checkins: DataFrame) -> DataFrame:
    """The same rows as :func:`merge_facts` over the three fact sets, from the raw events in one aggregation.

    The events are stacked and grouped together: one shuffle of map-side combined rows instead of three plus two
    sorted full joins. A business with a third of all events leaves each map task as at most one row per month.
    """
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    no_stars = F.lit(None).cast("double")

    def rows(events: DataFrame, review: Column, tip: Column, checkin: Column, stars: Column) -> DataFrame:
        return events.select(
            *KEYS,
            review.alias("review_count"),
            tip.alias("tip_count"),
            checkin.alias("checkin_count"),
            stars.alias("stars"),
        )

    identified = F.col("review_id").isNotNull().cast("long")
    stacked = (
        rows(_keyed(reviews, "review_id", "stars"), identified, zero, zero, F.col("stars").cast("double"))
        .union(rows(_keyed(tips), zero, one, zero, no_stars))
        .union(rows(_keyed(checkins), zero, zero, one, no_stars))
    )
    return stacked.groupBy(*KEYS).agg(
        *[F.sum(name).alias(name) for name in COUNTS], F.avg("stars").alias("score_mean")
    )


def attach_dims(merged: DataFrame, location: DataFrame, calendar: DataFrame) -> DataFrame:
    """Keep known businesses and calendar months, zero-fill the counts, leave a missing mean NULL.

    The calendar is broadcast: it has one row per yyyymm, at most 12 for each of 9,999 years. Locations grow with the
    businesses, so that join is left to Catalyst and adaptive execution.
    """
    counts = [F.coalesce(name, F.lit(0).cast("long")).alias(name) for name in COUNTS]
    return (
        merged.join(F.broadcast(calendar.select("time_id")), "time_id")
        .join(location.select("business_id", "location_id"), "business_id")
        .select("business_id", "time_id", "location_id", *counts, "score_mean")
    )


def performance_fact(
    reviews: DataFrame, tips: DataFrame, checkins: DataFrame, location: DataFrame, calendar: DataFrame
) -> DataFrame:
    """The fact table: one row per business and month."""
    return attach_dims(activity(reviews, tips, checkins), location, calendar)
