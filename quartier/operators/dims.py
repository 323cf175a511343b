"""Dimensions and the business-category bridge."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quartier.functions import event_date, list_items, surrogate_key, time_id


def split_dates(df: DataFrame) -> DataFrame:
    """One row per date of a text that joins many dates with ``", "``; businesses without a text give no row."""
    return df.select(
        "business_id", F.explode(F.split("date", ", ")).alias("date")
    ).withColumn("date", F.trim("date"))


def business_dim(business: DataFrame) -> DataFrame:
    # Fixed: the columns of the business table.
    return business.select("business_id", "name", "stars", "is_open", "attributes")


def location_dim(business: DataFrame, keys: DataFrame | None = None) -> DataFrame:
    """One location per business, not per place. Keys are hashes, or those of the key map ``keys`` by business."""
    key = "location_id" if keys is not None else surrogate_key("business_id").alias("location_id")
    if keys is not None:
        business = business.join(keys.select("business_id", "location_id"), "business_id")
    # Fixed: the columns of the location table.
    return business.select(
        "business_id",
        "address",
        "city",
        "postal_code",
        "state",
        "latitude",
        "longitude",
        key,
    )


def _tags(business: DataFrame) -> DataFrame:
    """One row per business and listed category. Dimension and bridge share this split, so their names agree."""
    tags = business.select("business_id", F.explode(list_items(F.col("categories"))).alias("category_name"))
    return tags.filter("category_name <> ''")


def category_dim(business: DataFrame, keys: DataFrame | None = None) -> DataFrame:
    """One row per category name, keyed by a hash or by the key map ``keys``."""
    names = _tags(business).select("category_name").distinct()
    if keys is not None:
        return names.join(keys.select("category_name", "category_id"), "category_name")
    return names.withColumn("category_id", surrogate_key("category_name"))


def category_names(business: DataFrame) -> DataFrame:
    """The listed category names, as often as they are listed."""
    return _tags(business).select("category_name")


def keyed_business_category(business: DataFrame, category: DataFrame, parts: int = 16) -> DataFrame:
    """Bridge rows with the keys of ``category``, whatever these are.

    A staged dimension of proven size is broadcast by Catalyst. Where it is too large for that, the rows of one name, which may be
    a third of all, are dealt over ``parts`` parts, and the dimension is repeated for them.
    """
    part = F.pmod(F.xxhash64("business_id"), F.lit(parts)).cast("int").alias("_part")
    tags = _tags(business).select("business_id", "category_name", part)
    dealt = category.select("category_name", "category_id", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("_part"))
    return tags.join(dealt, ["category_name", "_part"]).select("business_id", "category_id")


def business_category(business: DataFrame, category: DataFrame | None = None) -> DataFrame:
    """Bridge rows. A category's key follows from its name, so no join is needed, whatever name most businesses list.

    Given a dimension from elsewhere, only pairs with a category in it are kept.
    """
    bridge = _tags(business).select("business_id", surrogate_key("category_name").alias("category_id"))
    return bridge if category is None else bridge.join(category.select("category_id"), "category_id", "left_semi")


def month_dim(events: DataFrame, column: str) -> DataFrame:
    """One row per month that has an event, keyed yyyymm. Months are de-duplicated before the shuffle."""
    day = event_date(events, column)
    return events.select(
        time_id(day).alias("time_id"),
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.quarter(day).alias("quarter"),
    ).distinct()


def months_per_year(calendar: DataFrame) -> DataFrame:
    return calendar.groupBy("year").count().orderBy("year")
