"""Checks on staged tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def duplicates(df: DataFrame, *key: str) -> DataFrame:
    """Key values that occur on more than one row, with their number of rows."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")


def require_unique(df: DataFrame, *key: str) -> None:
    found = duplicates(df, *key).head(1)
    if found:
        raise ValueError(f"{', '.join(key)} is not unique: {found[0].asDict()}")
