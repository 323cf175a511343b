"""The star schema as one object."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from quartier.sources import staged

# Staged name and database name of every warehouse table, in load order (fixed values).
TABLES = {
    "business": "DIM_BUSINESS",
    "location": "DIM_LOCATION",
    "category": "DIM_CATEGORY",
    "business_category": "BRIDGE_BUSINESS_CATEGORY",
    "calendar": "DIM_CALENDAR",
    "performance_fact": "FACT_PERFORMANCE",
}

# The month key of the calendar has another name in the database (fixed value).
CALENDAR_KEY = "ID_TEMPS"


@dataclass(frozen=True)
class Mart:
    """The six warehouse tables. ``location`` has one row per business."""

    business: DataFrame
    location: DataFrame
    category: DataFrame
    business_category: DataFrame
    calendar: DataFrame
    performance_fact: DataFrame

    def create_views(self) -> None:
        """Register the tables under their database names, for SQL through ``spark.sql``."""
        for name, table in TABLES.items():
            warehouse_names(getattr(self, name), name).createOrReplaceTempView(table)


def warehouse_names(df: DataFrame, name: str) -> DataFrame:
    """Columns named as in the database, whose spelling of the calendar key differs."""
    return df.withColumnRenamed("time_id", CALENDAR_KEY) if name == "calendar" else df


# Tables that grow with the businesses; bucketed alike, they join and group by business without a shuffle.
BUCKETED = {"performance_fact", "location", "business_category", "business"}


@dataclass(frozen=True)
class Store:
    """Where staged tables live: folders below ``root``.

    With ``buckets``, the large mart tables are catalog tables bucketed on the business, named with ``prefix``. Set
    ``spark.sql.shuffle.partitions`` to the same number when building them to spare the write a shuffle of its own.
    """

    spark: SparkSession
    root: str
    buckets: int | None = None
    prefix: str = ""

    def save(self, df: DataFrame, name: str) -> None:
        if self.buckets is not None and name in BUCKETED:
            staged.save_bucketed(df, self.prefix + name, self.buckets, path=f"{self.root}/{name}")
        else:
            staged.save(df, self.root, name)

    def load(self, name: str) -> DataFrame:
        if self.buckets is not None and name in BUCKETED:
            return self.spark.table(self.prefix + name)
        return staged.load(self.spark, self.root, name)

    def load_if_there(self, name: str) -> DataFrame | None:
        """The table, or None where none was saved yet."""
        try:
            return self.load(name)
        except AnalysisException as error:
            if error.getCondition() not in ("PATH_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND"):
                raise
            return None

    def mart(self) -> Mart:
        return Mart(**{name: self.load(name) for name in TABLES})
