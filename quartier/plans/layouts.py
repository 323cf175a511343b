"""Access paths beside the business key: copies of the staged tables laid out for other questions.

Spark has no indexes; what takes their place is the order of rows in files. A filter then skips partitions by their folder,
row groups by the least and greatest value in their footer, and row groups without a value by its Bloom filter.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quartier.operators.numbering import numbered
from quartier.plans.mart import Mart
from quartier.session import cut_lineage

#: Columns that order the copy of a table, and those that have a Bloom filter, by the questions put to them.
LOOKUPS = {
    "location": (["state", "city", "business_id"], ["city", "business_id"]),
    "business": (["is_open", "stars", "business_id"], ["business_id"]),
    "business_category": (["category_id", "business_id"], ["business_id"]),
}


# --- by month ----------------------------------------------------------------------------------------------------


def write_by_month(rows: DataFrame, path: str, months_only: bool = False) -> None:
    """Write rows into one folder for each ``time_id``; with ``months_only`` only the folders of their months are replaced.

    Rows are dealt by ranges of month and business, so a month of any size is split over tasks. ``rows`` is read twice and
    must not be of the folders that are replaced.
    """
    keys = ["time_id", "business_id"]
    writer = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).write.partitionBy("time_id").mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic" if months_only else "static").parquet(path)


def read_by_month(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table, with its columns in their order. A join with months of the calendar prunes folders when it runs."""
    return spark.read.schema(schema).parquet(path).select(*schema.fieldNames())


# --- by location and month ---------------------------------------------------------------------------------------


def _spread(value: Column) -> Column:
    """The low 16 bits of a number, each followed by a 0 bit."""
    out = value.cast("long").bitwiseAND(F.lit(0xFFFF))
    for shift, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
        out = out.bitwiseOR(F.shiftleft(out, shift)).bitwiseAND(F.lit(mask))
    return out


def morton(x: Column, y: Column) -> Column:
    """The place on a curve that keeps near what is near in both of two 16-bit numbers: their bits in turn."""
    return _spread(x).bitwiseOR(F.shiftleft(_spread(y), 1))


def _month_number(time_id: Column) -> Column:
    """Months since the year 0 of a key yyyymm."""
    return F.floor(time_id / 100) * 12 + time_id % 100


@dataclass(frozen=True)
class ClusteredFact:
    """A copy of the fact clustered on location and month at once.

    Locations are numbered by state, city and business, so a state or a city is a run of numbers. Rows follow the Morton
    curve over number and month: a question on some states and some months reads the row groups that hold them and few others.
    """

    spark: SparkSession
    path: str

    def write(self, fact: DataFrame, location: DataFrame, row_group_bytes: int | None = None) -> None:
        """``fact`` and ``location`` are staged tables. Null states and cities come first."""
        places = location.select("business_id", "state", "city")
        order = [F.col(c) for c in ("state", "city", "business_id")]
        ranks = cut_lineage(numbered(places, order, name="location_rank"))
        runs = ranks.groupBy("state", "city").agg(F.min("location_rank").alias("first"), F.max("location_rank").alias("last"))
        runs.write.mode("overwrite").parquet(f"{self.path}/places")
        month = _month_number(F.col("time_id"))
        first, last = fact.agg(F.min(month), F.max(month)).first()
        rows, months = ranks.count(), (last or 0) - (first or 0) + 1
        x = F.floor(F.col("location_rank") * F.lit(1 << 16) / F.lit(max(rows, 1)))
        y = F.floor((month - F.lit(first or 0)) * F.lit(1 << 16) / F.lit(months))
        joined = fact.join(ranks.select("business_id", "location_rank"), "business_id").withColumn("_z", morton(x, y))
        keys = ["_z", "location_rank", "time_id"]
        dealt = cut_lineage(joined).repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_z")
        writer = dealt.write.mode("overwrite")
        if row_group_bytes is not None:
            writer = writer.option("parquet.block.size", row_group_bytes)
        writer.parquet(f"{self.path}/rows")

    def rows(self, states: Sequence[str], first_month: int, last_month: int, cities: Sequence[str] | None = None) -> DataFrame:
        """Fact rows of some states (and cities of them) from ``first_month`` to ``last_month`` (yyyymm).

        The runs of the places asked for are looked up first (as many as the caller names) and become bounds on the scan.
        """
        places = self.spark.read.parquet(f"{self.path}/places").where(F.col("state").isin(list(states)))
        if cities is None:
            places = places.groupBy("state").agg(F.min("first").alias("first"), F.max("last").alias("last"))
        else:
            places = places.where(F.col("city").isin(list(cities)))
        here = F.lit(False)
        for run in places.collect():
            here = here | F.col("location_rank").between(run["first"], run["last"])
        rows = self.spark.read.parquet(f"{self.path}/rows")
        return rows.where(F.col("time_id").between(first_month, last_month)).where(here).drop("location_rank")


# --- single values -----------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Lookups:
    """Copies of location, business and bridge, ordered and filtered for single places, scores and categories."""

    spark: SparkSession
    path: str

    def write(self, mart: Mart, row_group_bytes: int | None = None) -> None:
        """The last column of each order is the business, so one city or category of any size is split over tasks."""
        for name, (order, bloom) in LOOKUPS.items():
            dealt = cut_lineage(getattr(mart, name)).repartitionByRange(*order).sortWithinPartitions(*order)
            writer = dealt.write.mode("overwrite")
            for column in bloom:
                writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
            if row_group_bytes is not None:
                writer = writer.option("parquet.block.size", row_group_bytes)
            writer.parquet(f"{self.path}/{name}")
        mart.category.write.mode("overwrite").parquet(f"{self.path}/category")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{name}")

    def places(self, state: str, city: str | None = None) -> DataFrame:
        found = self.table("location").where(F.col("state") == state)
        return found if city is None else found.where(F.col("city") == city)

    def businesses(self, min_stars: float, is_open: bool = True) -> DataFrame:
        return self.table("business").where((F.col("is_open") == int(is_open)) & (F.col("stars") >= min_stars))

    def business(self, business_id: object) -> DataFrame:
        return self.table("business").where(F.col("business_id") == business_id)

    def of_category(self, name: str) -> DataFrame:
        """Bridge rows of a category: its key is looked up first, so that it becomes a bound on the scan."""
        key = self.table("category").where(F.col("category_name") == name).select("category_id").first()
        bridge = self.table("business_category")
        return bridge.where(F.col("category_id") == key[0]) if key else bridge.limit(0)
