"""The star schema over the generated order tables: customers are businesses, orders are reviews, finished orders are
tips and shipped lines are check-ins."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quartier.operators import dims, facts
from quartier.plans.mart import Mart
from quartier.session import cut_lineage


class Inputs:
    """The source tables of the star schema, each in the shape its reader gives."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark, self._dir = spark, sf_dir
        self._tables: dict[str, DataFrame] = {}

    def _table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self._spark.read.parquet(f"{self._dir}/{name}.parquet")
        return self._tables[name]

    def reviews(self) -> DataFrame:
        return self._table("orders").select(
            F.col("o_orderkey").alias("review_id"),
            F.col("o_custkey").alias("business_id"),
            F.col("o_orderdate").alias("date"),
            (F.lit(6) - F.substring("o_orderpriority", 1, 1).cast("int")).cast("double").alias("stars"),
        )

    def tips(self) -> DataFrame:
        return (
            self._table("orders")
            .filter("o_orderstatus = 'F'")
            .select(F.col("o_custkey").alias("business_id"), F.col("o_orderdate").alias("date"))
        )

    def _lines(self) -> DataFrame:
        orders = self._table("orders").select("o_orderkey", "o_custkey", "o_orderdate")
        lines = self._table("lineitem").select("l_orderkey", "l_partkey", "l_shipdate")
        return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))

    def checkins(self) -> DataFrame:
        return self._lines().select(F.col("o_custkey").alias("business_id"), F.col("l_shipdate").alias("date"))

    def joined_dates(self) -> DataFrame:
        """Texts of two dates each, order and shipment of a line, as the check-in file joins them."""
        day = [F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("o_orderdate", "l_shipdate")]
        return self._lines().select(F.col("o_custkey").alias("business_id"), F.concat_ws(", ", *day).alias("date"))

    def places(self) -> DataFrame:
        """Businesses with their place. Address, postal code and coordinates stand in for fields customers lack."""
        nation, region = self._table("nation"), self._table("region")
        return (
            self._table("customer")
            .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
            .select(
                F.col("c_custkey").alias("business_id"),
                F.col("c_mktsegment").alias("address"),
                F.col("n_name").alias("city"),
                F.lpad(F.col("n_nationkey").cast("string"), 5, "0").alias("postal_code"),
                F.col("r_name").alias("state"),
                F.col("n_nationkey").cast("double").alias("latitude"),
                F.col("r_regionkey").cast("double").alias("longitude"),
            )
        )

    def profiles(self) -> DataFrame:
        """Businesses with name, stars, opening flag and attributes."""
        stars = self.reviews().groupBy("business_id").agg(F.avg("stars").alias("stars"))
        customer = self._table("customer").select(
            F.col("c_custkey").alias("business_id"),
            F.col("c_name").alias("name"),
            (F.col("c_acctbal") >= 0).cast("long").alias("is_open"),
            F.struct(F.col("c_mktsegment").alias("Segment")).alias("attributes"),
        )
        return customer.join(stars, "business_id", "left")

    def tagged(self) -> DataFrame:
        """Businesses with the part types they bought as one text of categories.

        Pairs are made distinct first, so a list holds no more items than there are part types.
        """
        part = self._table("part").select("p_partkey", "p_type")
        pairs = (
            self._lines()
            .join(part, F.col("l_partkey") == F.col("p_partkey"))
            .select(F.col("o_custkey").alias("business_id"), "p_type")
            .distinct()
        )
        return pairs.groupBy("business_id").agg(
            F.concat_ws(", ", F.array_sort(F.collect_list("p_type"))).alias("categories")
        )

    def businesses(self) -> DataFrame:
        """Whole business records, as the business file holds them."""
        return self.profiles().join(self.places(), "business_id").join(self.tagged(), "business_id", "left")


class OrderMart:
    """A :class:`quartier.plans.mart.Mart` over the generated tables whose parts are planned when first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.inputs = Inputs(spark, sf_dir)

    @cached_property
    def business(self) -> DataFrame:
        return dims.business_dim(self.inputs.profiles())

    @cached_property
    def location(self) -> DataFrame:
        return dims.location_dim(self.inputs.places())

    @cached_property
    def _tagged(self) -> DataFrame:
        return self.inputs.tagged()

    @cached_property
    def category(self) -> DataFrame:
        """Kept as a table, as the jobs stage it before the bridge joins it."""
        return cut_lineage(dims.category_dim(self._tagged))

    @cached_property
    def business_category(self) -> DataFrame:
        return dims.business_category(self._tagged)

    @cached_property
    def calendar(self) -> DataFrame:
        return dims.month_dim(self.inputs.reviews(), "date")

    @cached_property
    def performance_fact(self) -> DataFrame:
        source = self.inputs
        return facts.performance_fact(
            source.reviews(), source.tips(), source.checkins(), self.location, self.calendar
        )


def build_mart(spark: SparkSession, sf_dir: str) -> Mart:
    """The star schema over the tables of a folder."""
    return OrderMart(spark, sf_dir)
