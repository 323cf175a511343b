"""JDBC readers. ``options`` holds the connection: url, driver, user, password and any other Spark JDBC option."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

# Name of the precomputed split column of the large tables (fixed by their producer).
PARTITION_COLUMN = "spark_partition"


# Rows fetched at a time. With some drivers' default of 0 a connection's whole share would lie in executor memory.
FETCH_SIZE = "10000"


def _with_fetch_size(options: Mapping[str, str]) -> dict[str, str]:
    return dict(options) if "fetchsize" in map(str.lower, options) else {**options, "fetchsize": FETCH_SIZE}


def read_table(spark: SparkSession, options: Mapping[str, str], table: str) -> DataFrame:
    """A whole table over one connection; for small tables such as users and elite years."""
    return spark.read.format("jdbc").options(**_with_fetch_size(options), dbtable=table).load()


def read_table_split(
    spark: SparkSession,
    options: Mapping[str, str],
    table: str,
    partitions: int,
    column: str = PARTITION_COLUMN,
) -> DataFrame:
    """A large table, such as reviews and friends, over ``partitions`` connections.

    ``column`` holds integers 0..partitions-1, so each connection reads one value; NULLs come with the first.
    """
    split = {
        "partitionColumn": column,
        "lowerBound": "0",
        "upperBound": str(partitions),
        "numPartitions": str(partitions),
    }
    return spark.read.format("jdbc").options(**_with_fetch_size(options), dbtable=table, **split).load()


def read_query(spark: SparkSession, options: Mapping[str, str], sql: str) -> DataFrame:
    """The result of a query that the remote database runs."""
    return spark.read.format("jdbc").options(**_with_fetch_size(options), query=sql).load()
