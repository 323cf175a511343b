"""Staged tables: plain Parquet folders, and bucketed tables for the large ones."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def save(df: DataFrame, root: str, name: str) -> None:
    df.write.mode("overwrite").parquet(f"{root}/{name}")


def load(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{name}")


def save_bucketed(df: DataFrame, table: str, buckets: int, key: str = "business_id", path: str | None = None) -> None:
    """Write a catalog table bucketed and sorted on ``key``.

    Tables with the same ``buckets`` join and group on the key without a shuffle. Rows are first partitioned by the
    same hash, so every task writes one file instead of one per bucket.
    """
    writer = (
        df.repartition(buckets, key)
        .sortWithinPartitions(key)
        .write.mode("overwrite")
        .format("parquet")
        .bucketBy(buckets, key)
        .sortBy(key)
    )
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(table)
