from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from quartier.functions import event_date, growth_pct, half_up, list_items, surrogate_key, time_id


def test_half_up_rounds_decimal_digits(spark):
    df = spark.createDataFrame([(4.225,), (4.2249999,), (-1.005,), (None,), (2.675,)], "x double")
    assert [r[0] for r in df.select(half_up(F.col("x"), 2)).collect()] == [4.23, 4.22, -1.01, None, 2.68]


@pytest.mark.parametrize("text, month", [
    ("2012-05-18 02:17:21", 201205), ("2012-05-18", 201205), ("2012-12-31 23:59:59", 201212),
    ("garbage", None), ("", None), ("2012-13-01 00:00:00", None), (None, None),
])
def test_time_id_of_text(spark, text, month):
    df = spark.createDataFrame([(text,)], "date string")
    assert df.select(time_id(event_date(df, "date"))).head()[0] == month


def test_time_id_of_typed_columns(spark):
    df = spark.createDataFrame([(dt.datetime(2020, 1, 31, 23, 59), dt.date(2020, 2, 1))], "t timestamp, d date")
    df = df.withColumn("n", F.col("t").cast("timestamp_ntz"))
    found = df.select(*[time_id(event_date(df, c)).alias(c) for c in "tdn"]).head()
    assert tuple(found) == (202001, 202002, 202001)
    assert dict(df.select(time_id(event_date(df, "t")).alias("x")).dtypes)["x"] == "int"


def test_list_items(spark):
    df = spark.createDataFrame([(" A,B , C ",), ("A",), (None,)], "c string")
    assert [r[0] for r in df.select(list_items(F.col("c"))).collect()] == [["A", "B", "C"], ["A"], None]


def test_growth(spark):
    df = spark.createDataFrame([(15, 10), (5, 0), (5, None), (1, 3)], "c long, p long")
    found = [r[0] for r in df.select(growth_pct(F.col("c"), F.col("p"))).collect()]
    assert found == [50.0, None, None, -66.67]


def test_surrogate_key_depends_on_the_value_only(spark):
    df = spark.createDataFrame([("a",), ("b",)], "k string")
    first = {r.k: r.id for r in df.select("k", surrogate_key("k").alias("id")).collect()}
    again = {r.k: r.id for r in df.repartition(3).select("k", surrogate_key("k").alias("id")).collect()}
    assert first == again and first["a"] != first["b"]
