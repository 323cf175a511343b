"""JDBC calls are checked by the options they hand to Spark, without a database."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from quartier.plans.mart import TABLES, Mart
from quartier.sinks import jdbc as sink
from quartier.sources import jdbc as source

CONNECTION = {"url": "jdbc:x", "driver": "d", "user": "u", "password": "p"}


class Recorder:
    """Stands in for a DataFrame reader or writer and keeps what it is told."""

    def __init__(self):
        self.kept, self.saved = {}, False

    def format(self, name):
        self.kept["format"] = name
        return self

    def mode(self, name):
        self.kept["mode"] = name
        return self

    def option(self, name, value):
        self.kept[name] = value
        return self

    def options(self, **options):
        self.kept.update(options)
        return self

    def load(self):
        return self.kept

    def save(self):
        self.saved = True


class Session:
    @property
    def read(self):
        return Recorder()


def test_whole_table():
    assert source.read_table(Session(), CONNECTION, "users") == {
        "format": "jdbc", **CONNECTION, "dbtable": "users", "fetchsize": "10000"
    }
    assert source.read_table(Session(), {**CONNECTION, "fetchSize": "5"}, "users")["fetchSize"] == "5"
    assert "fetchsize" not in source.read_table(Session(), {**CONNECTION, "fetchSize": "5"}, "users")


def test_split_table_reads_one_value_per_connection():
    kept = source.read_table_split(Session(), CONNECTION, "reviews", 100)
    assert kept["partitionColumn"] == "spark_partition" and kept["lowerBound"] == "0"
    assert kept["upperBound"] == kept["numPartitions"] == "100"


def test_remote_query():
    kept = source.read_query(Session(), CONNECTION, "SELECT 1")
    assert kept["query"] == "SELECT 1" and "dbtable" not in kept


def _typed(spark):
    return spark.sql(
        "SELECT true AS flag, 1Y AS b, 2S AS s, 3 AS i, 4L AS l, 1.23455f AS f, 1.23455d AS d, 'x' AS t,"
        " '' AS empty, DATE'2020-01-02' AS day, TIMESTAMP'2020-01-02 03:04:05' AS ts, CAST(NULL AS DOUBLE) AS n"
    )


def test_column_types(spark):
    assert sink.column_types(_typed(spark)) == (
        "flag DECIMAL(1, 0), b DECIMAL(3, 0), s DECIMAL(5, 0), i DECIMAL(10, 0), l DECIMAL(19, 0), "
        "f DECIMAL(19, 4), d DECIMAL(19, 4), t VARCHAR(4000), empty VARCHAR(4000), day DATE, n DECIMAL(19, 4)"
    )


def test_sink_values(spark):
    row = sink.sink_values(_typed(spark)).head()
    assert row.flag == Decimal(1) and row.l == Decimal(4) and row.d == Decimal("1.2346")
    assert row.empty is None and row.t == "x" and row.n is None
    assert row.day == dt.date(2020, 1, 2) and row.ts == dt.datetime(2020, 1, 2, 3, 4, 5)


def test_upper_columns(spark):
    assert sink.upper_columns(spark.range(1).selectExpr("id AS location_id", "1 AS Year")).columns == [
        "LOCATION_ID", "YEAR",
    ]


def test_attributes_become_json(spark):
    base = spark.range(1)
    as_map = base.select(F.create_map(F.lit("a"), F.lit("1"), F.lit("b"), F.lit(None)).alias("attributes"))
    as_struct = base.select(F.struct(F.lit("1").alias("a"), F.lit(None).cast("string").alias("b")).alias("attributes"))
    for frame in (as_map, as_struct):
        assert sink.attributes_as_json(frame).head()[0] == '{"a":"1"}'
    text = base.select(F.lit("{}").alias("attributes"))
    assert sink.attributes_as_json(text).head()[0] == "{}"
    missing = base.select(F.lit(None).cast("map<string,string>").alias("attributes"))
    assert sink.attributes_as_json(missing).head()[0] is None


def test_write_replaces_rows_and_keeps_the_table(spark, monkeypatch):
    recorder = Recorder()
    monkeypatch.setattr(type(spark.range(1)), "write", property(lambda _: recorder))
    frame = spark.range(1).toDF("ID")
    sink.write_table(frame, CONNECTION, "T", sink.column_types(frame), batch_size=7, connections=3)
    assert recorder.saved and recorder.kept == {
        "format": "jdbc", "mode": "overwrite", **CONNECTION, "dbtable": "T", "truncate": True, "batchsize": 7,
        "numPartitions": 3, "createTableColumnTypes": "ID DECIMAL(19, 0)",
    }


def test_tables_are_loaded_in_order(spark, monkeypatch):
    one = spark.range(1)
    mart = Mart(
        business=one.selectExpr("id AS business_id", "named_struct('a', 'b') AS attributes"),
        location=one.selectExpr("id AS location_id"),
        category=one.selectExpr("id AS category_id"),
        business_category=one.selectExpr("id AS business_id"),
        calendar=one.selectExpr("202001 AS time_id"),
        performance_fact=one.selectExpr("202001 AS time_id", "1.23456d AS score_mean"),
    )
    written = []
    monkeypatch.setattr(sink, "write_table", lambda df, options, table, types, *rest: written.append((table, df, types)))
    sink.load_warehouse(mart, CONNECTION)
    assert [table for table, _, _ in written] == list(TABLES.values()) == [
        "DIM_BUSINESS", "DIM_LOCATION", "DIM_CATEGORY", "BRIDGE_BUSINESS_CATEGORY", "DIM_CALENDAR", "FACT_PERFORMANCE",
    ]
    frames = {table: (df, types) for table, df, types in written}
    assert frames["DIM_CALENDAR"][0].columns == ["ID_TEMPS"]
    assert frames["FACT_PERFORMANCE"][0].columns == ["TIME_ID", "SCORE_MEAN"]
    assert frames["FACT_PERFORMANCE"][0].head().SCORE_MEAN == Decimal("1.2346")
    assert frames["DIM_BUSINESS"][1] == "BUSINESS_ID DECIMAL(19, 0), ATTRIBUTES VARCHAR(4000)"


@pytest.mark.parametrize("limit", [0, 1, 2, 3, 4, 5, 6, 11])
def test_texts_are_cut_between_characters(spark, limit):
    texts = ["", "abc", "aé", "éé", "a😀b", "😀😀", "中文字", "ab中", "abcdefghijklm", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(sink.cut_text(df.t, limit)).collect()]
    want = [t if t is None else t.encode()[:limit].decode(errors="ignore") for t in texts]
    assert got == want


def test_rows_with_long_texts_are_set_aside(spark):
    df = spark.createDataFrame([(1, "é" * 3, "x"), (2, "é", None), (3, "ééé", "abcdefg"), (4, None, "")], "k int, a string, b string")
    fit, long = sink.split_long_texts(df, 5)
    assert sorted(r.k for r in fit.collect()) == [2, 4]
    assert sorted((r.k, r.too_long) for r in long.collect()) == [(1, "a"), (3, "a, b")]
