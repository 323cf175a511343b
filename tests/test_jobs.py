"""The jobs from input files to reports, through the command line."""

from __future__ import annotations

import datetime as dt
import json

import pytest

from quartier.__main__ import main
from quartier.plans import jobs
from quartier.plans.mart import Store
from quartier.plans.summaries import SUMMARIES
from quartier.sources import jdbc


@pytest.fixture(scope="module")
def root(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("jobs")
    businesses = [
        {"business_id": "a", "name": "A", "city": "X", "state": "S", "stars": 4.5, "is_open": 1,
         "attributes": {"WiFi": "no"}, "categories": "Bars, Cafés"},
        {"business_id": "b", "name": "B", "city": "Y", "state": "S", "stars": 3.0, "is_open": 0, "categories": "Bars"},
    ]
    lines = [json.dumps(b) for b in businesses] + ["broken", "broken too"]
    (folder / "business.json").write_text("\n".join(lines))
    (folder / "checkin.json").write_text('{"business_id":"a","date":"2020-01-03 00:00:00, 2020-02-03 00:00:00"}\n')
    (folder / "tip.csv").write_text(
        'user_id,business_id,text,date,compliment_count\nu,a,"hi, there",2020-01-09 10:00:00,0\n'
    )
    root = str(folder / "staged")
    reviews = spark.createDataFrame(
        [("r1", "a", dt.datetime(2020, 1, 5), 5.0, 0), ("r2", "a", dt.datetime(2021, 1, 5), 4.0, 1),
         ("r3", "b", dt.datetime(2020, 2, 5), 2.0, None)],
        "review_id string, business_id string, date timestamp, stars double, spark_partition int",
    )
    main(["dimensions", "--root", root, "--business", str(folder / "business.json")])
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(jdbc, "read_table_split", lambda *_: reviews)
        main(["reviews", "--root", root, "--table", "review", "--jdbc", "url=jdbc:x"])
    main(["calendar", "--root", root])
    main(["fact", "--root", root, "--tips", str(folder / "tip.csv"), "--checkins", str(folder / "checkin.json")])
    main(["summaries", "--root", root])
    return root


def test_staged_fact(spark, root, as_rows):
    fact = Store(spark, root).load("performance_fact").drop("location_id")
    assert as_rows(fact) == [
        ("a", 202001, 1, 1, 1, 5.0), ("a", 202002, 0, 0, 1, None), ("a", 202101, 1, 0, 0, 4.0),
        ("b", 202002, 1, 0, 0, 2.0),
    ]


def test_staged_tables(spark, root):
    store = Store(spark, root)
    assert store.load(jobs.REVIEW_SOURCE).columns == ["review_id", "business_id", "date", "stars"]
    assert store.load("category").count() == 2 and store.load("business_category").count() == 3
    assert all(store.load(name).count() > 0 for name in SUMMARIES)


def test_report_is_shown_and_kept(spark, root, capfd, tmp_path):
    main(["report", "q1", "--root", root, "--rows", "2", "--output", str(tmp_path / "q1")])
    shown = capfd.readouterr().out
    kept = spark.read.parquet(str(tmp_path / "q1"))
    assert kept.count() > 2 and f"2 of {kept.count()} rows shown" in shown


def test_records_without_a_business_are_set_aside(spark, root):
    store = Store(spark, root)
    assert store.load(jobs.BUSINESS_REJECTS).count() == 2
    assert store.load("location").count() == store.load("business").count() == 2


def test_a_failed_load_leaves_the_tables_as_they_were(spark, root, tmp_path):
    path = tmp_path / "twice.json"
    path.write_text('{"business_id":"z","name":"Z"}\n{"business_id":"z","name":"Z"}\n')
    with pytest.raises(ValueError, match="not unique"):
        main(["dimensions", "--root", root, "--business", str(path)])
    assert {r.business_id for r in Store(spark, root).load("location").collect()} == {"a", "b"}
    assert Store(spark, root).load("business_category").count() == 3


def test_tables_go_to_the_sink(root, monkeypatch):
    from quartier.sinks import jdbc as sink

    loaded = []
    monkeypatch.setattr(sink, "write_table", lambda df, options, table, *rest: loaded.append((table, options, rest)))
    main(["load", "--root", root, "--jdbc", "url=jdbc:x?a=b", "--batch-size", "9", "--connections", "2"])
    assert len(loaded) == 6 and loaded[-1][0] == "FACT_PERFORMANCE"
    assert loaded[0][1] == {"url": "jdbc:x?a=b"} and loaded[0][2][1:] == (9, 2)
