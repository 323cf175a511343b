"""Published versions, and keys that stay from one to the next."""

from __future__ import annotations

import pytest

from quartier import testmart
from quartier.plans import jobs
from quartier.plans.mart import TABLES, Store
from quartier.plans.versions import PublishedMeanwhile, Versions
from quartier.session import cut_lineage

SF_DIR = "/root/testdata/sf0.001"


def _build(store, source, businesses):
    jobs.build_dimensions(businesses, store, dense_keys=True)
    jobs.build_calendar(source.reviews(), store)
    jobs.build_fact(source.reviews(), source.tips(), source.checkins(), store)


def _counts(mart):
    return {name: getattr(mart, name).count() for name in TABLES}


@pytest.mark.parametrize("buckets", [None, 2])
def test_readers_see_one_version_through_a_failed_load(spark, tmp_path, buckets):
    source = testmart.Inputs(spark, SF_DIR)
    businesses = cut_lineage(source.businesses())
    versions = Versions(spark, str(tmp_path / "v"), buckets, prefix="ver_")
    assert versions.version() == 0 and versions.manifest().count() == 0
    with versions.load() as store:
        _build(store, source, businesses.where("business_id % 2 = 0"))
    reader = versions.current()
    before, places = _counts(reader.mart()), dict(reader.places)
    keys = {r.business_id: r.location_id for r in reader.load("location").collect()}

    for stop_after in ("location", "calendar"):  # a load that fails between two of its tables
        with pytest.raises(InterruptedError), versions.load() as store:
            jobs.build_dimensions(businesses, store, dense_keys=True)
            if stop_after == "calendar":
                jobs.build_calendar(source.reviews(), store)
            raise InterruptedError
        assert versions.version() == 1 and versions.current().places == places
        assert _counts(versions.current().mart()) == before

    with versions.load() as store:
        _build(store, source, businesses)
    assert versions.version() == 2
    assert _counts(reader.mart()) == before  # who reads the older version goes on reading it
    after = {r.business_id: r.location_id for r in versions.current().load("location").collect()}
    assert sorted(after.values()) == list(range(1, businesses.count() + 1))
    assert {b: after[b] for b in keys} == keys
    fact = versions.current().load("performance_fact")
    assert {(r.business_id, r.location_id) for r in fact.collect()} <= set(after.items())

    with versions.load() as store:  # one table anew, the others as they were
        jobs.build_calendar(source.reviews().limit(10), store)
    last = versions.current()
    assert last.places["location"] != places["location"] and last.places["calendar"] != reader.places["calendar"]
    assert last.load("location").count() == businesses.count()
    assert versions.clean(keep=1) > 0
    assert _counts(versions.current().mart())["location"] == businesses.count()


def test_two_loads_at_once(spark, tmp_path):
    versions = Versions(spark, str(tmp_path / "v"))
    with pytest.raises(PublishedMeanwhile), versions.load() as first:
        first.save(spark.range(3), "x")
        with versions.load() as second:
            second.save(spark.range(5), "x")
    assert versions.version() == 1 and versions.current().load("x").count() == 5
    with pytest.raises(ValueError, match="cannot be changed"):
        versions.current().save(spark.range(1), "x")
    assert versions.current().load_if_there("y") is None


def test_dense_keys_of_a_plain_store(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    rows = [("b", "Bars, Cafés"), ("a", "Bars"), ("c", None)]
    schema = "business_id string, categories string"
    shape = "name string, address string, city string, postal_code string, state string, latitude double, longitude double, stars double, is_open long, attributes map<string,string>"

    def load(some):
        df = spark.createDataFrame(some, schema)
        for column in shape.split(", "):
            name, kind = column.split(" ")
            df = df.selectExpr("*", f"CAST(NULL AS {kind}) AS {name}")
        jobs.build_dimensions(df, store, dense_keys=True)
        return (
            {r.business_id: r.location_id for r in store.load("location").collect()},
            {r.category_name: r.category_id for r in store.load("category").collect()},
            sorted((r.business_id, r.category_id) for r in store.load("business_category").collect()),
        )

    assert load(rows) == ({"a": 1, "b": 2, "c": 3}, {"Bars": 1, "Cafés": 2}, [("a", 1), ("b", 1), ("b", 2)])
    again = load([("0", "Apples, Cafés"), ("b", "Bars")])
    assert again == ({"0": 4, "b": 2}, {"Apples": 3, "Bars": 1, "Cafés": 2}, [("0", 2), ("0", 3), ("b", 1)])
    assert load([("a", None)])[0] == {"a": 1}  # a key is kept for a value that was gone
    with pytest.raises(ValueError, match="not unique"):
        load([("z", None), ("z", None)])
    assert store.load("location").count() == 1
