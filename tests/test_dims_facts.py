from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from quartier.operators import checks, dims, facts
from quartier.session import cut_lineage

BUSINESS = (
    "business_id string, name string, address string, city string, state string, postal_code string, latitude double, "
    "longitude double, stars double, is_open long, attributes map<string,string>, categories string"
)


def _business(spark, *categories):
    rows = [(f"b{i}", "n", "a", "c", "s", "p", 1.0, 2.0, 3.0, 1, None, c) for i, c in enumerate(categories)]
    return spark.createDataFrame(rows, BUSINESS)


def test_category_and_bridge_share_one_split(spark, as_rows):
    business = _business(spark, "A, B", "A,B", " A , B ,", None, "C", "")
    category = dims.category_dim(business)
    assert as_rows(category.select("category_name")) == [("A",), ("B",), ("C",)]
    bridge = dims.business_category(business, category).join(category, "category_id")
    assert as_rows(bridge.select("business_id", "category_name")) == [
        ("b0", "A"), ("b0", "B"), ("b1", "A"), ("b1", "B"), ("b2", "A"), ("b2", "B"), ("b4", "C"),
    ]
    checks.require_unique(category, "category_id")


def test_bridge_keeps_only_known_categories_and_repeats(spark, as_rows):
    business = _business(spark, "A, B, A")
    category = dims.category_dim(business).filter("category_name = 'A'")
    assert len(as_rows(dims.business_category(business, category))) == 2


def test_bridge_needs_no_shuffle(spark):
    bridge = dims.business_category(_business(spark, "A, B", "A"))
    assert "Exchange" not in bridge._jdf.queryExecution().executedPlan().toString()
    assert bridge.count() == 3


def test_dimension_columns(spark):
    business = _business(spark, "A")
    assert dims.business_dim(business).columns == ["business_id", "name", "stars", "is_open", "attributes"]
    location = dims.location_dim(business)
    assert location.columns == [
        "business_id", "address", "city", "postal_code", "state", "latitude", "longitude", "location_id",
    ]
    assert dict(location.dtypes)["location_id"] == "bigint"


def test_location_keys_are_stable_and_unique(spark):
    business = spark.range(10000).selectExpr("cast(id AS string) AS business_id", *[
        f"'' AS {c}" for c in ("address", "city", "postal_code", "state")
    ], "0d AS latitude", "0d AS longitude")
    location = dims.location_dim(business)
    checks.require_unique(location, "location_id")
    assert location.exceptAll(dims.location_dim(business.repartition(5))).count() == 0


def test_calendar(spark, as_rows):
    events = spark.createDataFrame(
        [("2020-01-05",), ("2020-01-31 10:00:00",), ("2020-12-01",), ("2021-04-01",)], "date string"
    )
    calendar = dims.month_dim(events, "date")
    assert as_rows(calendar) == [(202001, 2020, 1, 1), (202012, 2020, 12, 4), (202104, 2021, 4, 2)]
    assert [tuple(r) for r in dims.months_per_year(calendar).collect()] == [(2020, 2), (2021, 1)]
    assert {kind for _, kind in calendar.dtypes} == {"int"}


def _events(spark):
    reviews = spark.createDataFrame([
        ("r1", "a", "2020-01-01 00:00:00", 4.0), ("r2", "a", "2020-01-15 00:00:00", 5.0),
        (None, "a", "2020-01-16 00:00:00", 3.0), ("r3", "b", "2020-02-01 00:00:00", None),
        ("r4", "a", "never", 1.0), ("r5", None, "2020-02-01 00:00:00", 1.0), ("r6", "gone", "2020-02-01 00:00:00", 2.0),
    ], "review_id string, business_id string, date string, stars double")
    tips = spark.createDataFrame([
        ("a", "2020-01-02 00:00:00"), ("a", "2020-02-02 00:00:00"), ("a", "2030-01-01 00:00:00"), ("b", None),
    ], "business_id string, date string")
    checkins = spark.createDataFrame([
        ("a", "2020-02-03 00:00:00"), ("a", "2020-02-04 00:00:00"), ("b", "2020-01-04 00:00:00"),
    ], "business_id string, date string")
    location = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "business_id string, location_id long")
    return reviews, tips, checkins, location, dims.month_dim(reviews, "date")


EXPECTED = [
    ("a", 202001, 1, 2, 1, 0, 4.0),
    ("a", 202002, 1, 0, 1, 2, None),
    ("b", 202001, 2, 0, 0, 1, None),
    ("b", 202002, 2, 1, 0, 0, None),
]


def test_performance_fact(spark, as_rows):
    fact = facts.performance_fact(*_events(spark))
    assert fact.columns == [
        "business_id", "time_id", "location_id", "review_count", "tip_count", "checkin_count", "score_mean",
    ]
    assert as_rows(fact) == EXPECTED


def test_full_join_of_separate_sets_gives_the_same_fact(spark, as_rows):
    reviews, tips, checkins, location, calendar = _events(spark)
    merged = facts.merge_facts(facts.review_facts(reviews), facts.tip_facts(tips), facts.checkin_facts(checkins))
    assert as_rows(facts.attach_dims(merged, location, calendar)) == EXPECTED


@pytest.mark.parametrize("seed", range(3))
def test_both_merges_agree_on_random_events(spark, as_rows, seed):
    rng = random.Random(seed)

    def day():
        return None if rng.random() < 0.1 else f"20{rng.randint(18, 20)}-{rng.randint(1, 12):02d}-01 00:00:00"

    def business():
        # One business has a third of all rows.
        return "hot" if rng.random() < 0.33 else rng.choice(["a", "b", "c", None])

    reviews = spark.createDataFrame(
        [(rng.choice(["r", None]), business(), day(), rng.choice([1.0, 2.5, 5.0, None])) for _ in range(300)],
        "review_id string, business_id string, date string, stars double",
    )
    tips, checkins = (
        spark.createDataFrame([(business(), day()) for _ in range(200)], "business_id string, date string")
        for _ in range(2)
    )
    stacked = facts.activity(reviews, tips, checkins)
    joined = facts.merge_facts(facts.review_facts(reviews), facts.tip_facts(tips), facts.checkin_facts(checkins))
    joined = joined.fillna(0, facts.COUNTS).select(stacked.columns)
    assert as_rows(stacked) == as_rows(joined)
    checks.require_unique(stacked, "business_id", "time_id")


def test_fact_counts_do_not_exceed_the_sources(spark):
    reviews, tips, checkins, location, calendar = _events(spark)
    totals = facts.performance_fact(reviews, tips, checkins, location, calendar).agg(
        F.sum("review_count"), F.sum("tip_count"), F.sum("checkin_count")
    ).head()
    assert totals[0] <= reviews.count() and totals[1] <= tips.count() and totals[2] <= checkins.count()
