"""Reports and summaries on a mart with awkward rows, against the plain SQL of the registry on DuckDB."""

from __future__ import annotations

import random

import duckdb
import pytest

import __spark_entry__ as registry
from compare import differences
from quartier.operators.dims import surrogate_key
from quartier.plans import olap, summaries
from quartier.plans.mart import Mart, Store

CATEGORIES = ["Bars", "Cafés", "Hôtels", "Unused"]


def _tables(seed: int) -> dict[str, tuple[list[tuple], str]]:
    """NULL states and cities, repeated bridge pairs, unscored months, tied means, one state, city and category with a
    third of the rows or more."""
    rng = random.Random(seed)
    businesses = range(60)

    def place(business):
        if rng.random() < 0.4:
            return "ASIA", "Hot"
        return rng.choice(["EUROPE", "AFRICA", None]), rng.choice(["X", "Y", "Z", None])

    location = [(b, *place(b)[::-1]) for b in businesses]
    months = [(y * 100 + m, y, m, (m + 2) // 3) for y in (2018, 2019, 2021) for m in range(1, 13) if rng.random() < 0.7]
    fact = []
    for b in businesses:
        for t, *_ in months:
            if rng.random() < 0.5:
                reviews = rng.choice([0, 0, 1, 2, 40])
                score = None if reviews == 0 else rng.choice([5.0, 5.0, 4.5, 4.0, 1 / 3, 2.675])
                if b % 7 == 0 and score is not None:
                    score = 5.0
                fact.append((b, t, reviews, rng.randint(0, 3), rng.randint(0, 9), score))
    fact.append((0, 190001, 99, 0, 0, 5.0))  # a month that the calendar lacks
    fact.append((999, months[0][0], 99, 0, 0, 5.0))  # a business that the locations lack
    pairs = [(b, c) for b in businesses for c in ("Bars", "Cafés", "Hôtels") if c == "Bars" or rng.random() < 0.4]
    pairs += [p for p in pairs if rng.random() < 0.1]
    pairs = [p for p in pairs if p[0] != 5]  # a business without categories
    stars = [(b, f"n{b}", rng.choice([None, 3.0, 4.2, 4.5, 5.0]), rng.choice([0, 1]), "{}") for b in businesses]
    return {
        "location": (location, "business_id long, city string, state string"),
        "calendar": (months, "time_id int, year int, month int, quarter int"),
        "fact": (
            fact,
            "business_id long, time_id int, review_count long, tip_count long, checkin_count long, score_mean double",
        ),
        "bridge": (pairs, "business_id long, category_name string"),
        "business": (stars, "business_id long, name string, stars double, is_open long, attributes string"),
    }


@pytest.fixture(scope="module", params=[1, 2])
def both(request, spark):
    """The mart for Spark and its tables on DuckDB."""
    con = duckdb.connect()
    frames = {}
    for name, (data, schema) in _tables(request.param).items():
        columns = schema.replace("long", "BIGINT").replace("string", "VARCHAR")
        con.execute(f"CREATE TABLE {name} ({columns})")
        con.executemany(f"INSERT INTO {name} VALUES ({', '.join('?' * len(data[0]))})", data)
        frames[name] = spark.createDataFrame(data, schema).cache()
    category = spark.createDataFrame([(c,) for c in CATEGORIES], "category_name string").withColumn(
        "category_id", surrogate_key("category_name")
    )
    bridge = frames["bridge"].join(category, "category_name").select("business_id", "category_id")
    mart = Mart(frames["business"], frames["location"], category, bridge, frames["calendar"], frames["fact"])
    return mart, con


NAMES = [name for name in registry.queries() if name[:2] in {"q1", "q2", "q3", "q4", "q5", "q6", "q7", "q8"}] + [
    "m1_state_years", "m2_gems_by_city", "m3_category_stats",
]


@pytest.mark.parametrize("name", NAMES)
def test_report_equals_plain_sql(both, monkeypatch, name):
    mart, con = both
    monkeypatch.setattr(registry.testmart, "build_mart", lambda *_: mart)
    sql = registry.oracle_sql()[name].replace(registry._MART, "WITH unused AS (SELECT 1)")
    assert differences(registry.queries()[name](None, None), con, sql) == []


def _list(df):
    return [tuple(r) for r in df.collect()]


def test_rollup_order_and_totals(both):
    mart, _ = both
    report = _list(olap.rollup_state_year(mart.performance_fact, mart.location, mart.calendar))
    assert report[-1][:2] == ("TOTAL_GLOBAL", "TOTAL_ANNEE")
    assert [r[0] for r in report].index(None) > [r[0] for r in report].index("EUROPE")
    years = [r for r in report if r[1] != "TOTAL_ANNEE"]
    assert sum(r[3] for r in years) == report[-1][3]
    for state in {r[0] for r in years}:
        block = [r for r in report if r[0] == state]
        assert [r[1] for r in block] == sorted(r[1] for r in block if r[1] != "TOTAL_ANNEE") + ["TOTAL_ANNEE"]


def test_cube_holds_one_row_per_key(both):
    mart, _ = both
    report = _list(olap.cube_state_category_year(
        mart.performance_fact, mart.location, mart.calendar, mart.business_category, mart.category
    ))
    keys = [r[:3] for r in report]
    assert len(keys) == len(set(keys)) and report[-1][:3] == ("TOUS_ETATS", "TOUTES_CATEGORIES", "TOUTES_ANNEES")
    assert "Unused" not in {r[1] for r in report}


def test_ranked_reports_are_ordered(both):
    mart, _ = both
    fact, location, calendar = mart.performance_fact, mart.location, mart.calendar
    cities = _list(olap.rank_cities(fact, location))
    assert [r[-1] for r in cities] == sorted(r[-1] for r in cities)
    gems = _list(olap.top_gems(fact, location))
    assert [r[-1] for r in gems] == sorted(r[-1] for r in gems) and gems[0][-1] == 1
    growth = [r[-1] for r in _list(olap.yoy_growth(fact, location, calendar))]
    assert growth == sorted(growth, reverse=True)
    scores = [r.score_potentiel for r in olap.potential_score(fact, location).collect()]
    assert scores == sorted(scores, reverse=True)
    top = _list(olap.potential_score(fact, location, gems_only=True, limit=3))
    assert len(top) <= 3 and all(r[-1] == "OUI" for r in top)


def test_previous_period_is_the_last_one_with_rows(both):
    """2020 has no rows, so 2021 is compared with 2019."""
    mart, _ = both
    growth = olap.yoy_growth(mart.performance_fact, mart.location, mart.calendar, k=10**6)
    assert growth.filter("annee = 2021").count() > 0


def test_rounded_and_raw_means_decide_differently(spark):
    """The gem report tests the raw mean, the potential score the one rounded to two decimals."""
    location = spark.createDataFrame([(1, "c", "s")], "business_id long, city string, state string")
    fact = spark.createDataFrame(
        [(1, 202001, 1, 9, 99, 4.196)],
        "business_id long, time_id int, review_count long, tip_count long, checkin_count long, score_mean double",
    )
    assert olap.top_gems(fact, location).count() == 0
    assert olap.potential_score(fact, location).head().est_pepite == "OUI"


def test_refresh_replaces_the_stored_summaries(both, spark, tmp_path, as_rows):
    mart, _ = both
    for _ in range(2):
        stored = summaries.refresh_all(mart, Store(spark, str(tmp_path)))
    for name, compute in summaries.SUMMARIES.items():
        assert as_rows(stored[name]) == as_rows(compute(mart))


def test_sql_over_views(both, spark):
    mart, _ = both
    mart.create_views()
    found = spark.sql(
        "SELECT COUNT(DISTINCT f.business_id) FROM FACT_PERFORMANCE f "
        "JOIN DIM_LOCATION l ON f.business_id = l.business_id JOIN DIM_CALENDAR c ON f.time_id = c.ID_Temps"
    ).head()[0]
    assert found == 60
