"""Physical plans over bucketed tables, with size-based broadcasts off as if every table were large."""

from __future__ import annotations

import re

import pytest

from quartier import testmart
from quartier.operators import facts
from quartier.plans import jobs, olap, summaries
from quartier.plans.mart import Store

SF_DIR = "/root/testdata/sf0.001"

REPORTS = {**olap.REPORTS, **dict(zip(("m1", "m2", "m3"), summaries.SUMMARIES.values()))}


@pytest.fixture(scope="module")
def mart(spark, tmp_path_factory):
    store = Store(spark, str(tmp_path_factory.mktemp("mart")), buckets=4, prefix="plan_")
    source = testmart.Inputs(spark, SF_DIR)
    mart = jobs.build_mart(source.businesses(), source.reviews(), source.tips(), source.checkins(), store)
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield mart
    for key in settings:
        spark.conf.unset(key)
    for name in ("performance_fact", "location", "business_category", "business"):
        spark.sql(f"DROP TABLE plan_{name}")


def _plan(df) -> str:
    """The physical plan without expression ids."""
    return re.sub(r"#\d+L?", "", df._jdf.queryExecution().executedPlan().toString())


@pytest.fixture
def whole(monkeypatch):
    """Reports as one plan, without the tables they keep on the way."""
    monkeypatch.setattr(olap, "cut_lineage", lambda df: df)


def _first_shuffle(plan: str, table: str) -> str:
    """The exchange nearest above the first scan of a table."""
    lines = plan.splitlines()
    at = next(i for i, line in enumerate(lines) if f"{table}[" in line)
    depth = re.search(r"\w|\*", lines[at]).start()
    for line in reversed(lines[:at]):
        here = re.search(r"\w|\*", line).start()
        if here < depth:
            depth = here
            if re.match(r"[\s:|+-]*Exchange", line):
                return line
    return ""


# What the rows of the fact are partitioned by in the first shuffle they meet; always totals of a report's groups.
FIRST_SHUFFLE = {
    "q1": "hashpartitioning(state, year,",
    "q2": "hashpartitioning(state, category_id, year,",
    "q3": "hashpartitioning(city, state,",
    "q4": "hashpartitioning(mean, total_avis,",  # a join with k rows, broadcast unless that is off, as here
    "q5": "hashpartitioning(state, year, quarter,",
    "q6": "",
    "q7": "hashpartitioning(state, category_id,",
    "q8": "rangepartitioning(score_potentiel ",
    "m1": "hashpartitioning(state, year,",
    "m2": "hashpartitioning(state, city,",
    "m3": "hashpartitioning(category_id,",
}


@pytest.mark.parametrize("name", list(REPORTS))
def test_large_tables_are_combined_before_any_shuffle(mart, whole, name):
    plan = _plan(REPORTS[name](mart))
    shuffle = _first_shuffle(plan, "plan_performance_fact")
    assert FIRST_SHUFFLE[name] in shuffle and bool(shuffle) == bool(FIRST_SHUFFLE[name])
    if name != "m3":
        assert _first_shuffle(plan, "plan_location") == shuffle
    if name in {"q7", "m3"}:
        assert _first_shuffle(plan, "plan_business_category") == shuffle


def test_cube_reads_the_bridge_in_its_buckets(mart, whole):
    plan = _plan(REPORTS["q2"](mart))
    assert _first_shuffle(plan, "plan_business_category") == _first_shuffle(plan, "plan_performance_fact")


@pytest.mark.parametrize("name", list(REPORTS))
def test_only_bounded_tables_are_broadcast(mart, whole, name):
    plan = _plan(REPORTS[name](mart))
    broadcasts = plan.split("BroadcastExchange")[1:]
    for side in broadcasts:
        source = re.search(r"FileScan parquet \S*\[(\w+)|TakeOrderedAndProject\(limit=(\d+)", side)
        assert source.group(1) == "time_id" or source.group(2) == "20"
    assert len(broadcasts) <= 1


@pytest.mark.parametrize("name", ["q1", "q2", "q3", "q4", "q7", "q8"])
def test_scored_filter_and_columns_reach_the_scan(mart, whole, name):
    plan = _plan(REPORTS[name](mart))
    scan = next(line for line in plan.splitlines() if "plan_performance_fact[" in line)
    assert "IsNotNull(score_mean)" in scan
    assert "location_id" not in scan.split("]")[0]


def test_unordered_windows_hold_slices_only(mart, whole):
    """The one window over all rows of the city ranking runs over slice totals."""
    plan = _plan(REPORTS["q3"](mart))
    gathered = [line for line in plan.splitlines() if "SinglePartition" in line]
    assert len(gathered) == 1
    after = plan[plan.index("SinglePartition"):].splitlines()[1]
    assert "_slice" in after and "city" not in after


def test_fact_needs_one_shuffle_of_events(spark, mart):
    source = testmart.Inputs(spark, SF_DIR)
    plan = _plan(facts.activity(source.reviews(), source.tips(), source.checkins()))
    assert plan.count("hashpartitioning(business_id, time_id") == 1 and "FullOuter" not in plan


def test_jobs_stage_the_same_mart(mart, spark, as_rows):
    lazy = testmart.build_mart(spark, SF_DIR)
    for name in ("performance_fact", "location", "business_category", "calendar", "category"):
        assert as_rows(getattr(mart, name)) == as_rows(getattr(lazy, name))


def test_repeated_business_is_refused(spark, tmp_path):
    businesses = testmart.Inputs(spark, SF_DIR).businesses()
    with pytest.raises(ValueError, match="location_id"):
        jobs.build_dimensions(businesses.union(businesses), Store(spark, str(tmp_path)))
