"""Late events and summaries that merge: always equal to building everything anew."""

from __future__ import annotations

import datetime as dt
import random

import pytest

from quartier.operators import dims, facts
from quartier.plans import increments, states, summaries
from quartier.plans.mart import Mart, Store
from quartier.session import cut_lineage

REVIEW = "review_id string, business_id string, date timestamp, stars double"
PLAIN = "business_id string, date timestamp"


def _events(pick, n, months):
    def day():
        month = pick.choice(months)
        return dt.datetime(2020 + month // 12, 1 + month % 12, pick.randint(1, 28))

    return (
        [(f"r{pick.random()}", f"b{pick.randint(0, 12)}", day(), pick.choice([1.0, 2.0, 5.0, None])) for _ in range(n)],
        [(f"b{pick.randint(0, 12)}", day()) for _ in range(n)],
        [(f"b{pick.randint(0, 14)}", day()) for _ in range(n)] + [(None, day()), ("b1", None)],
    )


def _frames(spark, rows):
    return [spark.createDataFrame(r, s) for r, s in zip(rows, (REVIEW, PLAIN, PLAIN))]


@pytest.fixture(scope="module")
def dimensions(spark):
    pick = random.Random(2)
    rows = [(f"b{k}", f"N{k}", f"city{k % 3}", f"state{k % 2}", pick.choice([4.5, 4.25, 3.0, None]), k % 4 and 1,
             pick.choice(["A, B", "B", "A, C", "A, A", None])) for k in range(13)]
    df = spark.createDataFrame(rows, "business_id string, name string, city string, state string, stars double, is_open long, categories string")
    business = cut_lineage(df.selectExpr("*", "'' AS address", "'' AS postal_code", "0D AS latitude", "0D AS longitude", "map('k', 'v') AS attributes"))
    return business


def test_batches_equal_the_whole_build(spark, tmp_path, dimensions, as_rows):
    pick = random.Random(5)
    location = cut_lineage(dims.location_dim(dimensions))
    monthly = increments.MonthlyFact(spark, str(tmp_path / "fact"), location)
    batches = {
        "first": _events(pick, 120, range(9, 15)),
        # Tips and check-ins of months without a review yet among others.
        "late1": (_events(pick, 20, [11, 12])[0], *(_events(pick, 20, [11, 12, 18, 19])[1:])),
        "late2": (_events(pick, 5, [19])[0], [], []),  # whose first review comes later
    }
    summary = states.SummaryStates(Store(spark, str(tmp_path / "states")))

    def mart(fact):
        category = dims.category_dim(dimensions)
        return Mart(dims.business_dim(dimensions), location, category, dims.business_category(dimensions), monthly.calendar(), fact)

    def check(known):
        rows = [sum((batch[k] for batch in known), []) for k in range(3)]
        reviews, tips, checkins = _frames(spark, rows)
        calendar = dims.month_dim(reviews, "date")
        want = facts.performance_fact(reviews, tips, checkins, location, calendar)
        assert as_rows(monthly.fact()) == as_rows(want.select(*monthly.fact().columns))
        assert as_rows(monthly.calendar()) == as_rows(calendar)
        whole = mart(want)
        assert as_rows(summary.state_years()) == as_rows(summaries.state_years(whole))
        assert as_rows(summary.gems_by_city(20)) == as_rows(summaries.gems_by_city(whole, max_reviews=20))
        assert as_rows(summary.category_stats(whole.category)) == as_rows(summaries.category_stats(whole))

    known = []
    for number, (name, rows) in enumerate(batches.items()):
        change = monthly.add(name, *_frames(spark, rows))
        known.append(rows)
        if number:
            summary.merge(change.before, change.after, mart(monthly.fact().limit(0)))
        else:
            summary.build(mart(monthly.fact()))
    check(known)
    assert change.after.count() < 0.4 * monthly.fact().count()  # one month was touched

    change = monthly.add("late1", *_frames(spark, batches["late1"]))  # again, as after a failure
    assert as_rows(change.before) == as_rows(change.after)
    calendar = cut_lineage(monthly.calendar())  # with the month of what was there before
    change = monthly.add("late2", *_frames(spark, ([], [], [])))  # corrected: the month loses its only review
    summary.merge(change.before, change.after, Mart(**{**vars(mart(monthly.fact())), "calendar": calendar}))
    check([*known[:-1], ([], [], [])])


def test_batches_are_named_plainly(spark, tmp_path, dimensions):
    monthly = increments.MonthlyFact(spark, str(tmp_path), cut_lineage(dims.location_dim(dimensions)))
    with pytest.raises(ValueError, match="letters and digits"):
        monthly.add("../x", *_frames(spark, ([], [], [])))
    change = monthly.add("none", *_frames(spark, ([], [], [])))
    assert change.before.count() == change.after.count() == 0 and monthly.calendar().count() == 0


def _kept_plans(monkeypatch) -> list[str]:
    """The plans of the tables that loads keep, as they come."""
    plans = []

    def spy(df):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return cut_lineage(df)

    monkeypatch.setattr(increments, "cut_lineage", spy)
    return plans


def test_keys_are_looked_for_in_late_batches_only_and_over_tasks_by_their_events(spark, tmp_path, dimensions, as_rows, monkeypatch):
    pick = random.Random(8)
    location = cut_lineage(dims.location_dim(dimensions))
    first, late = _events(pick, 90, range(9, 12)), _events(pick, 10, [10, 11])
    monthly = increments.MonthlyFact(spark, str(tmp_path / "fact"), location)
    plans = _kept_plans(monkeypatch)
    change = monthly.add("first", *_frames(spark, first))
    assert not any("LeftSemi" in plan or "LeftAnti" in plan for plan in plans)
    assert change.before.count() == 0 and as_rows(change.after) == as_rows(monthly.fact())

    plans.clear()
    monkeypatch.setattr(increments, "TASK_EVENTS", 20)
    monthly.add("late", *_frames(spark, late))
    of_months = sum(events.where("time_id IN (202011, 202012)").count() for events in map(monthly.events, increments.KINDS))
    tasks = 1 + of_months // 20
    assert tasks > 4
    # The rows of touched keys from their events, those before and those that stay.
    dealt = [plan for plan in plans if "RepartitionByExpression [business_id" in plan]
    assert len(dealt) == 3 and all(f"], {tasks}" in plan for plan in dealt)
    everything = [[*a, *b] for a, b in zip(first, late)]
    reviews, tips, checkins = _frames(spark, everything)
    whole = facts.performance_fact(reviews, tips, checkins, location, dims.month_dim(reviews, "date"))
    assert as_rows(monthly.fact()) == as_rows(whole)


def test_merged_summaries_read_dimensions_that_are_kept(spark, tmp_path, as_rows):
    import __spark_entry__ as entry

    day = [dt.datetime(1995 + k % 2, 1 + k % 5, 1 + k % 20) for k in range(60)]
    tables = {
        "region": ([(0, "ASIA")], "r_regionkey int, r_name string"),
        "nation": ([(0, "N0", 0), (1, "N1", 0)], "n_nationkey int, n_name string, n_regionkey int"),
        "customer": ([(k, f"C{k}", k % 2, float(k - 1), "SEG") for k in range(9)],
                     "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"),
        "part": ([(0, "P0"), (1, "P1")], "p_partkey long, p_type string"),
        "orders": ([(k, k % 9, "OF"[k % 2], day[k], f"{1 + k % 5}-X") for k in range(60)],
                   "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp, o_orderpriority string"),
        "lineitem": ([(k, k % 2, day[k]) for k in range(60)], "l_orderkey long, l_partkey long, l_shipdate timestamp"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    _, mart = entry._merged_states(spark, str(tmp_path))
    for table in (mart.business, mart.location, mart.business_category, mart.calendar):
        assert all("/kept-" in file for file in table.inputFiles())
    queries = entry.queries()
    for merged, built in (("m1_merged_after_change", "m1_state_years"), ("m3_merged_after_change", "m3_category_stats")):
        assert as_rows(queries[merged](spark, str(tmp_path))) == as_rows(queries[built](spark, str(tmp_path)))
