"""Records set aside, with reason and text, by the readers and by the jobs."""

from __future__ import annotations

import datetime as dt

from quartier.__main__ import main
from quartier.operators import facts
from quartier.plans import jobs
from quartier.plans.mart import Store
from quartier.sources import files

HEADER = "user_id,business_id,text,date,compliment_count\n"
GOOD = [
    'u,a,"over\ntwo lines, with ""quotes""",2020-01-09 10:00:00,0',
    "u,a,plain,2020-01-10 10:00:00,0",
    "u,b,many,2020-01-10 10:00:00,many",
    "u,b,surplus,2020-01-10 10:00:00,0,1",
]
BAD = [
    ('u,,"no\nbusiness",2020-01-09 10:00:00,0', "no business_id", 'u,,"no\nbusiness",2020-01-09 10:00:00,0'),
    ('u,a,"bad\ndate",yesterday,1', "no date", None),
    ("u,a", "no date", None),
    ("u,,,,0", "no business_id, date", "u,,,,0"),
]


def _tips(tmp_path):
    path = tmp_path / "tip.csv"
    path.write_text(HEADER + "\n".join([*GOOD[:2], "", *(bad for bad, *_ in BAD), *GOOD[2:]]) + "\n")
    return str(path)


def test_records_over_several_lines_are_kept_or_set_aside_whole(spark, tmp_path):
    checked = files.check_tips(spark, _tips(tmp_path), multi_line=True, escape='"')
    good, bad = files.accepted(checked), files.rejects(checked, "tips")
    assert checked.count() == len(GOOD) + len(BAD) == good.count() + bad.count()
    assert sorted(r.text for r in good.collect()) == ["many", 'over\ntwo lines, with "quotes"', "plain", "surplus"]
    assert sorted(tuple(r) for r in bad.collect()) == sorted(("tips", reason, again or text) for text, reason, again in BAD)
    # Whichever columns are read, the same records are good.
    assert good.select("user_id").count() == good.select("business_id").count() == len(GOOD)
    assert facts.tip_facts(good).count() == 2


def test_json_records(spark, tmp_path):
    path = tmp_path / "b.json"
    path.write_text('{"business_id":"a","stars":"many"}\n \t\n{"name":"y"}\n{"business_id":"b","name":\n[]\n\nnull\n')
    checked = files.check_business(spark, str(path))
    assert [(r.business_id, r.stars) for r in files.accepted(checked).collect()] == [("a", None)]
    assert sorted(tuple(r) for r in files.rejects(checked, "s").collect()) == [
        ("s", "no business_id", '{"name":"y"}'), ("s", "not JSON", "[]"), ("s", "not JSON", "null"),
        ("s", "not JSON", '{"business_id":"b","name":'),
    ]


def test_frames_without_checks_pass(spark):
    plain = spark.range(3)
    assert files.accepted(plain).count() == 3
    assert files.rejects(plain, "s").count() == 0 and files.rejects(plain, "s").columns == ["source", "reason", "text"]


def test_jobs_stage_what_is_set_aside(spark, tmp_path):
    root = str(tmp_path / "staged")
    (tmp_path / "b.json").write_text('{"business_id":"a","categories":"Bars"}\n{"business_id":"b"}\nbroken\n{"name":"x"}\n')
    (tmp_path / "c.json").write_text('{"business_id":"a","date":"2020-01-03 00:00:00, 2020-02-03 00:00:00"}\n{"date":"x"}\nno\n')
    main(["dimensions", "--root", root, "--business", str(tmp_path / "b.json")])
    store = Store(spark, root)
    reviews = spark.createDataFrame(
        [("r", "a", dt.datetime(2020, 1, 5), 5.0)], "review_id string, business_id string, date timestamp, stars double"
    )
    jobs.stage_reviews(reviews, store)
    main(["calendar", "--root", root])
    main(["fact", "--root", root, "--tips", _tips(tmp_path), "--tips-multi-line", "--tips-escape", '"', "--checkins", str(tmp_path / "c.json")])
    assert sorted(tuple(r) for r in store.load("performance_fact").drop("location_id").collect()) == [
        ("a", 202001, 1, 2, 1, 5.0), ("b", 202001, 0, 2, 0, None),
    ]
    assert sorted(r.reason for r in store.load(jobs.BUSINESS_REJECTS).collect()) == ["no business_id", "not JSON"]
    assert store.load(jobs.TIP_REJECTS).count() == len(BAD)
    assert sorted((r.reason, r.text) for r in store.load(jobs.CHECKIN_REJECTS).collect()) == [
        ("no business_id", '{"date":"x"}'), ("not JSON", "no"),
    ]
    assert set(store.load(jobs.TIP_SOURCE).columns) == {"business_id", "date", files.REASON, files.TEXT}
