from __future__ import annotations

import datetime as dt

import pytest

from quartier.operators import checks, facts
from quartier.session import cut_lineage, shared_dir
from quartier.sources import files, staged


def _file(tmp_path, name, text):
    path = tmp_path / name
    path.write_text(text)
    return str(path)


def test_business_file(spark, tmp_path):
    path = _file(tmp_path, "b.json", "\n".join([
        '{"business_id":"a","name":"A","stars":4.5,"is_open":1,"city":"X","state":"S","attributes":'
        '{"WiFi":"u\'free\'","ByAppointmentOnly":null},"categories":"A, B","hours":{"Monday":"8-9"}}',
        '{"business_id":"b","state":"","attributes":null,"categories":null}',
        "not json",
    ]))
    found = {r.business_id: r for r in files.load_business(spark, path).collect()}
    assert set(found) == {"a", "b", None}
    assert found["a"].attributes == {"WiFi": "u'free'", "ByAppointmentOnly": None}
    assert found["a"].is_open == 1 and found["b"].attributes is None and found["b"].state == ""
    struct = files.load_business(spark, path, spark.createDataFrame([], "WiFi string").schema)
    assert struct.filter("business_id = 'a'").select("attributes.WiFi").head()[0] == "u'free'"


def test_checkin_file(spark, tmp_path, as_rows):
    path = _file(tmp_path, "c.json", "\n".join([
        '{"business_id":"a","date":"2012-05-18 02:17:21,  2012-06-01 10:00:00 , bad"}',
        '{"business_id":"b","date":"2012-05-01 00:00:00"}',
        '{"business_id":"c","date":null}',
    ]))
    checkins = files.load_checkins(spark, path)
    assert as_rows(checkins) == [
        ("a", "2012-05-18 02:17:21"), ("a", "2012-06-01 10:00:00"), ("a", "bad"), ("b", "2012-05-01 00:00:00"),
    ]
    assert as_rows(facts.checkin_facts(checkins)) == [("a", 201205, 1), ("a", 201206, 1), ("b", 201205, 1)]


TIPS = r'''user_id,business_id,text,date,compliment_count
u,a,plain,2012-05-18 02:17:21,0
u,a,"comma, inside",2012-05-19 00:00:00,0
u,a,"quote \" inside",2012-05-20 00:00:00,0
u,a
u,a,extra,2012-05-21 00:00:00,0,surplus
u,a,no date,,0
u,a,bad date,yesterday,0
u,,no business,2012-05-22 00:00:00,0
u,b,bad count,2012-06-01 00:00:00,many
'''


def test_tip_file_keeps_the_same_lines_under_any_projection(spark, tmp_path):
    tips = files.load_tips(spark, _file(tmp_path, "t.csv", TIPS))
    kept = {("a", 18), ("a", 19), ("a", 20), ("a", 21), ("b", 1)}
    whole = {(r.business_id, r.date.day) for r in tips.collect()}
    pruned = {(r.business_id, r.date.day) for r in tips.select("business_id", "date").collect()}
    assert whole == pruned == kept
    assert tips.count() == tips.select("business_id").count() == len(kept)
    assert {r.text for r in tips.collect()} >= {"comma, inside", 'quote " inside'}


def test_tips_with_line_breaks_and_doubled_quotes(spark, tmp_path):
    text = 'user_id,business_id,text,date,compliment_count\n' + "".join(
        f'u,{name},"{said}",2020-01-0{k} 10:00:00,0\n' for k, (name, said) in enumerate([("a", "two\nlines"), ("b", 'so ""good"", yes'), ("c", "plain")], 1)
    )
    path = _file(tmp_path, "t.csv", text)
    tips = files.load_tips(spark, path, multi_line=True, escape='"')
    assert {(r.business_id, r.text) for r in tips.collect()} == {("a", "two\nlines"), ("b", 'so "good", yes'), ("c", "plain")}


def test_lines_left_out_are_accounted_for(spark, tmp_path):
    lines = ['{"business_id":"a","date":"2020-01-01"}', "broken", '{"date":"2020-01-02"}', "", '{"business_id":"b"}']
    found = files.rejected_ndjson(spark, _file(tmp_path, "c.json", "\n".join(lines)), files.schemas.CHECKIN, ["business_id"], "checkin")
    assert {tuple(r) for r in found.collect()} == {
        ("checkin", "no business_id", "broken"), ("checkin", "no business_id", '{"date":"2020-01-02"}')
    }
    path = _file(tmp_path, "t.csv", TIPS)
    kept = files.load_tips(spark, path).count()
    rejects = files.rejected_csv(spark, path, files.schemas.TIP, ["business_id", "date"], "tip")
    whole = [line for line in TIPS.split("\n")[1:] if line.strip()]
    assert kept + rejects.count() == len(whole)


def test_staged_tables_are_replaced(spark, tmp_path, as_rows):
    root = str(tmp_path)
    staged.save(spark.range(5).toDF("x"), root, "t")
    staged.save(spark.range(2).toDF("x"), root, "t")
    assert as_rows(staged.load(spark, root, "t")) == [(0,), (1,)]


def test_bucketed_tables_join_and_group_without_a_shuffle(spark, tmp_path):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        frame = spark.range(1000).selectExpr("id % 50 AS business_id", "id AS v")
        staged.save_bucketed(frame, "left_side", 4, path=str(tmp_path / "l"))
        staged.save_bucketed(frame.select("business_id").distinct(), "right_side", 4, path=str(tmp_path / "r"))
        joined = spark.table("left_side").join(spark.table("right_side"), "business_id").groupBy("business_id").count()
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == 50
        assert len(list((tmp_path / "l").glob("*.parquet"))) <= 4
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE IF EXISTS left_side")
        spark.sql("DROP TABLE IF EXISTS right_side")


def test_require_unique(spark):
    checks.require_unique(spark.range(3), "id")
    with pytest.raises(ValueError, match="not unique"):
        checks.require_unique(spark.range(3).union(spark.range(1)), "id")


def test_shared_folder_is_the_configured_one(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    kept = cut_lineage(spark.range(3).selectExpr("id", "current_date() AS d"))
    assert kept.count() == 3 and kept.head().d >= dt.date(2020, 1, 1)
