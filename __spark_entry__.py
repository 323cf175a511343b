"""Registered queries over the generated tables, and their DuckDB counterparts.

``queries()`` builds the star schema of ``quartier.testmart`` from the tables of a folder and runs every report,
summary and transformation over it. ``oracle_sql()`` states the same results in plain SQL, in the direct way: distinct
counts, full outer joins and global windows rather than the plan shapes of the library.
"""

from __future__ import annotations

import importlib
from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quartier import testmart
from quartier.operators import dims, facts
from quartier.plans import increments, jobs, layouts, olap, states, summaries
from quartier.plans.mart import Mart, Store
from quartier.plans.versions import Versions
from quartier.session import cut_lineage, scratch_path
from quartier.sinks import jdbc as sink
from quartier.sources import files

Query = Callable[[SparkSession, str], DataFrame]


def entry(spark: SparkSession) -> DataFrame:
    """State and year totals with subtotals on the smallest tables."""
    return queries()["q1_rollup_state_year"](spark, "/root/testdata/sf0.001")


# --- queries -----------------------------------------------------------------------------------------------------


def _on_mart(report: Callable[[Mart], DataFrame]) -> Query:
    return lambda spark, sf_dir: report(testmart.build_mart(spark, sf_dir))


def _on_inputs(operator: Callable[[testmart.Inputs], DataFrame]) -> Query:
    return lambda spark, sf_dir: operator(testmart.Inputs(spark, sf_dir))


def _rollup(m: Mart, **options) -> DataFrame:
    return olap.rollup_state_year(m.performance_fact, m.location, m.calendar, **options)


def _cube(m: Mart) -> DataFrame:
    return olap.cube_state_category_year(m.performance_fact, m.location, m.calendar, m.business_category, m.category)


def _cities(m: Mart, **options) -> DataFrame:
    return olap.rank_cities(m.performance_fact, m.location, **options)


def _gems(m: Mart, **options) -> DataFrame:
    return olap.top_gems(m.performance_fact, m.location, **options)


def _quarters(m: Mart, **options) -> DataFrame:
    return olap.quarterly_growth(m.performance_fact, m.location, m.calendar, **options)


def _yoy(m: Mart, **options) -> DataFrame:
    return olap.yoy_growth(m.performance_fact, m.location, m.calendar, **options)


def _categories(m: Mart, **options) -> DataFrame:
    return olap.top_categories(m.performance_fact, m.location, m.business_category, m.category, **options)


def _potential(m: Mart, **options) -> DataFrame:
    return olap.potential_score(m.performance_fact, m.location, **options)


def _fact_columns(m: Mart) -> DataFrame:
    return m.performance_fact.drop("location_id")


def _separate_facts(source: testmart.Inputs) -> DataFrame:
    """The fact merged by full outer joins of the three separately aggregated sets."""
    merged = facts.merge_facts(
        facts.review_facts(source.reviews()),
        facts.tip_facts(source.tips()),
        facts.checkin_facts(source.checkins()),
    )
    calendar = dims.month_dim(source.reviews(), "date")
    return facts.attach_dims(merged, dims.location_dim(source.places()), calendar).drop("location_id")


def _bridge_names(m: Mart) -> DataFrame:
    return m.business_category.join(m.category, "category_id").select("business_id", "category_name")


def _key_counts(m: Mart) -> DataFrame:
    """Rows and distinct surrogate keys of the two keyed dimensions."""

    def counts(name: str, df: DataFrame, key: str) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("row_count"), F.count_distinct(key).alias("key_count")).select(
            F.lit(name).alias("dim"), "row_count", "key_count"
        )

    return counts("location", m.location, "location_id").union(counts("category", m.category, "category_id"))


def _business_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the businesses as NDJSON, read them with the declared schema and project both dimensions."""
    path = scratch_path(spark, "business")
    testmart.Inputs(spark, sf_dir).businesses().write.json(path)
    read = files.load_business(spark, path)
    profile = dims.business_dim(read).withColumn("attributes", F.to_json("attributes"))
    return profile.join(dims.location_dim(read).drop("location_id"), "business_id")


def _checkin_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write check-in texts as NDJSON and read them as one row per date."""
    path = scratch_path(spark, "checkin")
    testmart.Inputs(spark, sf_dir).joined_dates().write.json(path)
    return files.load_checkins(spark, path)


def _tip_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write tips as CSV, with quoted commas in the text, and aggregate what is read back."""
    path = scratch_path(spark, "tip")
    tips = testmart.Inputs(spark, sf_dir).tips()
    tips.select(
        F.lit("u").alias("user_id"), "business_id", F.lit('good, "very" good').alias("text"), "date", F.lit(0)
    ).write.options(header=True, escape="\\").csv(path)
    return facts.tip_facts(files.load_tips(spark, path))


def _damaged_businesses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the businesses as NDJSON, some lines cut short, without a business or no record at all; what the job sets aside."""
    path = scratch_path(spark, "damaged")
    key, name = F.col("business_id").cast("string"), F.col("name")
    whole = F.concat(F.lit('{"business_id":"'), key, F.lit('","name":"'), name, F.lit('"}'))
    line = (
        F.when(F.col("business_id") % 10 == 3, F.concat(F.lit('{"business_id":"'), key, F.lit('","name":')))
        .when(F.col("business_id") % 10 == 7, F.concat(F.lit('{"name":"'), name, F.lit('","business_id":null}')))
        .when(F.col("business_id") % 10 == 9, F.concat(F.lit("["), key, F.lit("]")))
        .when(F.col("business_id") % 10 == 1, F.lit("  "))
        .otherwise(whole)
    )
    testmart.Inputs(spark, sf_dir).profiles().select(line).write.text(path)
    store = Store(spark, scratch_path(spark, "mart"))
    jobs.build_dimensions(files.check_business(spark, path), store)
    return store.load(jobs.BUSINESS_REJECTS)


def _tip_lines(spark: SparkSession, sf_dir: str, path: str) -> None:
    """Tips as CSV records over two lines with doubled quotes; some without a business, a readable date, or an end."""
    tips = testmart.Inputs(spark, sf_dir).tips()
    key, day = F.col("business_id").cast("string"), F.date_format("date", "yyyy-MM-dd HH:mm:ss")
    text = F.lit('"good,\nvery ""good"""')
    record = (
        F.when(F.col("business_id") % 10 == 3, F.concat(F.lit("u,,"), text, F.lit(","), day, F.lit(",0")))
        .when(F.col("business_id") % 10 == 7, F.concat(F.lit("u,"), key, F.lit(","), text, F.lit(",some day,0")))
        .when(F.col("business_id") % 10 == 9, F.concat(F.lit("u,"), key))
        .otherwise(F.concat(F.lit("u,"), key, F.lit(","), text, F.lit(","), day, F.lit(",0")))
    )
    # Every file begins with its header.
    header = spark.range(1).select(F.lit("user_id,business_id,text,date,compliment_count").alias("value"))
    for part in range(4):
        some = tips.where(F.col("business_id") % 4 == part).select(record.alias("value"))
        header.union(some).coalesce(1).write.mode("append").text(path)


def _multi_line_tips(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The tip records that are good and those that are set aside, as the fact job stages them."""
    path = scratch_path(spark, "tips")
    _tip_lines(spark, sf_dir, path)
    store = Store(spark, scratch_path(spark, "mart"))
    checked = files.check_tips(spark, path, multi_line=True, escape='"')
    good = jobs.set_aside(checked, jobs.TIP_SOURCE, jobs.TIP_REJECTS, "tips", store)
    return good, store.load(jobs.TIP_REJECTS)


def _keys_over_loads(table: Callable[[Store], DataFrame]) -> Query:
    """Keys after a first load of two thirds of the businesses and a second load of all."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        source = testmart.Inputs(spark, sf_dir)
        store = Store(spark, scratch_path(spark, "mart"))
        businesses = cut_lineage(source.businesses())
        jobs.build_dimensions(businesses.where("business_id % 3 <> 0"), store, dense_keys=True)
        jobs.build_dimensions(businesses, store, dense_keys=True)
        return table(store)

    return run


def _published_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Publish the mart, fail half-way through a second load, and read what is current."""
    versions = Versions(spark, scratch_path(spark, "versions"))
    source = testmart.Inputs(spark, sf_dir)
    with versions.load() as store:
        jobs.build_dimensions(source.businesses(), store)
        jobs.build_calendar(source.reviews(), store)
        jobs.build_fact(source.reviews(), source.tips(), source.checkins(), store)
    try:
        with versions.load() as store:
            store.save(source.businesses().limit(0), "location")
            raise InterruptedError("the load fails here")
    except InterruptedError:
        pass
    return _fact_columns(versions.current().mart())


def _built_mart(store: Store, sf_dir: str) -> Mart:
    """The mart as the jobs stage it, from the tables of a folder."""
    source = testmart.Inputs(store.spark, sf_dir)
    jobs.build_dimensions(source.businesses(), store)
    jobs.build_calendar(source.reviews(), store)
    jobs.build_fact(source.reviews(), source.tips(), source.checkins(), store)
    return store.mart()


def _staged_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fact_columns(_built_mart(Store(spark, scratch_path(spark, "mart")), sf_dir))


def _bucketed_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stage the mart bucketed on the business and cube over the bucketed tables."""
    root = scratch_path(spark, "bucketed")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return _cube(_built_mart(Store(spark, root, buckets, prefix=f"q_{root.rsplit('-', 1)[1]}_"), sf_dir))


def _refreshed(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        store = Store(spark, scratch_path(spark, "summary"))
        return summaries.refresh(name, testmart.build_mart(spark, sf_dir), store)

    return run


def _by_month(spark: SparkSession, sf_dir: str) -> Mart:
    """The mart with the fact in folders of months."""
    mart = testmart.build_mart(spark, sf_dir)
    path = scratch_path(spark, "months")
    fact = cut_lineage(mart.performance_fact)
    layouts.write_by_month(fact, path)
    return _with_fact(mart, layouts.read_by_month(spark, path, fact.schema))


def _with_fact(mart: Mart, fact: DataFrame) -> Mart:
    return Mart(mart.business, mart.location, mart.category, mart.business_category, mart.calendar, fact)


def _clustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quarters of one state over two years, from the copy clustered on location and month."""
    mart = testmart.build_mart(spark, sf_dir)
    copy = layouts.ClusteredFact(spark, scratch_path(spark, "clustered"))
    copy.write(cut_lineage(mart.performance_fact), mart.location)
    rows = copy.rows(["ASIA"], 199501, 199612)
    return olap.quarterly_growth(rows, mart.location, mart.calendar, states=["ASIA"])


def _looked_up(question: Callable[[layouts.Lookups], DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        copies = layouts.Lookups(spark, scratch_path(spark, "lookups"))
        copies.write(testmart.build_mart(spark, sf_dir))
        return question(copies)

    return run


def _late(key: str, late: bool) -> Column:
    """Every seventh event comes late, and so do all of two months."""
    return ((F.col(key) % 7 == 0) | F.col("date").cast("date").between("1995-03-01", "1995-04-30")) == F.lit(late)


@lru_cache(maxsize=2)
def _loaded_in_two(spark: SparkSession, sf_dir: str) -> tuple[increments.MonthlyFact, increments.Change, Mart, DataFrame]:
    """The fact by months after a first load without the late events, and their load after it; four queries share it."""
    source = testmart.Inputs(spark, sf_dir)
    mart = testmart.build_mart(spark, sf_dir)
    dated = {kind: cut_lineage(events) for kind, events in zip(increments.KINDS, (source.reviews(), source.tips(), source.checkins()))}
    keys = {kind: "review_id" if kind == "reviews" else "business_id" for kind in dated}
    monthly = increments.MonthlyFact(spark, scratch_path(spark, "increments"), cut_lineage(mart.location))

    def load(batch: str, late: bool) -> increments.Change:
        return monthly.add(batch, *(events.where(_late(keys[kind], late)) for kind, events in dated.items()))

    load("first", False)
    first = cut_lineage(monthly.fact())
    return monthly, load("late", True), mart, first


def _fact_in_two(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _loaded_in_two(spark, sf_dir)[0].fact().drop("location_id")


@lru_cache(maxsize=2)
def _merged_states(spark: SparkSession, sf_dir: str) -> tuple[states.SummaryStates, Mart]:
    """The states of the summaries after the first load, merged with what the late events changed."""
    _, change, mart, first = _loaded_in_two(spark, sf_dir)
    kept = states.SummaryStates(Store(spark, scratch_path(spark, "states")))
    # Kept once, as the jobs stage them: both steps read them several times.
    tables = (mart.business, mart.location, mart.business_category, mart.calendar)
    business, location, bridge, calendar = map(cut_lineage, tables)
    whole = Mart(business, location, mart.category, bridge, calendar, first)
    kept.build(whole)
    kept.merge(change.before, change.after, whole)
    return kept, whole


def _merged(summary: Callable[[states.SummaryStates, Mart], DataFrame]) -> Query:
    return lambda spark, sf_dir: summary(*_merged_states(spark, sf_dir))


def _documents_for_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "text")


def _sink_rows(name: str) -> Callable[[Mart], DataFrame]:
    """Rows as they are handed to the database, without the surrogate keys."""

    def rows(m: Mart) -> DataFrame:
        return sink.sink_values(sink.sink_shape(getattr(m, name), name)).drop("LOCATION_ID")

    return rows


_NO_TIPS = olap.ScoreRule(tips=None)
_NO_MINIMUM = olap.ScoreRule(gem_score=None)
_TWO_STATES = ["ASIA", "EUROPE"]


def _llm() -> tuple[dict[str, Query], dict[str, str]]:
    """Queries and SQL of the training-data subpackage, or nothing where it is not installed."""
    try:
        llm = importlib.import_module("quartier.llm.queries")
    except ModuleNotFoundError as error:
        if error.name not in ("quartier.llm", "quartier.llm.queries"):
            raise
        return {}, {}
    return llm.QUERIES, llm.ORACLE_SQL


def queries() -> dict[str, Query]:
    return _library_queries() | _llm()[0]


def _library_queries() -> dict[str, Query]:
    return {
        # Reports, and the variants that differ in labels, limits or filters.
        "q1_rollup_state_year": _on_mart(_rollup),
        "q1_rollup_plain": _on_mart(lambda m: _rollup(m, labels=False)),
        "q2_cube_state_category_year": _on_mart(_cube),
        "q3_rank_cities": _on_mart(_cities),
        "q3_rank_cities_top": _on_mart(lambda m: _cities(m, max_global_rank=10)),
        "q3_rank_cities_in_state": _on_mart(lambda m: _cities(m, overall=False)),
        "q4_top_gems": _on_mart(_gems),
        "q4_top_gems_rows": _on_mart(lambda m: _gems(m, min_score=3.5, rows=20)),
        "q5_quarterly_growth": _on_mart(_quarters),
        "q5_quarterly_growth_states": _on_mart(lambda m: _quarters(m, states=_TWO_STATES)),
        "q5_quarterly_lag_one_state": _on_mart(lambda m: _quarters(m, states=["ASIA"], growth=False)),
        "q6_yoy_growth": _on_mart(_yoy),
        "q6_yoy_growth_top20": _on_mart(lambda m: _yoy(m, k=20)),
        "q7_top_categories": _on_mart(_categories),
        "q7_top_categories_rows": _on_mart(lambda m: _categories(m, k=None, rows=100)),
        "q8_potential_score": _on_mart(_potential),
        "q8_potential_gems": _on_mart(lambda m: _potential(m, rule=_NO_MINIMUM, gems_only=True, limit=30)),
        "q8_potential_without_tips": _on_mart(lambda m: _potential(m, rule=_NO_TIPS, limit=100)),
        # Summary tables.
        "m1_state_years": _on_mart(summaries.state_years),
        "m2_gems_by_city": _on_mart(summaries.gems_by_city),
        "m3_category_stats": _on_mart(summaries.category_stats),
        "m1_state_years_refreshed": _refreshed("mv_perf_by_state_year"),
        # Transformations.
        "t1_checkin_dates": _on_inputs(lambda s: dims.split_dates(s.joined_dates())),
        "t2_business_dim": _on_mart(lambda m: m.business.withColumn("attributes", F.to_json("attributes"))),
        "t3_location_dim": _on_mart(lambda m: m.location.drop("location_id")),
        "t3_t4_key_counts": _on_mart(_key_counts),
        "t3_location_keys": _keys_over_loads(lambda s: s.load("location").select("business_id", "location_id")),
        "t4_category_keys": _keys_over_loads(lambda s: s.load("category")),
        "t4_category_dim": _on_mart(lambda m: m.category.select("category_name")),
        "t5_dense_business_category": _keys_over_loads(lambda s: s.load("business_category")),
        "t5_business_category": _on_mart(_bridge_names),
        "t6_calendar": _on_mart(lambda m: m.calendar),
        "t7_time_id": _on_inputs(lambda s: facts.with_time_id(s.reviews()).select("review_id", "time_id")),
        "t8_review_facts": _on_inputs(lambda s: facts.review_facts(s.reviews())),
        "t9_tip_facts": _on_inputs(lambda s: facts.tip_facts(s.tips())),
        "t10_checkin_facts": _on_inputs(lambda s: facts.checkin_facts(s.checkins())),
        "t11_merged_facts": _on_inputs(_separate_facts),
        "t14_performance_fact": _on_mart(_fact_columns),
        "t15_months_per_year": _on_mart(lambda m: dims.months_per_year(m.calendar)),
        # Sources, staging, layout and sink shapes.
        "s1_business_ndjson": _business_file,
        "s2_tips_csv": _tip_file,
        "s1_business_rejects": _damaged_businesses,
        "s2_tips_csv_multiline": lambda spark, sf_dir: facts.tip_facts(_multi_line_tips(spark, sf_dir)[0]),
        "s2_tips_rejects": lambda spark, sf_dir: _multi_line_tips(spark, sf_dir)[1],
        "s7_checkins_ndjson": _checkin_file,
        "k1_published_fact": _published_fact,
        "k1_staged_fact": _staged_fact,
        "l1_bucketed_cube": _bucketed_cube,
        "k3_sink_fact": _on_mart(_sink_rows("performance_fact")),
        "k3_sink_calendar": _on_mart(_sink_rows("calendar")),
        "k5_sink_business": _on_mart(_sink_rows("business")),
        "k3_sink_text_limit": lambda spark, sf_dir: sink.sink_values(_documents_for_sink(spark, sf_dir)),
        "k3_sink_texts_aside": lambda spark, sf_dir: sink.split_long_texts(_documents_for_sink(spark, sf_dir))[1].select(
            "doc_id", "too_long", F.octet_length("text").alias("bytes")
        ),
        # Copies for other questions, late events, summaries that merge.
        "l1_year_by_month": lambda spark, sf_dir: _quarters(_by_month(spark, sf_dir), years=[1995]),
        "l1_clustered_quarters": _clustered,
        "l1_lookup_city": _looked_up(lambda copies: copies.places("ASIA", "NATION_2").drop("location_id")),
        "l1_lookup_open_stars": _looked_up(lambda copies: copies.businesses(3.5).drop("attributes")),
        "l1_lookup_category": _looked_up(lambda copies: copies.of_category("STANDARD").select("business_id")),
        "t14_fact_by_changed_months": _fact_in_two,
        "m1_merged_after_change": _merged(lambda kept, mart: kept.state_years()),
        "m2_merged_after_change": _merged(lambda kept, mart: kept.gems_by_city()),
        "m3_merged_after_change": _merged(lambda kept, mart: kept.category_stats(mart.category)),
    }


# --- SQL ---------------------------------------------------------------------------------------------------------

_MART = """
WITH review AS (
    SELECT o_orderkey AS review_id, o_custkey AS business_id, CAST(o_orderdate AS DATE) AS day,
           CAST(6 - CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS DOUBLE) AS stars
    FROM orders
), tip AS (
    SELECT o_custkey AS business_id, CAST(o_orderdate AS DATE) AS day FROM orders WHERE o_orderstatus = 'F'
), line AS (
    SELECT o_custkey AS business_id, l_partkey, o_orderdate, l_shipdate
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
), checkin AS (
    SELECT business_id, CAST(l_shipdate AS DATE) AS day FROM line
), location AS (
    SELECT c_custkey AS business_id, c_mktsegment AS address, n_name AS city,
           lpad(CAST(n_nationkey AS VARCHAR), 5, '0') AS postal_code, r_name AS state,
           CAST(n_nationkey AS DOUBLE) AS latitude, CAST(r_regionkey AS DOUBLE) AS longitude
    FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
), calendar AS (
    SELECT DISTINCT CAST(year(day) * 100 + month(day) AS INTEGER) AS time_id, CAST(year(day) AS INTEGER) AS year,
           CAST(month(day) AS INTEGER) AS month, CAST(quarter(day) AS INTEGER) AS quarter
    FROM review
), review_fact AS (
    SELECT business_id, CAST(year(day) * 100 + month(day) AS INTEGER) AS time_id,
           count(review_id) AS review_count, avg(stars) AS score_mean
    FROM review GROUP BY ALL
), tip_fact AS (
    SELECT business_id, CAST(year(day) * 100 + month(day) AS INTEGER) AS time_id, count(*) AS tip_count
    FROM tip GROUP BY ALL
), checkin_fact AS (
    SELECT business_id, CAST(year(day) * 100 + month(day) AS INTEGER) AS time_id, count(*) AS checkin_count
    FROM checkin GROUP BY ALL
), merged AS (
    SELECT * FROM review_fact
    FULL JOIN tip_fact USING (business_id, time_id)
    FULL JOIN checkin_fact USING (business_id, time_id)
), fact AS (
    SELECT business_id, time_id, coalesce(review_count, 0) AS review_count, coalesce(tip_count, 0) AS tip_count,
           coalesce(checkin_count, 0) AS checkin_count, score_mean
    FROM merged JOIN location USING (business_id) JOIN calendar USING (time_id)
), business AS (
    SELECT c_custkey AS business_id, c_name AS name, stars,
           CAST(CASE WHEN c_acctbal >= 0 THEN 1 ELSE 0 END AS BIGINT) AS is_open,
           '{"Segment":"' || c_mktsegment || '"}' AS attributes
    FROM customer LEFT JOIN (SELECT business_id, avg(stars) AS stars FROM review GROUP BY ALL) AS rated
         ON c_custkey = business_id
), tagged AS (
    SELECT business_id, string_agg(DISTINCT p_type, ', ') AS categories
    FROM line JOIN part ON l_partkey = p_partkey GROUP BY ALL
), bridge AS (
    SELECT business_id, unnest(string_split(categories, ', ')) AS category_name FROM tagged
)
"""


def _rounded(value: str, digits: int) -> str:
    """Half-up rounding on decimal digits, as a double."""
    return f"CAST(round(CAST({value} AS DECIMAL(38,10)), {digits}) AS DOUBLE)"


_MEAN = "CAST(avg(score_mean) AS DECIMAL(38,10))"
_NOTE = _rounded("avg(score_mean)", 2) + " AS note_moyenne"


def _sum(column: str, alias: str) -> str:
    return f"CAST(sum({column}) AS BIGINT) AS {alias}"


_SCORED = "FROM fact JOIN location USING (business_id) JOIN calendar USING (time_id) WHERE score_mean IS NOT NULL"

_Q1 = f"""{_MART} SELECT
    CASE WHEN grouping(state) = 1 THEN 'TOTAL_GLOBAL' ELSE state END AS etat,
    CASE WHEN grouping(year) = 1 THEN 'TOTAL_ANNEE' ELSE CAST(year AS VARCHAR) END AS annee,
    count(DISTINCT business_id) AS nb_commerces, {_sum("review_count", "total_avis")},
    {_sum("checkin_count", "total_checkins")}, {_NOTE}
{_SCORED} GROUP BY ROLLUP (state, year)"""

_Q1_PLAIN = f"""{_MART} SELECT state, year, count(DISTINCT business_id) AS nb_commerces,
    {_sum("review_count", "total_avis")}, {_NOTE}
{_SCORED} GROUP BY ROLLUP (state, year)"""

_Q2 = f"""{_MART} SELECT
    CASE WHEN grouping(state) = 1 THEN 'TOUS_ETATS' ELSE state END AS etat,
    CASE WHEN grouping(category_name) = 1 THEN 'TOUTES_CATEGORIES' ELSE category_name END AS categorie,
    CASE WHEN grouping(year) = 1 THEN 'TOUTES_ANNEES' ELSE CAST(year AS VARCHAR) END AS annee,
    count(DISTINCT business_id) AS nb_commerces, {_sum("review_count", "total_avis")}, {_NOTE}
FROM fact JOIN location USING (business_id) JOIN calendar USING (time_id) JOIN bridge USING (business_id)
WHERE score_mean IS NOT NULL GROUP BY CUBE (state, category_name, year)"""

_CITIES = f"""cities AS (
    SELECT city, state, count(DISTINCT business_id) AS nb_commerces, {_sum("review_count", "total_avis")},
           {_NOTE}, {_MEAN} AS mean
    FROM fact JOIN location USING (business_id) WHERE score_mean IS NOT NULL GROUP BY city, state
), ranked AS (
    SELECT city, state, nb_commerces, total_avis, note_moyenne,
           CAST(rank() OVER (PARTITION BY state ORDER BY mean DESC) AS INTEGER) AS rang_dans_etat,
           CAST(dense_rank() OVER (ORDER BY mean DESC) AS INTEGER) AS rang_global
    FROM cities
)"""


def _gems_sql(min_score: float, tail: str) -> str:
    return f"""{_MART}, gems AS (
    SELECT business_id, city, state, {_sum("review_count", "total_avis")}, {_sum("checkin_count", "total_checkins")},
           {_sum("tip_count", "total_tips")}, {_NOTE}, {_MEAN} AS mean
    FROM fact JOIN location USING (business_id) WHERE score_mean IS NOT NULL
    GROUP BY business_id, city, state
    HAVING {_MEAN} >= {min_score} AND sum(review_count) < 150
), ranked AS (
    SELECT business_id, city, state, total_avis, total_checkins, total_tips, note_moyenne,
           CAST(rank() OVER (ORDER BY mean DESC, total_avis) AS INTEGER) AS rang
    FROM gems
) SELECT * FROM ranked {tail}"""


def _growth(current: str, previous: str, alias: str) -> str:
    change = f"CAST({current} - {previous} AS DOUBLE) / nullif(CAST({previous} AS DOUBLE), 0) * 100"
    return _rounded(change, 2) + f" AS {alias}"


def _quarters_sql(condition: str, growth: bool = True) -> str:
    extra = ", " + _growth("avis_trimestre", "avis_trimestre_precedent", "croissance_pct") if growth else ""
    return f"""{_MART}, quarters AS (
    SELECT state, year, quarter, {_sum("review_count", "avis_trimestre")}
    FROM fact JOIN location USING (business_id) JOIN calendar USING (time_id)
    WHERE {condition} GROUP BY state, year, quarter
), lagged AS (
    SELECT *, lag(avis_trimestre) OVER (PARTITION BY state ORDER BY year, quarter) AS avis_trimestre_precedent
    FROM quarters
) SELECT *{extra} FROM lagged"""


def _yoy_sql(k: int) -> str:
    return f"""{_MART}, years AS (
    SELECT business_id, city, state, year AS annee, {_sum("review_count", "avis_annee")}
    FROM fact JOIN location USING (business_id) JOIN calendar USING (time_id)
    GROUP BY business_id, city, state, year
), lagged AS (
    SELECT *, lag(avis_annee) OVER (PARTITION BY business_id ORDER BY annee) AS avis_annee_precedente FROM years
) SELECT *, {_growth("avis_annee", "avis_annee_precedente", "croissance_yoy_pct")}
FROM lagged WHERE avis_annee_precedente > 0
ORDER BY croissance_yoy_pct DESC, business_id, annee LIMIT {k}"""


def _categories_sql(tail: str) -> str:
    return f"""{_MART}, totals AS (
    SELECT state, category_name, count(DISTINCT business_id) AS nb_commerces, {_sum("review_count", "total_avis")},
           {_NOTE}, {_MEAN} AS mean
    FROM fact JOIN location USING (business_id) JOIN bridge USING (business_id)
    WHERE score_mean IS NOT NULL GROUP BY state, category_name
), ranked AS (
    SELECT state, category_name, nb_commerces, total_avis, note_moyenne,
           CAST(rank() OVER (PARTITION BY state ORDER BY mean DESC) AS INTEGER) AS rang_dans_etat
    FROM totals
) SELECT * FROM ranked {tail}"""


def _potential_sql(tips: bool, minimum: bool, tail: str) -> str:
    score = """note_moyenne / 5.0::DOUBLE * 35.0::DOUBLE
        + (1.0::DOUBLE - least(1.0::DOUBLE, total_avis::DOUBLE / 150.0::DOUBLE)) * 30.0::DOUBLE
        + least(1.0::DOUBLE, total_checkins::DOUBLE / 100.0::DOUBLE) * 20.0::DOUBLE"""
    if tips:
        score += " + least(1.0::DOUBLE, total_tips::DOUBLE / 20.0::DOUBLE) * 15.0::DOUBLE"
    gem = "note_moyenne >= 4.2 AND total_avis < 150" + (" AND score_potentiel >= 60" if minimum else "")
    tip_total = _sum("tip_count", "total_tips") + "," if tips else ""
    return f"""{_MART}, totals AS (
    SELECT business_id, {_sum("review_count", "total_avis")}, {_sum("checkin_count", "total_checkins")},
           {tip_total} {_NOTE}
    FROM fact WHERE score_mean IS NOT NULL GROUP BY business_id
), scored AS (
    SELECT totals.*, city, state, {_rounded(score, 1)} AS score_potentiel
    FROM totals JOIN location USING (business_id)
), flagged AS (
    SELECT *, CASE WHEN {gem} THEN 'OUI' ELSE 'NON' END AS est_pepite FROM scored
) SELECT * FROM flagged {tail}"""


_M1 = f"""{_MART} SELECT state, year, count(DISTINCT business_id) AS nb_commerces,
    {_sum("review_count", "total_reviews")}, {_sum("checkin_count", "total_checkins")}, {_NOTE}
FROM fact JOIN location USING (business_id) JOIN calendar USING (time_id) GROUP BY state, year"""

_STARS = _rounded("avg(stars)", 2) + " AS note_moyenne"

_M2 = f"""{_MART} SELECT state, city, count(DISTINCT business_id) AS nb_pepites, {_STARS}
FROM business JOIN location USING (business_id) JOIN fact USING (business_id)
WHERE stars >= 4.2 AND is_open = 1 GROUP BY state, city
HAVING sum(review_count) < 150 * count(DISTINCT business_id)"""

_M3 = f"""{_MART} SELECT category_name, count(DISTINCT business_id) AS nb_commerces, {_STARS},
    {_sum("review_count", "total_reviews")}
FROM bridge JOIN business USING (business_id) JOIN fact USING (business_id) GROUP BY category_name"""

_FACT = f"{_MART} SELECT * FROM fact"

_DATES = f"""{_MART}, stacked AS (
    SELECT business_id, o_orderdate AS day FROM line UNION ALL SELECT business_id, l_shipdate FROM line
)"""

_KEYED = f"""{_MART}, category AS (
    SELECT category_name, row_number() OVER (ORDER BY min(business_id % 3 = 0), category_name) AS category_id
    FROM bridge GROUP BY category_name
)"""

_QUOTED = "'\"good,' || chr(10) || 'very \"\"good\"\"\"'"

_DAY_TEXT = "strftime(day, '%Y-%m-%d %H:%M:%S') AS date"


def oracle_sql() -> dict[str, str]:
    return _library_sql() | _llm()[1]


def _library_sql() -> dict[str, str]:
    return {
        "q1_rollup_state_year": _Q1,
        "q1_rollup_plain": _Q1_PLAIN,
        "q2_cube_state_category_year": _Q2,
        "q3_rank_cities": f"{_MART}, {_CITIES} SELECT * FROM ranked",
        "q3_rank_cities_top": f"{_MART}, {_CITIES} SELECT * FROM ranked WHERE rang_global <= 10",
        "q3_rank_cities_in_state": f"{_MART}, {_CITIES} SELECT * EXCLUDE (rang_global) FROM ranked",
        "q4_top_gems": _gems_sql(4.2, "WHERE rang <= 20"),
        "q4_top_gems_rows": _gems_sql(3.5, "ORDER BY rang, business_id LIMIT 20"),
        "q5_quarterly_growth": _quarters_sql("true"),
        "q5_quarterly_growth_states": _quarters_sql("state IN ('ASIA', 'EUROPE')"),
        "q5_quarterly_lag_one_state": _quarters_sql("state = 'ASIA'", growth=False),
        "q6_yoy_growth": _yoy_sql(50),
        "q6_yoy_growth_top20": _yoy_sql(20),
        "q7_top_categories": _categories_sql("WHERE rang_dans_etat <= 5"),
        "q7_top_categories_rows": _categories_sql("ORDER BY state, rang_dans_etat, category_name LIMIT 100"),
        "q8_potential_score": _potential_sql(True, True, ""),
        "q8_potential_gems": _potential_sql(
            True, False, "WHERE est_pepite = 'OUI' ORDER BY score_potentiel DESC, business_id LIMIT 30"
        ),
        "q8_potential_without_tips": _potential_sql(
            False, True, "ORDER BY score_potentiel DESC, business_id LIMIT 100"
        ),
        "m1_state_years": _M1,
        "m2_gems_by_city": _M2,
        "m3_category_stats": _M3,
        "m1_state_years_refreshed": _M1,
        "t1_checkin_dates": f"{_DATES} SELECT business_id, {_DAY_TEXT} FROM stacked",
        "t2_business_dim": f"{_MART} SELECT * FROM business",
        "t3_location_dim": f"{_MART} SELECT * FROM location",
        "t3_t4_key_counts": f"""{_MART}
            SELECT 'location' AS dim, count(*) AS row_count, count(DISTINCT business_id) AS key_count FROM location
            UNION ALL
            SELECT 'category', count(DISTINCT category_name), count(DISTINCT category_name) FROM bridge""",
        "t3_location_keys": f"""{_MART} SELECT business_id, row_number() OVER (
            ORDER BY CASE WHEN business_id % 3 = 0 THEN 1 ELSE 0 END, business_id) AS location_id FROM location""",
        "t4_category_keys": f"{_KEYED} SELECT * FROM category",
        "t5_dense_business_category": f"{_KEYED} SELECT business_id, category_id FROM bridge JOIN category USING (category_name)",
        "t4_category_dim": f"{_MART} SELECT DISTINCT category_name FROM bridge",
        "t5_business_category": f"{_MART} SELECT * FROM bridge",
        "t6_calendar": f"{_MART} SELECT * FROM calendar",
        "t7_time_id": f"""{_MART} SELECT review_id, CAST(strftime(day, '%Y%m') AS INTEGER) AS time_id FROM review""",
        "t8_review_facts": f"{_MART} SELECT * FROM review_fact",
        "t9_tip_facts": f"{_MART} SELECT * FROM tip_fact",
        "t10_checkin_facts": f"{_MART} SELECT * FROM checkin_fact",
        "t11_merged_facts": _FACT,
        "t14_performance_fact": _FACT,
        "t15_months_per_year": f"{_MART} SELECT year, count(*) AS count FROM calendar GROUP BY year",
        "s1_business_ndjson": f"""{_MART} SELECT CAST(business_id AS VARCHAR) AS business_id, business.* EXCLUDE
            (business_id), location.* EXCLUDE (business_id) FROM business JOIN location USING (business_id)""",
        "s2_tips_csv": f"""{_MART} SELECT * REPLACE (CAST(business_id AS VARCHAR) AS business_id) FROM tip_fact""",
        "s1_business_rejects": """SELECT 'business' AS source,
            CASE WHEN c_custkey % 10 = 7 THEN 'no business_id' ELSE 'not JSON' END AS reason,
            CASE WHEN c_custkey % 10 = 3 THEN '{"business_id":"' || c_custkey || '","name":'
                 WHEN c_custkey % 10 = 7 THEN '{"name":"' || c_name || '","business_id":null}'
                 ELSE '[' || c_custkey || ']' END AS text
            FROM customer WHERE c_custkey % 10 IN (3, 7, 9)""",
        "s2_tips_csv_multiline": f"""{_MART} SELECT * REPLACE (CAST(business_id AS VARCHAR) AS business_id) FROM tip_fact
            WHERE business_id % 10 NOT IN (3, 7, 9)""",
        "s2_tips_rejects": f"""{_MART} SELECT 'tips' AS source,
            CASE WHEN business_id % 10 = 3 THEN 'no business_id' ELSE 'no date' END AS reason,
            CASE WHEN business_id % 10 = 3 THEN 'u,,' || {_QUOTED} || ',' || strftime(day, '%Y-%m-%d %H:%M:%S') || ',0'
                 WHEN business_id % 10 = 7 THEN 'u,' || business_id || ',' || {_QUOTED} || ',some day,0'
                 ELSE 'u,' || business_id END AS text
            FROM tip WHERE business_id % 10 IN (3, 7, 9)""",
        "k1_published_fact": _FACT,
        "s7_checkins_ndjson": f"{_DATES} SELECT CAST(business_id AS VARCHAR) AS business_id, {_DAY_TEXT} FROM stacked",
        "k1_staged_fact": _FACT,
        "l1_bucketed_cube": _Q2,
        "k3_sink_fact": f"""{_MART} SELECT CAST(business_id AS DECIMAL(19,0)) AS "BUSINESS_ID",
            CAST(time_id AS DECIMAL(10,0)) AS "TIME_ID", CAST(review_count AS DECIMAL(19,0)) AS "REVIEW_COUNT",
            CAST(tip_count AS DECIMAL(19,0)) AS "TIP_COUNT", CAST(checkin_count AS DECIMAL(19,0)) AS "CHECKIN_COUNT",
            CAST(score_mean AS DECIMAL(19,4)) AS "SCORE_MEAN" FROM fact""",
        "k3_sink_calendar": f"""{_MART} SELECT CAST(time_id AS DECIMAL(10,0)) AS "ID_TEMPS",
            CAST(year AS DECIMAL(10,0)) AS "YEAR", CAST(month AS DECIMAL(10,0)) AS "MONTH",
            CAST(quarter AS DECIMAL(10,0)) AS "QUARTER" FROM calendar""",
        "k5_sink_business": f"""{_MART} SELECT CAST(business_id AS DECIMAL(19,0)) AS "BUSINESS_ID", name AS "NAME",
            CAST(stars AS DECIMAL(19,4)) AS "STARS", CAST(is_open AS DECIMAL(19,0)) AS "IS_OPEN",
            attributes AS "ATTRIBUTES" FROM business""",
        "k3_sink_text_limit": """SELECT CAST(doc_id AS DECIMAL(19,0)) AS doc_id, nullif(source, '') AS source,
            CASE WHEN strlen(text) <= 4000 THEN nullif(text, '') ELSE left(text, list_max(
                list_filter(range(1000, 4001), lambda n: strlen(left(text, n)) <= 4000))) END AS text FROM documents""",
        "k3_sink_texts_aside": """SELECT doc_id, 'text' AS too_long, CAST(strlen(text) AS INTEGER) AS bytes
            FROM documents WHERE strlen(text) > 4000""",
        "l1_year_by_month": _quarters_sql("year = 1995"),
        "l1_clustered_quarters": _quarters_sql("state = 'ASIA' AND year IN (1995, 1996)"),
        "l1_lookup_city": f"{_MART} SELECT * FROM location WHERE state = 'ASIA' AND city = 'NATION_2'",
        "l1_lookup_open_stars": f"{_MART} SELECT * EXCLUDE (attributes) FROM business WHERE is_open = 1 AND stars >= 3.5",
        "l1_lookup_category": f"{_MART} SELECT business_id FROM bridge WHERE category_name = 'STANDARD'",
        "t14_fact_by_changed_months": _FACT,
        "m1_merged_after_change": _M1,
        "m2_merged_after_change": _M2,
        "m3_merged_after_change": _M3,
    }
