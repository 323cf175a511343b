"""The eight reports over the star schema.

Plan shape. ``location`` has one row per business and every large table carries ``business_id``, so the reports join
and pre-aggregate on that one key and only then group by state, city, category or period. With tables bucketed on
``business_id`` the large steps need no shuffle at all; the groups that are shuffled afterwards are already combined,
so a hot state, city or category costs nothing extra. Distinct businesses are counted on rows that are unique per
business by then, without a distinct aggregate. Only the calendar is broadcast by hint (at most 12 rows for each of
9,999 years); every other join is left to Catalyst's size threshold and adaptive execution.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quartier.functions import growth_pct, half_up, rank_value
from quartier.operators.grains import (
    SCORE_PARTS,
    business_years,
    businesses,
    category_weights,
    mark_first,
    mean_score,
    parts,
    row_count,
    scored,
    sums,
    with_months,
)
from quartier.operators.ranking import match, ranks_desc, top_ranks
from quartier.plans.mart import Mart
from quartier.session import cut_lineage

# Labels of subtotal rows and flags (fixed values).
ROLLUP_LABELS = {"state": "TOTAL_GLOBAL", "year": "TOTAL_ANNEE"}
CUBE_LABELS = {"state": "TOUS_ETATS", "category_name": "TOUTES_CATEGORIES", "year": "TOUTES_ANNEES"}
YES, NO = "OUI", "NON"


def _label(level: str, total: Column, labels: dict[str, str]) -> Column:
    """The level's value as text, or its label on a row that totals over it; a NULL value stays NULL."""
    return F.when(total, F.lit(labels[level])).otherwise(F.col(level).cast("string"))


def rollup_state_year(
    fact: DataFrame, location: DataFrame, calendar: DataFrame, labels: bool = True
) -> DataFrame:
    """Q1: businesses, reviews, check-ins and mean score by state and year, with subtotals; scored months only.

    Without ``labels``, subtotal rows keep NULL keys, and check-ins and sorting are left out. Subtotals are expanded
    from the cells of state and year, not from the businesses.
    """
    aggregates = parts("review_count", "checkin_count")
    years = business_years(scored(fact), location, calendar, aggregates, ["state"])
    cells = (
        mark_first(years, "year", "first_year")
        .groupBy("state", "year")
        .agg(row_count().alias("businesses"), *sums("first_year", "review_count", "checkin_count", *SCORE_PARTS))
    )
    totals = cells.rollup("state", "year").agg(
        F.grouping("state").alias("all_states"),
        F.grouping("year").alias("all_years"),
        F.when(F.grouping("year") == 1, F.sum("first_year")).otherwise(F.sum("businesses")).alias("nb_commerces"),
        F.sum("review_count").alias("total_avis"),
        F.sum("checkin_count").alias("total_checkins"),
        half_up(mean_score(), 2).alias("note_moyenne"),
    )
    if not labels:
        return totals.select("state", "year", "nb_commerces", "total_avis", "note_moyenne")
    return totals.orderBy(
        F.asc_nulls_last("state"), "all_states", F.asc_nulls_last("year"), "all_years"
    ).select(
        _label("state", F.col("all_states") == 1, ROLLUP_LABELS).alias("etat"),
        _label("year", F.col("all_years") == 1, ROLLUP_LABELS).alias("annee"),
        "nb_commerces",
        "total_avis",
        "total_checkins",
        "note_moyenne",
    )


def cube_state_category_year(
    fact: DataFrame, location: DataFrame, calendar: DataFrame, bridge: DataFrame, category: DataFrame
) -> DataFrame:
    """Q2: businesses, reviews and mean score for every combination of state, category and year; scored months only.

    A total over categories counts a business once, but adds its reviews and scores once per category, as the join
    through the bridge does. As in Q1, everything is summed per cell before the cells are expanded into subtotals.
    """
    years = business_years(scored(fact), location, calendar, parts("review_count"), ["state"])
    # The bridge holds known categories only, as staging makes it, so names can wait until there are only cells.
    rows = mark_first(years, "year", "first_year").join(
        mark_first(category_weights(bridge), "category_id", "first_category"), "business_id"
    )
    weight = F.col("weight")
    cells = rows.groupBy("state", "category_id", "year").agg(
        row_count().alias("businesses"),
        *sums("first_year", "first_category"),
        F.sum(F.col("first_category") * F.col("first_year")).alias("first_both"),
        *[F.sum(F.col(name) * weight).alias(name) for name in ("review_count", *SCORE_PARTS)],
    ).join(category, "category_id")
    all_categories, all_years = F.grouping("category_name") == 1, F.grouping("year") == 1
    counted = (
        F.when(all_categories & all_years, F.sum("first_both"))
        .when(all_categories, F.sum("first_category"))
        .when(all_years, F.sum("first_year"))
        .otherwise(F.sum("businesses"))
    )
    totals = cells.cube("state", "category_name", "year").agg(
        F.grouping("state").alias("all_states"),
        F.grouping("category_name").alias("all_categories"),
        F.grouping("year").alias("all_years"),
        counted.alias("nb_commerces"),
        F.sum("review_count").alias("total_avis"),
        half_up(mean_score(), 2).alias("note_moyenne"),
    )
    return totals.orderBy(
        F.asc_nulls_last("state"),
        "all_states",
        F.asc_nulls_last("category_name"),
        "all_categories",
        F.asc_nulls_last("year"),
        "all_years",
    ).select(
        _label("state", F.col("all_states") == 1, CUBE_LABELS).alias("etat"),
        _label("category_name", F.col("all_categories") == 1, CUBE_LABELS).alias("categorie"),
        _label("year", F.col("all_years") == 1, CUBE_LABELS).alias("annee"),
        "nb_commerces",
        "total_avis",
        "note_moyenne",
    )


def rank_cities(
    fact: DataFrame, location: DataFrame, max_global_rank: int | None = None, overall: bool = True
) -> DataFrame:
    """Q3: cities by mean score, with their rank in the state and their dense rank overall.

    The city totals are computed once and kept, since both ranks read them again.
    """
    cities = (
        businesses(fact, "review_count")
        .join(location.select("business_id", "city", "state"), "business_id")
        .groupBy("city", "state")
        .agg(
            row_count().alias("nb_commerces"),
            F.sum("review_count").alias("total_avis"),
            rank_value(mean_score()).alias("mean"),
        )
    )
    cities = cut_lineage(cities)
    ranked = match(cities, ranks_desc(cities, "mean", "rang_dans_etat", by=["state"]), ["state", "mean"])
    columns = ["city", "state", "nb_commerces", "total_avis", half_up(F.col("mean"), 2).alias("note_moyenne")]
    if not overall:
        return ranked.select(*columns, "rang_dans_etat")
    ranked = match(ranked, ranks_desc(cities, "mean", "rang_global", dense=True), ["mean"])
    if max_global_rank is not None:
        ranked = ranked.filter(F.col("rang_global") <= max_global_rank)
    return ranked.orderBy("rang_global", "state", "city").select(*columns, "rang_dans_etat", "rang_global")


def top_gems(
    fact: DataFrame,
    location: DataFrame,
    min_score: float = 4.2,
    max_reviews: int = 150,
    k: int = 20,
    rows: int | None = None,
) -> DataFrame:
    """Q4: businesses with a mean of at least ``min_score`` and fewer than ``max_reviews`` reviews, ranks 1 to ``k``.

    Ties at rank k are all kept; ``rows`` cuts to that many rows instead, in rank and business order. The gems are
    computed once and kept: ranking reads them twice, and both readings must see the very same means.
    """
    gems = (
        scored(fact)
        .groupBy("business_id")
        .agg(
            F.sum("review_count").alias("total_avis"),
            F.sum("checkin_count").alias("total_checkins"),
            F.sum("tip_count").alias("total_tips"),
            rank_value(F.avg("score_mean")).alias("mean"),
        )
        .filter((F.col("mean") >= min_score) & (F.col("total_avis") < max_reviews))
        .join(location.select("business_id", "city", "state"), "business_id")
    )
    ranked = top_ranks(cut_lineage(gems), "mean", "total_avis", rows or k, "rang").orderBy("rang", "business_id")
    if rows is not None:
        ranked = ranked.limit(rows)
    return ranked.select(
        "business_id",
        "city",
        "state",
        "total_avis",
        "total_checkins",
        "total_tips",
        half_up(F.col("mean"), 2).alias("note_moyenne"),
        "rang",
    )


def quarterly_growth(
    fact: DataFrame,
    location: DataFrame,
    calendar: DataFrame,
    states: list[str] | None = None,
    growth: bool = True,
    years: list[int] | None = None,
) -> DataFrame:
    """Q5: reviews by state and quarter beside the state's previous quarter that has rows, and the growth in percent.

    The window runs over the totals: the quarters of one state. With ``years`` only these are looked at; over a fact in
    folders of months (``layouts``) the others are not read.
    """
    if years is not None:
        calendar = calendar.filter(F.col("year").isin(years))
    places = location.select("business_id", "state")
    if states is not None:
        places = places.filter(F.col("state").isin(states))
    quarters = (
        with_months(fact, calendar, "year", "quarter")
        .join(places, "business_id")
        .groupBy("state", "year", "quarter")
        .agg(F.sum("review_count").alias("avis_trimestre"))
    )
    current, previous = F.col("avis_trimestre"), F.col("avis_trimestre_precedent")
    by_state = W.partitionBy("state").orderBy("year", "quarter")
    report = quarters.withColumn("avis_trimestre_precedent", F.lag(current).over(by_state))
    if growth:
        report = report.withColumn("croissance_pct", growth_pct(current, previous))
    return report.orderBy("state", "year", "quarter")


def yoy_growth(fact: DataFrame, location: DataFrame, calendar: DataFrame, k: int = 50) -> DataFrame:
    """Q6: the ``k`` strongest growths in reviews from one year of a business to its next.

    Equal growths are cut in business and year order. The window holds the years of one business.
    """
    total = F.sum("review_count").alias("avis_annee")
    years = business_years(fact, location, calendar, [total], ["city", "state"])
    current, previous = F.col("avis_annee"), F.col("avis_annee_precedente")
    by_business = W.partitionBy("business_id").orderBy("year")
    return (
        years.withColumn("avis_annee_precedente", F.lag(current).over(by_business))
        .filter(previous > 0)
        .select(
            "business_id",
            "city",
            "state",
            F.col("year").alias("annee"),
            "avis_annee",
            "avis_annee_precedente",
            growth_pct(current, previous).alias("croissance_yoy_pct"),
        )
        .orderBy(F.desc("croissance_yoy_pct"), "business_id", "annee")
        .limit(k)
    )


def top_categories(
    fact: DataFrame,
    location: DataFrame,
    bridge: DataFrame,
    category: DataFrame,
    k: int | None = 5,
    rows: int | None = None,
) -> DataFrame:
    """Q7: categories of each state by mean score, ranks 1 to ``k`` with ties; ``rows`` cuts the listing.

    Category names are joined to the totals, so that the bridge needs no shuffle on the category. The window runs over
    the totals too: the categories of one state.
    """
    weight = F.col("weight")
    totals = (
        businesses(fact, "review_count")
        .join(location.select("business_id", "state"), "business_id")
        .join(category_weights(bridge), "business_id")
        .groupBy("state", "category_id")
        .agg(
            row_count().alias("nb_commerces"),
            F.sum(F.col("review_count") * weight).alias("total_avis"),
            rank_value(mean_score(weight)).alias("mean"),
        )
        .join(category, "category_id")
    )
    rank = F.rank().over(W.partitionBy("state").orderBy(F.desc("mean")))
    ranked = totals.withColumn("rang_dans_etat", rank)
    # The first ``rows`` rows of the listing have ranks up to ``rows``.
    bounds = [n for n in (k, rows) if n is not None]
    if bounds:
        ranked = ranked.filter(F.col("rang_dans_etat") <= min(bounds))
    ranked = ranked.orderBy("state", "rang_dans_etat", "category_name")
    if rows is not None:
        ranked = ranked.limit(rows)
    return ranked.select(
        "state",
        "category_name",
        "nb_commerces",
        "total_avis",
        half_up(F.col("mean"), 2).alias("note_moyenne"),
        "rang_dans_etat",
    )


@dataclass(frozen=True)
class ScoreRule:
    """Weights, caps and gem thresholds of the potential score (fixed values as defaults)."""

    rating: float = 35
    exposure: float = 30
    checkins: float = 20
    tips: float | None = 15
    review_cap: float = 150
    checkin_cap: float = 100
    tip_cap: float = 20
    gem_rating: float = 4.2
    gem_reviews: int = 150
    gem_score: float | None = 60


def potential_score(
    fact: DataFrame,
    location: DataFrame,
    rule: ScoreRule = ScoreRule(),
    gems_only: bool = False,
    limit: int | None = None,
) -> DataFrame:
    """Q8: a weighted score of rating, under-exposure, check-ins and tips per business, and whether it is a gem.

    A rule without ``tips`` leaves that term and its column out; one without ``gem_score`` flags on rating and reviews
    alone.
    """
    totals = ["total_avis", "total_checkins", "total_tips"]
    if rule.tips is None:
        totals.remove("total_tips")
    source = {"total_avis": "review_count", "total_checkins": "checkin_count", "total_tips": "tip_count"}
    totals_by_business = (
        scored(fact)
        .groupBy("business_id")
        .agg(
            *[F.sum(source[name]).alias(name) for name in totals],
            half_up(F.avg("score_mean"), 2).alias("note_moyenne"),
        )
        .join(location.select("business_id", "city", "state"), "business_id")
    )

    def share(name: str, cap: float) -> Column:
        return F.least(F.lit(1.0), F.col(name).cast("double") / F.lit(float(cap)))

    score = (
        F.col("note_moyenne") / F.lit(5.0) * F.lit(float(rule.rating))
        + (F.lit(1.0) - share("total_avis", rule.review_cap)) * F.lit(float(rule.exposure))
        + share("total_checkins", rule.checkin_cap) * F.lit(float(rule.checkins))
    )
    if rule.tips is not None:
        score = score + share("total_tips", rule.tip_cap) * F.lit(float(rule.tips))
    gem = (F.col("note_moyenne") >= rule.gem_rating) & (F.col("total_avis") < rule.gem_reviews)
    if rule.gem_score is not None:
        gem = gem & (F.col("score_potentiel") >= rule.gem_score)
    report = totals_by_business.select(
        "business_id", "city", "state", *totals, "note_moyenne", half_up(score, 1).alias("score_potentiel")
    ).withColumn("est_pepite", F.when(gem, YES).otherwise(NO))
    if gems_only:
        report = report.filter(F.col("est_pepite") == YES)
    order = [F.desc("score_potentiel"), F.asc("business_id")]
    if limit is not None:
        return report.orderBy(*order).limit(limit)
    # A global sort first samples its input, which here would run the whole scan and grouping a second time.
    return cut_lineage(report).orderBy(*order)


# The reports with their default parameters.
REPORTS: dict[str, Callable[[Mart], DataFrame]] = {
    "q1": lambda m: rollup_state_year(m.performance_fact, m.location, m.calendar),
    "q2": lambda m: cube_state_category_year(
        m.performance_fact, m.location, m.calendar, m.business_category, m.category
    ),
    "q3": lambda m: rank_cities(m.performance_fact, m.location),
    "q4": lambda m: top_gems(m.performance_fact, m.location),
    "q5": lambda m: quarterly_growth(m.performance_fact, m.location, m.calendar),
    "q6": lambda m: yoy_growth(m.performance_fact, m.location, m.calendar),
    "q7": lambda m: top_categories(m.performance_fact, m.location, m.business_category, m.category),
    "q8": lambda m: potential_score(m.performance_fact, m.location),
}
