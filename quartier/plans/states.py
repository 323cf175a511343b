"""Summary tables kept as states that merge with a change of the fact, so that a refresh reads the change and not the fact.

Each summary is a table of sums over groups. Counts of distinct businesses are sums too, once every business has one mark
in a group: a stored table of marks holds the months and reviews of each business and year, and tells for the touched
businesses what they were counted as before and what they are now. Scores are summed as decimals, so that sums do not depend on
the order of changes and what is taken away is exactly what was added.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quartier.functions import half_up
from quartier.operators.grains import category_weights, with_months
from quartier.plans.mart import Mart, Store
from quartier.session import cut_lineage

_EXACT = "decimal(38,18)"
#: The groups of each state and its sums.
STATES = {
    "state_years_state": (["state", "year"], ["n", "reviews", "checkins", "score_sum", "score_n"]),
    "gems_by_city_state": (["state", "city"], ["n", "star_sum", "weight", "reviews"]),
    "category_stats_state": (["category_id"], ["n", "star_sum", "weight", "reviews"]),
}
MARKS = "business_year_marks"
_YEAR = ["business_id", "year"]


def _per_year(fact: DataFrame, calendar: DataFrame, sign: int) -> DataFrame:
    """Sums per business and year, with a sign."""
    sums = {
        "months": F.count(F.lit(1)), "reviews": F.sum("review_count"), "checkins": F.sum("checkin_count"),
        "score_sum": F.coalesce(F.sum(F.col("score_mean").cast(_EXACT)), F.lit(0)).cast(_EXACT), "score_n": F.count("score_mean"),
    }
    rows = with_months(fact, calendar, "year").groupBy(*_YEAR).agg(*(v.alias(k) for k, v in sums.items()))
    return rows.select(*_YEAR, *((F.col(k) * sign).cast(_EXACT if k == "score_sum" else "long").alias(k) for k in sums))


def _summed(rows: DataFrame, keys: list[str], sums: list[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(*(F.sum(c).cast(rows.schema[c].dataType).alias(c) for c in sums))


def _signed(rows: DataFrame, columns: list[str], sign: int) -> DataFrame:
    return rows.withColumns({c: (F.col(c) * sign).cast(rows.schema[c].dataType) for c in columns})


@dataclass(frozen=True)
class SummaryStates:
    """The states of M1, M2 and M3 in ``store``. Location, business and bridge must be those they were built with."""

    store: Store

    def build(self, mart: Mart) -> None:
        """The states of a whole mart."""
        self._merge(_per_year(mart.performance_fact, mart.calendar, 1), None, mart)

    def merge(self, before: DataFrame, after: DataFrame, mart: Mart) -> None:
        """Bring the states up to date with rows of the fact that were ``before`` and are ``after``.

        Both hold all rows of the touched keys; ``mart`` gives dimensions and the calendar, its fact is not read. The calendar must
        still have the months of ``before``.
        """
        change = _per_year(before, mart.calendar, -1).union(_per_year(after, mart.calendar, 1))
        sums = [c for c in change.columns if c not in _YEAR]
        self._merge(_summed(change, _YEAR, sums), self.store.load(MARKS), mart)

    def _merge(self, change: DataFrame, marks: DataFrame | None, mart: Mart) -> None:
        change = cut_lineage(change)
        new = change.select(*_YEAR, "months", "reviews")
        kept = old = new.limit(0)
        if marks is not None:
            touched = cut_lineage(change.select("business_id").distinct())
            old = cut_lineage(marks.join(touched, "business_id", "left_semi").select(*new.columns))
            kept = marks.join(touched, "business_id", "left_anti").select(*new.columns)
            new = _summed(old.union(new), _YEAR, ["months", "reviews"])
        new = cut_lineage(new.where("months <> 0"))

        one = F.lit(1).cast("long").alias("n")
        marked = _signed(old.select(*_YEAR, one), ["n"], -1).union(new.select(*_YEAR, one))
        zero = F.lit(0).cast("long")
        years = marked.select(*_YEAR, "n", zero.alias("reviews"), zero.alias("checkins"), F.lit(0).cast(_EXACT).alias("score_sum"), zero.alias("score_n"))
        years = years.union(change.select(*_YEAR, zero.alias("n"), "reviews", "checkins", "score_sum", "score_n"))
        years = years.join(mart.location.select("business_id", "state"), "business_id")

        def totals(rows: DataFrame) -> DataFrame:
            sums = _summed(rows, ["business_id"], ["months", "reviews"])
            stars = mart.business.select("business_id", "stars", "is_open")
            weighted = F.coalesce((F.col("stars") * F.col("months")).cast(_EXACT), F.lit(0).cast(_EXACT))
            weight = F.when(F.col("stars").isNotNull(), F.col("months")).otherwise(0).cast("long")
            return sums.join(stars, "business_id").select("*", one, weighted.alias("star_sum"), weight.alias("weight"))

        sums = ["n", "star_sum", "weight", "reviews"]
        businesses = cut_lineage(_signed(totals(old), sums, -1).union(totals(new)))
        gems = businesses.where("stars >= 4.2 AND is_open = 1").join(mart.location.select("business_id", "state", "city"), "business_id")
        pairs = category_weights(mart.business_category).withColumnRenamed("weight", "times")
        listed = businesses.join(pairs, "business_id").withColumns({
            c: (F.col(c) * F.col("times")).cast(businesses.schema[c].dataType) for c in sums if c != "n"
        })
        for name, rows in zip(STATES, (years, gems, listed)):
            keys, measures = STATES[name]
            rows = rows.select(*keys, *measures)
            if marks is not None:
                rows = self.store.load(name).select(*keys, *measures).union(rows)
            # Kept first: the stored table is read here and replaced below.
            self.store.save(cut_lineage(_summed(rows, keys, measures).where("n <> 0")), name)
        self.store.save(cut_lineage(kept.union(new)), MARKS)

    def state_years(self) -> DataFrame:
        """M1 from its state."""
        state = self.store.load("state_years_state")
        return state.select(
            "state", "year", F.col("n").alias("nb_commerces"), F.col("reviews").alias("total_reviews"),
            F.col("checkins").alias("total_checkins"), _mean("score_sum", "score_n").alias("note_moyenne"),
        )

    def gems_by_city(self, max_reviews: int = 150) -> DataFrame:
        """M2 from its state."""
        state = self.store.load("gems_by_city_state").where(F.col("reviews") < max_reviews * F.col("n"))
        return state.select("state", "city", F.col("n").alias("nb_pepites"), _mean("star_sum", "weight").alias("note_moyenne"))

    def category_stats(self, category: DataFrame) -> DataFrame:
        """M3 from its state."""
        state = self.store.load("category_stats_state").join(category, "category_id")
        return state.select(
            "category_name", F.col("n").alias("nb_commerces"), _mean("star_sum", "weight").alias("note_moyenne"),
            F.col("reviews").alias("total_reviews"),
        )


def _mean(total: str, count: str) -> Column:
    return half_up(F.col(total).cast("double") / F.nullif(F.col(count), F.lit(0)), 2)
