"""The fact by months, kept up to date with late events instead of being built anew.

Events are staged by batch and month. A batch touches some businesses in some months; only these are computed again, from the
events of their months, and only the folders of their months are written. Loading a batch again replaces what it brought
before, so a load that failed half-way is simply repeated.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quartier.operators import facts
from quartier.operators.dims import month_dim
from quartier.plans.layouts import read_by_month, write_by_month
from quartier.session import cut_lineage, file_system

KINDS = ("reviews", "tips", "checkins")
#: Events of a task where those of touched keys are looked for.
TASK_EVENTS = 500_000
KEYS = facts.KEYS


@dataclass(frozen=True)
class Change:
    """What a batch did to the fact: the rows of the touched keys before and after, both kept."""

    before: DataFrame
    after: DataFrame


@dataclass(frozen=True)
class MonthlyFact:
    """The fact by months below ``root``, with its events. The businesses are those of ``location``."""

    spark: SparkSession
    root: str
    location: DataFrame

    def _schema(self) -> T.StructType:
        key, place = (self.location.schema[c].dataType for c in ("business_id", "location_id"))
        long = T.LongType()
        kinds = {"business_id": key, "time_id": T.IntegerType(), "location_id": place, "review_count": long, "tip_count": long,
                 "checkin_count": long, "score_mean": T.DoubleType()}
        return T.StructType([T.StructField(name, kind) for name, kind in kinds.items()])

    def fact(self) -> DataFrame:
        return read_by_month(self.spark, f"{self.root}/fact", self._schema())

    def _fact_if_there(self) -> DataFrame:
        where, path = file_system(self.spark, f"{self.root}/fact")
        return self.fact() if where.exists(path) else self.spark.createDataFrame([], self._schema())

    def events(self, kind: str) -> DataFrame | None:
        try:
            return self.spark.read.parquet(f"{self.root}/{kind}")
        except AnalysisException as error:
            if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            return None

    def calendar(self) -> DataFrame:
        """The months that have a review. Folders are months, so this reads no event twice."""
        reviews = self.events("reviews")
        if reviews is None:
            return month_dim(self.spark.createDataFrame([], "date date"), "date")
        day = F.to_date(F.col("time_id").cast("string"), "yyyyMM")
        return month_dim(reviews.select("time_id").distinct().select(day.alias("date")), "date")

    def _stage(self, kind: str, events: DataFrame, batch: str) -> None:
        columns = ["business_id", "date", *(["review_id", "stars"] if kind == "reviews" else [])]
        rows = cut_lineage(facts.with_time_id(events.select(*columns)).dropna(subset=KEYS))
        where, path = file_system(self.spark, f"{self.root}/{kind}/batch=b-{batch}")
        where.delete(path, True)  # a batch that is loaded again replaces itself
        dealt = rows.repartitionByRange("time_id", "business_id").withColumn("batch", F.lit(f"b-{batch}"))  # never read as a number
        dealt.write.mode("append").partitionBy("batch", "time_id").parquet(f"{self.root}/{kind}")

    def _batch_keys(self, batch: str) -> DataFrame:
        """Keys of a batch, as often as it has events of them."""
        found = self.spark.createDataFrame([], T.StructType([self._schema()[c] for c in KEYS]))
        for kind in KINDS:
            events = self.events(kind)
            if events is not None:
                found = found.union(events.where(F.col("batch") == f"b-{batch}").select(*KEYS))
        return found

    def _months(self) -> set[int]:
        return {r["time_id"] for r in self.calendar().select("time_id").collect()}  # at most 12 for each of 9,999 years

    def add(self, batch: str, reviews: DataFrame, tips: DataFrame, checkins: DataFrame) -> Change:
        """Load a batch of events, the first or a late one; ``batch`` is its name, of letters and digits.

        A month that gets its first review becomes part of the calendar: then all its tips and check-ins count from now on.
        """
        if not batch.isalnum():
            raise ValueError("a batch is named by letters and digits")
        if all(self.events(kind) is None for kind in KINDS):
            return self._add_first(batch, reviews, tips, checkins)
        earlier, months = cut_lineage(self._batch_keys(batch).distinct()), self._months()
        for kind, events in zip(KINDS, (reviews, tips, checkins)):
            self._stage(kind, events, batch)
        touched = earlier.union(self._batch_keys(batch))
        changed = sorted(months ^ self._months())
        if changed:
            for kind in KINDS:
                events = self.events(kind)
                if events is not None:
                    touched = touched.union(events.where(F.col("time_id").isin(changed)).select(*KEYS))
        touched = cut_lineage(touched.distinct())
        here = sorted(r["time_id"] for r in touched.select("time_id").distinct().collect())
        of_months = F.col("time_id").isin(here)
        # Counted, not coalesced by bytes: sorted and compressed keys take many times their bytes in a task.
        found = [events.where(of_months) for events in map(self.events, KINDS) if events is not None]
        tasks = 1 + sum(events.count() for events in found) // TASK_EVENTS
        tasks = max(tasks, int(self.spark.conf.get("spark.sql.shuffle.partitions")))
        dealt = touched.repartition(tasks, *KEYS)

        after = self._computed(lambda events: events.where(of_months).join(dealt, KEYS, "left_semi"))
        old = self._fact_if_there().where(of_months)
        before = cut_lineage(old.join(dealt, KEYS, "left_semi").select(*after.columns))
        rows = cut_lineage(old.join(dealt, KEYS, "left_anti").select(*after.columns).union(after))
        write_by_month(rows, f"{self.root}/fact", months_only=True)
        left = {r["time_id"] for r in rows.select("time_id").distinct().collect()}
        for month in set(here) - left:  # nothing is left of it, so no folder took its place
            where, path = file_system(self.spark, f"{self.root}/fact/time_id={month}")
            where.delete(path, True)
        return Change(before, after)

    def _add_first(self, batch: str, reviews: DataFrame, tips: DataFrame, checkins: DataFrame) -> Change:
        """The first batch touches all keys there are: none has to be looked for, and no row of the fact stays."""
        for kind, events in zip(KINDS, (reviews, tips, checkins)):
            self._stage(kind, events, batch)
        after = self._computed(lambda events: events)
        before = cut_lineage(self._fact_if_there().select(*after.columns))
        write_by_month(after, f"{self.root}/fact")
        return Change(before, after)

    def _computed(self, of: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """The rows of the fact from some of the events, kept."""

        def again(kind: str, columns: str) -> DataFrame:
            events = self.events(kind)
            if events is None:
                return self.spark.createDataFrame([], columns).withColumn(
                    "business_id", F.col("business_id").cast(self._schema()["business_id"].dataType)
                )
            return of(events)

        plain = "business_id string, date timestamp"
        return cut_lineage(facts.performance_fact(
            again("reviews", plain + ", review_id string, stars double"), again("tips", plain), again("checkins", plain),
            self.location, self.calendar(),
        ))
