"""Published versions of the staged tables: readers see all tables of one version, or none of it.

Tables of a version are written to folders of their own. What makes them a version is the manifest, a small table to which
one file with the places of all tables is appended last; Spark's commit makes a single file appear whole or not at all. A load
that fails half-way leaves the manifest, and with it every reader, at the version before.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quartier.plans.mart import BUCKETED, Store
from quartier.session import file_system
from quartier.sources import staged

MANIFEST = "published"
_SCHEMA = "version long, run string, name string, place string, bucketed boolean, at double"


class PublishedMeanwhile(RuntimeError):
    """Another load published a version since this one began."""


@dataclass(frozen=True)
class VersionStore(Store):
    """A :class:`Store` over the tables of one version, and over what the running load has written of the next."""

    run: str = ""
    places: dict[str, tuple[str, bool]] = field(default_factory=dict)
    written: dict[str, tuple[str, bool]] = field(default_factory=dict)

    def save(self, df: DataFrame, name: str) -> None:
        if not self.run:
            raise ValueError("a published version cannot be changed: save within Versions.load()")
        turn = f"{self.run}-{uuid.uuid4().hex[:8]}"
        path = f"{self.root}/{name}/run={turn}"
        if self.buckets is not None and name in BUCKETED:
            table = f"{self.prefix}{name}_{turn.replace('-', '_')}"
            staged.save_bucketed(df, table, self.buckets, path=path)
            self.written[name] = (table, True)
        else:
            df.write.parquet(path)
            self.written[name] = (path, False)

    def load(self, name: str) -> DataFrame:
        place, bucketed = self.written.get(name) or self.places[name]
        return self.spark.table(place) if bucketed else self.spark.read.parquet(place)

    def load_if_there(self, name: str) -> DataFrame | None:
        return self.load(name) if name in self.written or name in self.places else None


@dataclass(frozen=True)
class Versions:
    """The versions published below ``root``. With ``buckets``, large tables are bucketed catalog tables named with ``prefix``."""

    spark: SparkSession
    root: str
    buckets: int | None = None
    prefix: str = ""

    def manifest(self) -> DataFrame:
        """(version, run, name, place, bucketed, at) of every published table."""
        try:
            return self.spark.read.schema(_SCHEMA).parquet(f"{self.root}/{MANIFEST}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], _SCHEMA)

    def _latest(self) -> tuple[int, str]:
        """Of two loads that published the same number, the one with the greater name counts."""
        last = self.manifest().agg(F.max(F.struct("version", "run")).alias("last")).first()["last"]
        return (0, "") if last is None else (last["version"], last["run"])

    def _places(self, version: int, run: str) -> dict[str, tuple[str, bool]]:
        own = self.manifest().where((F.col("version") == version) & (F.col("run") == run))
        return {r["name"]: (r["place"], r["bucketed"]) for r in own.collect()}  # one row for each table of the schema

    def version(self) -> int:
        return self._latest()[0]

    def current(self) -> VersionStore:
        """The tables of the last published version, which later loads do not change."""
        return VersionStore(self.spark, self.root, self.buckets, self.prefix, places=self._places(*self._latest()))

    @contextmanager
    def load(self) -> Iterator[VersionStore]:
        """A store to write tables to; when the block ends well they are published together.

        Tables that the block does not write are those of the version before. When it fails, nothing is published. Of two
        loads at the same time the one that ends last fails with :class:`PublishedMeanwhile`.
        """
        version, before = self._latest()
        run = uuid.uuid4().hex
        store = VersionStore(
            self.spark, self.root, self.buckets, self.prefix, run=run, places=self._places(version, before)
        )
        yield store
        if self._latest() != (version, before):
            raise PublishedMeanwhile(f"version {version + 1} of {self.root} was published meanwhile")
        tables = store.places | store.written
        rows = [(version + 1, run, name, *place, time.time()) for name, place in sorted(tables.items())]
        self.spark.createDataFrame(rows, _SCHEMA).coalesce(1).write.mode("append").parquet(f"{self.root}/{MANIFEST}")
        if self._latest() != (version + 1, run):
            raise PublishedMeanwhile(f"version {version + 1} of {self.root} was published by two loads, and the other counts")

    def clean(self, keep: int = 2, unpublished_hours: float = 24) -> int:
        """Delete folders that the last ``keep`` versions do not use; how many. Younger ones that no version uses stay a while.

        Readers of older versions, and loads that run longer than ``unpublished_hours``, lose their tables.
        """
        known = self.manifest().select("version").distinct().orderBy(F.desc("version")).limit(keep).collect()
        kept = self.manifest().where(F.col("version").isin([r["version"] for r in known]))
        used = {r["place"] for r in kept.collect()}
        places = self.manifest().select("name", "place", "bucketed").distinct().collect()
        published = {r["place"] for r in places}
        for table in {r["place"] for r in places if r["bucketed"]} - used:
            self.spark.sql(f"DROP TABLE IF EXISTS `{table}`")
        tables = {p.rsplit("/", 1)[-1] for p in used if "/" in p}
        of_tables = {p for p in used if "/" not in p}
        deleted = 0
        files, path = file_system(self.spark, f"{self.root}/*/run=*")
        for status in files.globStatus(path) or []:
            folder = status.getPath()
            name = f"{self.prefix}{folder.getParent().getName()}_{folder.getName()[4:].replace('-', '_')}"
            if folder.getName() in tables or name in of_tables:
                continue
            was = any(place.endswith(folder.getName()) or place == name for place in published)
            if was or time.time() - status.getModificationTime() / 1000 > 3600 * unpublished_hours:
                files.delete(folder, True)
                deleted += 1
        return deleted
