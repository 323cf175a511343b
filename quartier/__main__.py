"""Command line for the jobs: ``python -m quartier JOB --root FOLDER ...`` (or through spark-submit)."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession

from quartier.operators import dims
from quartier.plans import jobs, olap, summaries
from quartier.plans.mart import Store
from quartier.plans.versions import Versions
from quartier.session import SETTINGS
from quartier.sinks import jdbc as sink
from quartier.sources import files, jdbc


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="quartier", description=__doc__)
    job = parser.add_subparsers(dest="job", required=True)

    def add(name: str, text: str, connection: bool = False) -> argparse.ArgumentParser:
        command = job.add_parser(name, help=text)
        command.add_argument("--root", required=True, help="folder of the staged tables")
        command.add_argument("--buckets", type=int, help="bucket the large tables on the business")
        command.add_argument("--prefix", default="", help="prefix of bucketed table names")
        command.add_argument("--versions", action="store_true", help="publish the job's tables as one version")
        if connection:
            command.add_argument("--jdbc", action="append", default=[], metavar="KEY=VALUE", help="connection option")
        return command

    dimensions = add("dimensions", "stage the four business tables")
    dimensions.add_argument("--business", required=True)
    dimensions.add_argument("--dense-keys", action="store_true", help="keys 1, 2, 3, ... that stay over loads, not hashes")
    reviews = add("reviews", "stage the reviews from their database", connection=True)
    reviews.add_argument("--table", required=True)
    reviews.add_argument("--partitions", type=int, default=100)
    reviews.add_argument("--partition-column", default=jdbc.PARTITION_COLUMN)
    add("calendar", "stage the calendar from the staged reviews and show its years")
    fact = add("fact", "stage the monthly fact")
    fact.add_argument("--tips", required=True)
    fact.add_argument("--tips-multi-line", action="store_true", help="tips hold quoted line breaks (a file is one task)")
    fact.add_argument("--tips-escape", default="\\", help="what stands before a quote inside quotes")
    fact.add_argument("--checkins", required=True)
    load = add("load", "load the staged tables into a database", connection=True)
    load.add_argument("--batch-size", type=int, default=420)
    load.add_argument("--connections", type=int)
    add("summaries", "recompute the summary tables")
    report = add("report", "show a report")
    report.add_argument("name", choices=sorted(olap.REPORTS))
    report.add_argument("--rows", type=int, default=20, help="rows shown")
    report.add_argument("--output", help="folder that all rows are written to, as Parquet")
    return parser


def main(argv: Sequence[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    builder = SparkSession.builder.appName(f"quartier {args.job}")
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    options = dict(option.split("=", 1) for option in getattr(args, "jdbc", []))
    if not args.versions:
        _run(args, spark, Store(spark, args.root, args.buckets, args.prefix), options)
        return
    versions = Versions(spark, args.root, args.buckets, args.prefix)
    if args.job in ("load", "report"):  # these only read
        _run(args, spark, versions.current(), options)
        return
    with versions.load() as store:
        _run(args, spark, store, options)


def _run(args: argparse.Namespace, spark: SparkSession, store: Store, options: dict[str, str]) -> None:
    if args.job == "dimensions":
        jobs.build_dimensions(files.check_business(spark, args.business), store, args.dense_keys)
    elif args.job == "reviews":
        table = jdbc.read_table_split(spark, options, args.table, args.partitions, args.partition_column)
        jobs.stage_reviews(table, store)
    elif args.job == "calendar":
        jobs.build_calendar(store.load(jobs.REVIEW_SOURCE), store)
        dims.months_per_year(store.load("calendar")).show()
    elif args.job == "fact":
        tips = files.check_tips(spark, args.tips, multi_line=args.tips_multi_line, escape=args.tips_escape)
        jobs.build_fact(store.load(jobs.REVIEW_SOURCE), tips, files.check_checkins(spark, args.checkins), store)
    elif args.job == "load":
        sink.load_warehouse(store.mart(), options, batch_size=args.batch_size, connections=args.connections)
    elif args.job == "summaries":
        summaries.refresh_all(store.mart(), store)
    elif args.job == "report":
        rows = olap.REPORTS[args.name](store.mart())
        if args.output:
            rows.write.mode("overwrite").parquet(args.output)
            rows = spark.read.parquet(args.output)
        count = rows.count()
        rows.show(args.rows, truncate=False)
        print(f"{min(args.rows, count)} of {count} rows shown")


if __name__ == "__main__":
    main()
