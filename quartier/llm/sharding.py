"""Proportional stratified interleaving: shards of equal row counts whose source mixture matches the whole table.

Rows of each source are shuffled by a seeded hash and ranked. A row of rank r (from 1) in a source of n rows stands at
the fraction (r - u) / n, with one u between 0 and 1 per source so that sources of equal size do not come in bursts; all
rows sorted by that fraction are cut into equal runs, so each run holds every source in proportion, to within the rows
that the other sources put ahead or behind at its two ends (about half a row for each source). Ranks and positions come from bucket counts: rows are ranked inside small buckets (by hash
within a source, by fraction over all), and the counts of the buckets before give the rest. No bucket grows with one
source, so a source with a third of all rows is spread like any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Hash buckets a source is ranked in, and slices of the interleaved order. Row counts per bucket shrink with both.
BUCKETS = 4096
#: A source's u has steps of one STEPS-th.
STEPS = 1024
ROW_OVERHEAD = 16


def _stratum(source: str) -> Column:
    """A key that holds null apart from every text."""
    return F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit(""))


def _before(counts: DataFrame, by: list[str], order: str, count: str, name: str) -> DataFrame:
    """Sum of ``count`` over the rows of lower ``order``."""
    window = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn(name, F.coalesce(F.sum(count).over(window), F.lit(0)))


def interleave(
    docs: DataFrame, shards: int = 40, seed: int = 42, id_col: str = "doc_id", source_col: str = "source",
    text_col: str = "text",
) -> DataFrame:
    """Every row of ``docs`` with its shard, as (doc_id, source, size, text_crc32, shard, slot).

    Shards differ by one row at most; within a shard ``slot`` counts from 0. Null ids and null sources are values like any
    other, a null text has size 16 and the CRC of no bytes. Repeated rows stay, each with a place of its own. An empty
    table gives an empty result; further columns are not looked at.
    """
    keys = [F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source")]
    shuffled = F.xxhash64(F.lit(seed), F.col(id_col))
    where = [_stratum(source_col).alias("_stratum"), F.pmod(shuffled, F.lit(BUCKETS)).alias("_bucket")]

    # First pass over ids and sources only: what lies before each bucket, and the size of each source.
    counts = docs.select(*where).groupBy("_stratum", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    per_source = Window.partitionBy("_stratum")
    counts = _before(counts, ["_stratum"], "_bucket", "_n", "_ahead").withColumn("_total", F.sum("_n").over(per_source))
    counts = counts.withColumn("_u", F.pmod(F.xxhash64(F.lit(seed), "_stratum"), F.lit(STEPS - 1)) + 1)

    text = F.encode(F.coalesce(F.col(text_col), F.lit("")), "utf-8")
    rows = docs.select(
        *keys, *where, shuffled.alias("_hash"), (F.octet_length(text) + F.lit(ROW_OVERHEAD)).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
    )
    in_bucket = Window.partitionBy("_stratum", "_bucket").orderBy("_hash", "doc_id", "text_crc32", "size")
    ranked = rows.withColumn("_rank", F.row_number().over(in_bucket)).join(counts, ["_stratum", "_bucket"])
    part = STEPS * (F.col("_ahead") + F.col("_rank")) - F.col("_u")  # over STEPS * _total it is the row's fraction
    placed = ranked.withColumn("_part", part).withColumn("_slice", F.expr(f"_part * {BUCKETS} div ({STEPS} * _total)"))

    # How many rows of a source lie in slice j follows from n, u and j, so the slices' starts need no second pass. Sources of
    # one size and u go together; one with fewer rows than slices is counted row by row, so there are never more than rows.
    sizes = counts.groupBy("_stratum").agg(F.max("_total").alias("_total"), F.max("_u").alias("_u"))
    sizes = sizes.groupBy("_total", "_u").agg(F.count(F.lit(1)).alias("_sources"))
    slice_of = F.expr(f"({STEPS} * _row - _u) * {BUCKETS} div ({STEPS} * _total)")
    small = sizes.where(F.col("_total") < BUCKETS).withColumn("_row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_total"))))
    small = small.select(slice_of.cast("int").alias("_slice"), F.col("_sources").alias("_in"))
    before = f"({STEPS} * _slice * _total + {BUCKETS} * _u - 1) div ({STEPS * BUCKETS})"
    after = f"({STEPS} * (_slice + 1) * _total + {BUCKETS} * _u - 1) div ({STEPS * BUCKETS})"
    large = sizes.where(F.col("_total") >= BUCKETS).withColumn("_slice", F.explode(F.sequence(F.lit(0), F.lit(BUCKETS - 1))))
    large = large.select("_slice", ((F.expr(after) - F.expr(before)) * F.col("_sources")).alias("_in"))
    slices = small.union(large).groupBy("_slice").agg(F.sum("_in").alias("_in"))
    # As many rows as there are slices, so one task sums them up.
    slices = _before(slices.withColumn("_all", F.lit(0)), ["_all"], "_slice", "_in", "_start")
    slices = slices.select("_slice", "_start", F.sum("_in").over(Window.partitionBy("_all")).alias("_rows"))
    in_slice = Window.partitionBy("_slice").orderBy(F.col("_part") / F.col("_total"), "_stratum", "_part")
    n, position = F.col("_rows"), F.col("_position")
    return (
        placed.withColumn("_order", F.row_number().over(in_slice))
        .join(slices, "_slice")
        .withColumn("_position", F.col("_start") + F.col("_order") - 1)
        .withColumn("shard", F.expr(f"_position * {shards} div _rows").cast("int"))
        .withColumn("_first", F.expr(f"(shard * _rows + {shards - 1}) div {shards}"))
        .select("doc_id", "source", "size", "text_crc32", "shard", (position - F.col("_first")).alias("slot"))
    )
