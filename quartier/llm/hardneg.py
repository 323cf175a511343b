"""Hard negatives by a vertical scan: one dimension after another, the heaviest of the anchor first.

Components are whole numbers. Candidates lie in blocks column by column, with the least and greatest value of each column.
An anchor reads columns in the order of its own components' magnitude; what the unread ones can still add lies between sums
of products with those extremes. So each candidate's score has a lower and an upper bound after every few columns, and
candidates that cannot matter leave the bitmap: for positives those below the k-th greatest lower bound, for negatives
those outside every window of scores, or below the best that a window is sure of. What is left has exact scores.

Candidates are dealt into rounds, each eight times the one before, by a hash of their ids; the bounds an anchor has after a
round hold in the next, so a round adds few rows for each anchor however many blocks there are. Blocks and tiles of anchors
are of bounded size, and every pair of them meets in a task of its own.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quartier.session import cut_lineage

#: Candidates in a block, and anchors that meet it in one task, on average.
BLOCK = 8192
#: How many times the rows before it a round has.
GROWTH = 8
#: Columns read between two looks at the bounds.
COLUMNS = 8
SCALE = 256
SEED = 13

Keep = Callable[[np.ndarray, np.ndarray], np.ndarray]


class Vertical:
    """A block of vectors by columns."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> None:
        order = np.argsort(ids, kind="stable")
        self.ids, self.labels = ids[order], labels[order]
        self.columns = np.ascontiguousarray(vectors[order].T.astype(np.int64))
        self.least, self.most = self.columns.min(axis=1), self.columns.max(axis=1)

    def scan(self, query: np.ndarray, alive: np.ndarray, keep: Keep) -> tuple[np.ndarray, np.ndarray]:
        """Places and exact scores of the candidates ``alive`` that ``keep(lower, upper)`` keeps to the end."""
        order = np.argsort(-np.abs(query), kind="stable")
        ends = np.sort(np.stack([query * self.least, query * self.most]), axis=0)[:, order]
        rest = np.concatenate([ends[:, ::-1].cumsum(axis=1)[:, ::-1], [[0], [0]]], axis=1)
        score = np.zeros(len(alive), dtype=np.int64)
        for start in range(0, len(order), COLUMNS):
            read = order[start : start + COLUMNS]
            block = self.columns[read] if len(alive) == len(self.ids) else self.columns[np.ix_(read, alive)]
            score = score + (query[read, None] * block).sum(axis=0)
            low, high = rest[:, min(start + COLUMNS, len(order))]
            kept = keep(score + low, score + high)
            alive, score = alive[kept], score[kept]
            if not len(alive):
                break
        return alive, score


def _kth(values: np.ndarray, k: int) -> int | None:
    return int(np.partition(values, len(values) - k)[len(values) - k]) if len(values) >= k else None


def _highest(*bars: int | None) -> int | None:
    return max((b for b in bars if b is not None), default=None)


def best(block: Vertical, own: int, label: int, query: np.ndarray, k: int, bar: int | None) -> list[tuple[int, int]]:
    """(id, score) of the ``k`` best others of the ``label``, without those below ``bar``; ties to the smaller id."""

    def keep(lower: np.ndarray, upper: np.ndarray) -> np.ndarray:
        least = _highest(bar, _kth(lower, k))
        return np.ones(len(upper), dtype=bool) if least is None else upper >= least

    alive = np.flatnonzero((block.labels == label) & (block.ids != own))
    alive, score = block.scan(query, alive, keep)
    first = np.argsort(-score, kind="stable")[:k]
    return [(int(block.ids[alive[i]]), int(score[i])) for i in first]


def window(positive_score: int, low: int, high: int) -> tuple[int, int]:
    """Least and greatest score n with low * p <= 100 * n <= high * p."""
    return -(-low * positive_score // 100), high * positive_score // 100


def within(
    block: Vertical, label: int, query: np.ndarray, windows: list[tuple[int, int]], bars: list[int | None], k: int
) -> list[list[tuple[int, int]]]:
    """For each window the ``k`` best (id, score) of other labels in it, without those below its bar."""

    def keep(lower: np.ndarray, upper: np.ndarray) -> np.ndarray:
        kept = np.zeros(len(upper), dtype=bool)
        for (low, high), bar in zip(windows, bars):
            least = _highest(low, bar, _kth(lower[(lower >= low) & (upper <= high)], k))
            kept |= (upper >= least) & (lower <= high)
        return kept

    alive, score = block.scan(query, np.flatnonzero(block.labels != label), keep)
    found = []
    for low, high in windows:
        inside = np.flatnonzero((score >= low) & (score <= high))
        first = inside[np.argsort(-score[inside], kind="stable")[:k]]
        found.append([(int(block.ids[alive[i]]), int(score[i])) for i in first])
    return found


def _finite(vector: str, limit: float) -> Column:
    return F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < limit))


def _block(rows: pd.DataFrame) -> Vertical:
    return Vertical(rows["id"].to_numpy(), rows["label"].to_numpy(), np.stack(rows["vector"].tolist()))


def _met(blocks: DataFrame, anchors: DataFrame, tiles: int, work: Callable[[Vertical, tuple], list[tuple]], schema: str) -> DataFrame:
    """What ``work(block, anchor row)`` gives for every anchor and block; ``tiles`` are those of the anchors."""
    count = blocks.agg(F.max("block")).first()[0]
    left = blocks.withColumn("tile", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(tiles - 1).cast("long"))))
    right = anchors.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(count or 0).cast("long"))))
    names = schema.replace(" long", "").replace(" ", "").split(",")

    def meet(candidates: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        found: list[tuple] = []
        if len(candidates) and len(queries):
            block = _block(candidates)
            for row in queries.itertuples(index=False):
                found += work(block, row)
        return pd.DataFrame(found, columns=names)

    pairs = left.groupBy("block", "tile").cogroup(right.groupBy("block", "tile"))
    return pairs.applyInPandas(meet, schema)


def _first(found: DataFrame, by: list[str], other: str, score: str, k: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc(score), other)
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(
    table: DataFrame, is_anchor: Column, label: Column, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95,
    id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score), computed when called.

    Scores are inner products of components floor(``scale`` * x). An anchor's positives are its best other rows of the same
    label; for each, the first rows of other labels whose score is between ``low`` and ``high`` per cent of the positive's.
    Higher scores come first, ties by smaller id. An anchor alone with its label, and a positive without a row in its window
    (always so below zero), give no row.

    Rows with a null id, label or vector, or a null or non-finite component, take no part; nor do vectors whose length is not
    the most common one, or with components so large that scores might not fit a long (2 ** 20 at 64 components). Zero
    vectors do. Rows with one id count as one (the first by label and vector). Further columns are not looked at.
    """
    spark = table.sparkSession
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    named = table.select(
        F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"),
        F.col(vector_col).cast("array<double>").alias("vector"), is_anchor.alias("asks"),
    )
    taken = named.where("id IS NOT NULL AND label IS NOT NULL").where(F.coalesce(_finite("vector", math.inf), F.lit(False)))
    size = taken.groupBy(F.size("vector").alias("size")).count().orderBy(F.desc("count"), "size").first()
    if size is None or not size["size"]:
        return spark.createDataFrame([], schema)
    limit = 2.0 ** ((62 - math.ceil(math.log2(size["size"]))) // 2) / scale
    whole = F.transform("vector", lambda x: F.floor(x * scale).cast("int"))
    rows = taken.where(F.size("vector") == size["size"]).where(_finite("vector", min(limit, 2.0**30 / scale)))
    rows = rows.select("id", "label", whole.alias("vector"), F.coalesce("asks", F.lit(False)).alias("asks"))
    rows = rows.groupBy("id").agg(F.min(F.struct("label", "vector")).alias("own"), F.max("asks").alias("asks"))
    rows = cut_lineage(rows.select("id", "own.label", "own.vector", "asks"))
    n, asking = rows.agg(F.count(F.lit(1)), F.count_if("asks")).first()
    if not asking:
        return spark.createDataFrame([], schema)

    tiles = math.ceil(asking / BLOCK)
    anchors = rows.where("asks").select(
        "id", "label", "vector", F.pmod(F.xxhash64(F.lit(SEED), "id"), F.lit(tiles)).alias("tile")
    )
    anchors = cut_lineage(anchors)
    last = max(0, math.ceil(math.log(n / BLOCK, GROWTH)))
    place = F.pmod(F.xxhash64(F.lit(SEED + 1), "id"), F.lit(1 << 30)) * (n / (1 << 30))
    level, count = F.lit(last), F.lit(1)
    for r in reversed(range(last + 1)):
        there = min(n, BLOCK * GROWTH**r) - (BLOCK * GROWTH ** (r - 1) if r else 0)
        level = F.when(place < BLOCK * GROWTH**r, r).otherwise(level)
        count = F.when(level == r, max(1, math.ceil(there / BLOCK))).otherwise(count)
    dealt = rows.select("id", "label", "vector", level.alias("round"), F.pmod(F.xxhash64(F.lit(SEED + 2), "id"), count).alias("block"))
    dealt = cut_lineage(dealt)
    rounds = [dealt.where(F.col("round") == r).drop("round") for r in range(last + 1)]

    def positive(block: Vertical, row: tuple) -> list[tuple]:
        bar = None if pd.isna(row.bar) else int(row.bar)
        return [(row.id, i, s) for i, s in best(block, row.id, row.label, np.asarray(row.vector, np.int64), positives, bar)]

    near = spark.createDataFrame([], "anchor_id long, positive_id long, positive_score long")
    for blocks in rounds:
        bars = near.groupBy("anchor_id").agg(F.count(F.lit(1)).alias("held"), F.min("positive_score").alias("bar"))
        bars = bars.where(F.col("held") == positives).select(F.col("anchor_id").alias("id"), "bar")
        found = _met(blocks, anchors.join(bars, "id", "left"), tiles, positive, "anchor_id long, positive_id long, positive_score long")
        near = cut_lineage(_first(near.union(found), ["anchor_id"], "positive_id", "positive_score", positives).drop("rank"))

    def negative(block: Vertical, row: tuple) -> list[tuple]:
        ranges = [window(int(w["positive_score"]), low, high) for w in row.windows]
        wanted = [k for k, (least, most) in enumerate(ranges) if least <= most]
        if not wanted:
            return []
        windows = [row.windows[k] for k in wanted]
        own = np.asarray(row.vector, np.int64)
        found = within(block, row.label, own, [ranges[k] for k in wanted], [w["bar"] for w in windows], negatives)
        return [(row.id, w["positive_id"], w["positive_score"], i, s) for w, got in zip(windows, found) for i, s in got]

    keys = ["anchor_id", "positive_id"]
    columns = "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long"
    far = spark.createDataFrame([], columns)
    for blocks in rounds:
        bars = far.groupBy(*keys).agg(F.count(F.lit(1)).alias("held"), F.min("negative_score").alias("bar"))
        bars = bars.where(F.col("held") == negatives).drop("held")
        each = F.struct("positive_id", "positive_score", "bar")
        windows = near.join(bars, keys, "left").groupBy(F.col("anchor_id").alias("id")).agg(F.collect_list(each).alias("windows"))
        found = _met(blocks, anchors.join(windows, "id"), tiles, negative, columns)
        far = cut_lineage(_first(far.union(found), keys, "negative_id", "negative_score", negatives).drop("rank"))
    ranked = _first(far, keys, "negative_id", "negative_score", negatives)
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
