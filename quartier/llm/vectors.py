"""Approximate nearest neighbours by largest inner product: inverted lists with an adaptive dimension scan.

Vectors get one more component that gives all the same length, so that the largest inner product is the least distance, and
are turned by one random rotation, so that any few components tell as much as any others. Centroids, fitted on a bounded
sample, deal every vector into a list; a query is compared with the vectors of the lists whose centroids are nearest.

Within a list, components are read in column blocks, for many queries at a time. After each block the distance so far, scaled
up, is tested against the twentieth-best distance known: a candidate is abandoned once it could be nearer only by a chance
that ``DOUBT`` sets. The survivors' inner products are taken in double precision on the original vectors.

A list is worked on in tiles of bounded size, at most ``TILE`` candidates against ``TILE`` queries, however many vectors one
list holds.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string

from quartier.llm.arrow import map_rows
from quartier.session import cut_lineage

#: Bound of the rows that centroids are fitted on, and of the number of lists.
SAMPLE = 40_000
MOST_LISTS = 4096
#: Share of the lists that a query looks into. Vectors without clusters need a large one: at 0.75 the recall over
#: 500, 10,256 and 51,282 nearly evenly spread vectors is 0.93 or more.
PROBED = 0.75
#: Candidates, and queries, that meet in one task at a time.
TILE = 4096
#: Components read between two tests.
COLUMNS = 16
#: Queries compared with a tile at a time; pairs are read by themselves once they are fewer than one in ``FEW``.
QUERIES = 128
FEW = 32
#: Pairs whose inner products are taken at a time.
PAIRS = 1 << 15
DOUBT = 3.0
SEED = 7


def usable(vector: str) -> Column:
    """Whether a vector takes part: not null, not empty or zero, and all components finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


@dataclass(frozen=True)
class Index:
    rotation: np.ndarray  # (size + 1) x (size + 1)
    centroids: np.ndarray  # list x (size + 1), rotated
    longest: float

    def turned(self, vectors: np.ndarray, query: bool = False) -> np.ndarray:
        """Vectors with the component that makes them ``longest`` long (0 for queries), rotated."""
        rest = np.zeros(len(vectors)) if query else np.sqrt(np.maximum(self.longest**2 - (vectors**2).sum(axis=1), 0))
        return np.column_stack([vectors, rest]) @ self.rotation

    def nearest_lists(self, turned: np.ndarray, how_many: int) -> np.ndarray:
        far = (self.centroids**2).sum(axis=1)[None, :] - 2 * turned @ self.centroids.T
        return far.argmin(axis=1)[:, None] if how_many == 1 else np.argsort(far, axis=1, kind="stable")[:, :how_many]


def fit(vectors: DataFrame, seed: int = SEED) -> Index | None:
    """An index model from (vec_id, vector) rows that take part; none without rows.

    There are as many lists as the cube root of the rows, so lists are many and still well filled at any size.
    """
    square = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    rows, longest = vectors.agg(F.count(F.lit(1)), F.max(square)).first()
    if not rows:
        return None
    chosen = vectors.orderBy(F.xxhash64(F.lit(seed), "vec_id"), "vec_id").limit(SAMPLE).toPandas()
    sample = np.stack([np.asarray(v, dtype=np.float64) for v in chosen.vector])
    random = np.random.default_rng(seed)
    rotation = np.linalg.qr(random.normal(size=(sample.shape[1] + 1,) * 2))[0]
    start = Index(rotation, np.zeros((0, len(rotation))), math.sqrt(longest))
    points = start.turned(sample)
    lists = max(1, min(MOST_LISTS, len(points), round(rows ** (1 / 3))))
    centroids = points[random.choice(len(points), lists, replace=False)]
    for _ in range(8):
        nearest = np.concatenate([
            ((centroids**2).sum(axis=1) - 2 * part @ centroids.T).argmin(axis=1)
            for part in np.array_split(points, math.ceil(len(points) / 2048))
        ])
        count = np.bincount(nearest, minlength=lists)
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, points)
        centroids = np.where(count[:, None] > 0, sums / np.maximum(count, 1)[:, None], centroids)
    return Index(rotation, centroids, start.longest)


def scan(candidates: np.ndarray, queries: np.ndarray, k: int, doubt: float = DOUBT) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (place of a query, place of a candidate) of rotated vectors that stay possible among the query's ``k`` nearest.

    The distance over the first d of D components, times D / d, is within a factor (1 + doubt / sqrt(d)) ** 2 of the
    whole one but for a small chance. ``candidates`` has one row per component, ``queries`` one per query, so that a block
    of components is one product of matrices. Once few pairs are left, they are read by themselves.
    """
    size, n = candidates.shape
    if n <= k:
        which, place = np.nonzero(np.ones((len(queries), n), dtype=bool))
        return which, place
    squares = candidates**2
    first = np.arange(0, n, max(1, n // (4 * k)))
    own = (queries**2).sum(axis=1)[:, None]
    known = squares[:, first].sum(axis=0) + own - 2 * queries @ candidates[:, first]
    slack = 1e-5 * (squares.sum(axis=0).max() + own[:, 0])  # what single precision may add or take away
    bound = np.partition(known, k - 1, axis=1)[:, k - 1] + slack
    places, far = np.arange(n), np.zeros((len(queries), n), dtype=candidates.dtype)
    for start in range(0, size, COLUMNS):
        read = min(start + COLUMNS, size)
        part, block = queries[:, start:read], candidates[start:read, places] if len(places) < n else candidates[start:read]
        far += (block**2).sum(axis=0) + (part**2).sum(axis=1)[:, None] - 2 * part @ block
        if read == size:
            break
        near = far <= (bound * (1 + doubt / math.sqrt(read)) ** 2 * (read / size) + slack)[:, None]
        if np.count_nonzero(near) * FEW < near.size:
            which, at = np.nonzero(near)
            return _scan_pairs(candidates, queries, which, places[at], far[which, at], read, bound, slack, doubt)
        wanted = near.any(axis=0)
        if 2 * np.count_nonzero(wanted) < len(places):
            places, far = places[wanted], far[:, wanted]
    if len(places) > k:
        bound = np.minimum(bound, np.partition(far, k - 1, axis=1)[:, k - 1] + slack)
    which, at = np.nonzero(far <= bound[:, None])
    return which, places[at]


def _scan_pairs(
    candidates: np.ndarray, queries: np.ndarray, which: np.ndarray, place: np.ndarray, far: np.ndarray, read: int,
    bound: np.ndarray, slack: np.ndarray, doubt: float,
) -> tuple[np.ndarray, np.ndarray]:
    """The rest of a scan for the pairs (``which``, ``place``), whose distance over the ``read`` first components is ``far``."""
    size = len(candidates)
    while read < size:
        start, read = read, min(read + COLUMNS, size)
        far = far + ((candidates[start:read, place] - queries[which, start:read].T) ** 2).sum(axis=0)
        factor = 1 if read == size else (1 + doubt / math.sqrt(read)) ** 2 * (read / size)
        near = far <= (bound * factor + slack)[which]
        which, place, far = which[near], place[near], far[near]
    return which, place


def best(
    candidates: np.ndarray, ids: np.ndarray, queries: np.ndarray, keys: np.ndarray, which: np.ndarray, place: np.ndarray, k: int,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, id, inner product) of each query's ``k`` best among the pairs (``which``, ``place``), itself left out.

    Ties go to the smaller id; equal vectors get equal products.
    """
    other = ids[place] != keys[which]
    which, place = which[other], place[other]
    scores = np.empty(len(which))
    for start in range(0, len(which), PAIRS):
        part = slice(start, start + PAIRS)
        scores[part] = (candidates[place[part]] * queries[which[part]]).sum(axis=1)
    order = np.lexsort((ids[place], -scores, which))
    which, place, scores = which[order], place[order], scores[order]
    first = np.arange(len(which)) - np.searchsorted(which, which) < k
    return keys[which[first]], ids[place[first]], scores[first]


def _vectors(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Ids, and vectors as rows of a matrix, of the last two columns."""
    ids, own = rows.columns[-2:]
    return ids.to_numpy(), np.frombuffer(b"".join(own.to_pylist()), np.float64).reshape(len(ids), -1)


def neighbours(
    table: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding",
    probed: float = PROBED,
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query row, its ``k`` best other rows by inner product.

    Runs its fit and keeps its lists as a table when called. Rows whose vector is null, empty, zero, or holds a null or
    non-finite component take no part, nor do rows with a null id or whose vector's length is not the most common one. Rows
    with one id count as one vector (the first by value). Further columns are not looked at.
    """
    spark = table.sparkSession
    taken = table.where(F.col(id_col).isNotNull() & usable(vector_col))
    sizes = taken.groupBy(F.size(vector_col).alias("size")).count().orderBy(F.desc("count"), "size").first()
    schema = "query_id long, rank int, vec_id long, score double"
    if sizes is None:
        return spark.createDataFrame([], schema)
    whole = taken.where(F.size(vector_col) == sizes["size"])
    rows = whole.groupBy(F.col(id_col).cast("long").alias("vec_id")).agg(
        F.min(F.col(vector_col).cast("array<double>")).alias("vector"), F.max(is_query.cast("int")).alias("asks")
    )
    rows = cut_lineage(rows)
    index = fit(rows.select("vec_id", "vector"))
    assert index is not None
    probes = max(1, math.ceil(probed * len(index.centroids)))

    def deal():
        def step(ids: list, vectors: list, asks: list) -> Iterator[tuple]:
            raw = np.array(vectors, dtype=np.float64)
            lists = index.nearest_lists(index.turned(raw), 1)[:, 0]
            looks: list[list[int] | None] = [None] * len(ids)
            asking = np.flatnonzero(asks)
            if len(asking):
                for at, near in zip(asking, index.nearest_lists(index.turned(raw[asking], query=True), probes)):
                    looks[at] = near.tolist()
            yield from zip(lists.tolist(), looks, ids, (own.tobytes() for own in raw))

        return step

    dealt = cut_lineage(map_rows(rows, "list int, looks array<int>, id long, own binary", deal))
    asked = dealt.where("looks IS NOT NULL").select(F.explode("looks").alias("list"), "id", "own")
    counts = [side.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / TILE).alias(n)) for side, n in ((dealt, "c"), (asked, "q"))]
    tiles = F.broadcast(counts[0].join(counts[1], "list"))  # at most MOST_LISTS rows
    at = F.xxhash64("id")
    left = dealt.select("list", "id", "own").join(tiles, "list").withColumn("ct", F.pmod(at, F.col("c")))
    left = left.withColumn("qt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("q") - 1)))
    right = asked.join(tiles, "list").withColumn("qt", F.pmod(at, F.col("q")))
    right = right.withColumn("ct", F.explode(F.sequence(F.lit(0).cast("long"), F.col("c") - 1)))
    keys = ["list", "ct", "qt"]
    turns = replace(index, centroids=index.centroids[:0])
    made = _parse_datatype_string("query_id long, vec_id long, score double")
    assert isinstance(made, StructType)
    kind = to_arrow_schema(made)

    def meet(candidates: pa.Table, queries: pa.Table) -> pa.Table:
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        if len(candidates) and len(queries):
            (ids, own), (wanting, raw) = (_vectors(side) for side in (candidates, queries))
            turned = np.ascontiguousarray(turns.turned(own).T, dtype=np.float32)
            for start in range(0, len(wanting), QUERIES):
                part = slice(start, start + QUERIES)
                pairs = scan(turned, turns.turned(raw[part], query=True).astype(np.float32), k + 1)  # one more: the query itself
                found.append(best(own, ids, raw[part], wanting[part], *pairs, k))
        return pa.table([np.concatenate(column) for column in zip(*found)], schema=kind)

    columns = [*keys, "id", "own"]
    asking = right.select(*columns).toDF(*(f"q_{c}" for c in columns))
    met = left.select(*columns).groupBy(*keys).cogroup(asking.groupBy(*(f"q_{c}" for c in keys))).applyInArrow(meet, made)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = met.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def recall(found: DataFrame, truth: DataFrame) -> float:
    """Share of the true (query_id, vec_id) pairs that were found."""
    hit = truth.join(found, ["query_id", "vec_id"], "left_semi").count()
    return hit / max(1, truth.count())
