"""Near-duplicate documents by bottom-k sketches of one hash function.

A document's set holds a hash of each of its five-word shingles; the ``SKETCH`` least hashes are its sketch, which is a
uniform sample of the set and, for smaller sets, the set itself. Documents with equal sets form a class at once, and all
work is done on classes.

Candidates. The least hashes of the union of two sets lie in both sketches wherever they lie in both sets. So sets of
similarity ``t`` share t * SKETCH retained values on average, and ``shared_at_least`` of them but for a chance of about 3e-7
for a pair exactly at the threshold. Two sketches that share s values share one among the len - s + 1 first of each in any
common order. The order taken is by rarity (counts of retained values in a table of fixed size, so any count is an upper
bound and the order is the same for all), hence inverted lists are kept for rare values only, and passages that many
documents share open none.

Overlaps within a list. Emitting all pairs of a list would be quadratic in a group of copies. First each list has its members
meet two pivots: the one whose retained values are most common altogether, which in a group of edited copies is the original,
and one picked at random for each list. Linked members are joined to components. Then members of one list in different components meet each other, which leaves no candidate out: pairs in one
component cannot change any component. In long lists this is done in tiles, which report links that join their members.

Pairs are filtered by the estimate from the union's sketch, and verified by the similarity of the full sets.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quartier.llm.arrow import map_rows
from quartier.llm.groups import components
from quartier.llm.words import WordHashes, mix, shingles, split
from quartier.session import cut_lineage, drop_kept

WIDTH = 5
SKETCH = 128
#: Standard deviations that a linked pair's count of shared retained values is allowed to fall below its mean.
DEVIATIONS = 5.0
#: Classes in which retained values are counted for the order of rarity.
RARITY = 1 << 18
#: Pivots that a class is verified against before its lists are looked through.
TRIED = 3
#: Lists of more members than this are worked on in tiles of about so many.
SHORT = 48
TILE = 512
TILE_VALUES = 1 << 21
#: Pairs of one class that are verified in one slice, and members of a list that meet its pivots in one part, on average.
SLICE = 64
PART = 256


def shingle_set(text: str | None, hashes: WordHashes, width: int = WIDTH) -> np.ndarray:
    """The set of a text, ascending: 63-bit hashes of its shingles, A-Z lowered."""
    return np.unique(shingles(hashes.of(split(text, lower=True)), width) >> np.uint64(1))


def set_key(values: np.ndarray) -> int:
    """A key of a set: equal for equal sets, different for others but for a chance of 2 ** -64."""
    total = int(mix(values ^ np.uint64(0x9E3779B97F4A7C15)).sum()) ^ (len(values) * 0x9E3779B97F4A7C15)
    return int(np.array(total % 2**64, dtype=np.uint64).view(np.int64))


def _deviation(sketch: int, union: np.ndarray | float, percent: int) -> np.ndarray | float:
    """Deviation of the count of common values among the ``sketch`` least of a union, at the threshold."""
    share = percent / 100
    return np.sqrt(sketch * share * (1 - share) * np.maximum(0.0, 1 - sketch / union))


def shared_at_least(n: int, percent: int, sketch: int = SKETCH) -> int:
    """Retained values that a set of ``n`` shares at least with the sketch of any set of similarity ``percent``."""
    exact = -(-percent * n // 100)
    sampled = percent / 100 * sketch - DEVIATIONS * float(_deviation(sketch, max(1.0, 100 * n / percent), percent))
    return max(1, min(exact, int(np.floor(sampled))))


def similar_enough(common: int, a: int, b: int, percent: int) -> bool:
    return 100 * common >= percent * (a + b - common)


def maybe_similar(a: bytes, b: bytes, n_a: int, n_b: int, percent: int, sketch: int = SKETCH) -> float | None:
    """The similarity in the union's sketch, unless it rules a link out; exact where both sketches are whole sets."""
    left, right = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    both = np.intersect1d(left, right, assume_unique=True)
    if n_a <= sketch and n_b <= sketch:
        return len(both) / (n_a + n_b - len(both)) if similar_enough(len(both), n_a, n_b, percent) else None
    union = np.union1d(left, right)[:sketch]
    found = int(np.searchsorted(both, union[-1], side="right")) if len(union) else 0
    most = 100 * min(n_a, n_b) / percent  # the union of a similar pair is no larger
    least = percent / 100 * len(union) - DEVIATIONS * float(_deviation(len(union), max(most, 1.0), percent))
    return found / len(union) if found >= least else None


def sketches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """(doc_id, text_hash, n, cid, sketch) of every row: the size of its set, the key of the set, its sketch."""

    def work():
        hashes = WordHashes()

        def step(ids: list, marks: list, texts: list) -> Iterator[tuple]:
            for key, mark, text in zip(ids, marks, texts):
                own = shingle_set(text, hashes, width)
                yield key, mark, len(own), set_key(own), own[:SKETCH].tobytes()

        return step

    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).cast("long"), F.xxhash64(text), text)
    return map_rows(rows, "doc_id long, text_hash long, n long, cid long, sketch binary", work)


def _rarity(classes: DataFrame) -> np.ndarray:
    """How many retained values fall in each of ``RARITY`` classes of values: an array of that fixed size."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(RARITY, dtype=np.int64)
        for batch in batches:
            values = np.frombuffer(b"".join(batch.column(0).to_pylist()), np.uint64) % np.uint64(RARITY)
            total += np.bincount(values.astype(np.int64), minlength=RARITY)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["place", "n"])

    counts = classes.select("sketch").mapInArrow(count, "place long, n long").groupBy("place").agg(F.sum("n").alias("n"))
    found = counts.toPandas()
    out = np.zeros(RARITY, dtype=np.int64)
    out[found.place.to_numpy()] = found.n.to_numpy()
    return out


def _lists(classes: DataFrame, rarity: np.ndarray, percent: int) -> DataFrame:
    """(value, cid, n, common): each class in the inverted lists of its rarest retained values.

    ``common`` says how common its retained values are altogether: in a group of edited copies, the original has most.
    """
    rank = np.unique(rarity, return_inverse=True)[1].astype(np.int32)
    weight = np.log1p(rarity)

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 2048):
                cids, sizes, raw = (c.to_pylist() for c in batch.slice(start, 2048).columns)
                values, counts, common = [], [], []
                for n, sketch in zip(sizes, raw):
                    own = np.frombuffer(sketch, np.uint64)
                    place = (own % np.uint64(RARITY)).astype(np.int64)
                    common.append(weight[place].mean())
                    first = np.lexsort((own, rank[place]))
                    values.append(own[first[: len(own) - shared_at_least(n, percent) + 1]])
                    counts.append(len(values[-1]))
                columns = [np.concatenate(values).view(np.int64), np.repeat(cids, counts), np.repeat(sizes, counts)]
                arrays = [*(pa.array(c, pa.int64()) for c in columns), pa.array(np.repeat(common, counts))]
                yield pa.RecordBatch.from_arrays(arrays, ["value", "cid", "n", "common"])

    return classes.select("cid", "n", "sketch").mapInArrow(expand, "value long, cid long, n long, common double")


def _near_sizes(a: str, b: str, percent: int) -> Column:
    return (100 * F.least(a, b)) >= (percent * F.greatest(a, b))


def _filtered(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b, n_a, n_b, estimate) whose sketches leave the link open."""
    own = classes.select("cid", "sketch")
    joined = pairs.join(own.toDF("a", "sketch_a"), "a").join(own.toDF("b", "sketch_b"), "b")

    def work():
        def step(a: list, b: list, n_a: list, n_b: list, left: list, right: list) -> Iterator[tuple]:
            for row in zip(a, b, n_a, n_b, left, right):
                estimate = maybe_similar(row[4], row[5], row[2], row[3], percent)
                if estimate is not None:
                    yield *row[:4], estimate

        return step

    columns = joined.select("a", "b", "n_a", "n_b", "sketch_a", "sketch_b")
    return map_rows(columns, "a long, b long, n_a long, n_b long, estimate double", work)


def _dealt(pairs: DataFrame, sets: DataFrame, end: str) -> DataFrame:
    """``pairs`` with the set of their end ``end``; a class with many pairs has its set in as many slices of ``SLICE`` pairs."""
    slices = pairs.groupBy(end).agg(F.ceil(F.count(F.lit(1)) / SLICE).alias("_slices"))
    sliced = pairs.join(slices, end).withColumn("_slice", F.pmod(F.xxhash64("a", "b"), "_slices"))
    number = F.explode(F.sequence(F.lit(0).cast("long"), F.col("_slices") - 1)).alias("_slice")
    own = sets.toDF(end, f"set_{end}").join(slices, end).select(end, f"set_{end}", number)
    return sliced.drop("_slices").join(own, [end, "_slice"]).drop("_slice")


def _verified(pairs: DataFrame, texts: Callable[[DataFrame], DataFrame], percent: int) -> DataFrame:
    """Links (a, b) among ``pairs``, kept: similarity of the full sets. Pairs of small sets are exact already."""
    small = F.greatest("n_a", "n_b") <= SKETCH
    large = cut_lineage(pairs.where(~small).select("a", "b"))
    sets = texts(large.select(F.col("a").alias("cid")).union(large.select("b")).distinct())
    joined = _dealt(_dealt(large, sets, "a"), sets, "b")

    def work():
        def step(a: list, b: list, left: list, right: list) -> Iterator[tuple]:
            for one, other, x, y in zip(a, b, left, right):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                if similar_enough(len(np.intersect1d(x, y, assume_unique=True)), len(x), len(y), percent):
                    yield one, other

        return step

    links = map_rows(joined.select("a", "b", "set_a", "set_b"), "a long, b long", work)
    links = cut_lineage(links.union(pairs.where(small).select("a", "b")))
    drop_kept(large, sets)
    return links


def _labelled(lists: DataFrame, labels: DataFrame) -> DataFrame:
    return lists.join(labels, "cid", "left").withColumn("comp", F.coalesce("comp", "cid"))


def classes_and_links(
    docs: DataFrame, percent: int, id_col: str, text_col: str, width: int
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows with their classes, classes with their least id, and labels of the classes that are linked with others; all kept."""
    sketched = cut_lineage(sketches(docs, id_col, text_col, width))
    rows = cut_lineage(sketched.drop("sketch"))
    first = F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("text_hash")))
    reps = rows.where("n > 0").groupBy("cid").agg(first.alias("_own"))
    reps = cut_lineage(reps.select("cid", F.col("_own.doc_id").alias("rep"), F.col("_own.text_hash").alias("rep_hash")))
    classes = sketched.where("n > 0").groupBy("cid").agg(F.min("n").alias("n"), F.first("sketch").alias("sketch"))
    classes = cut_lineage(classes)
    drop_kept(sketched)

    def texts(wanted: DataFrame) -> DataFrame:
        """(cid, set) of the wanted classes, kept, from a text of each class."""
        text = F.col(text_col).cast("string")
        source = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("hash"), text.alias("text"))
        chosen = wanted.join(reps, "cid")
        same = source["id"].eqNullSafe(chosen["rep"]) & (source["hash"] == chosen["rep_hash"])
        joined = source.join(chosen, same).select("cid", "text").dropDuplicates(["cid"])

        def work():
            hashes = WordHashes()

            def step(cids: list, own: list) -> Iterator[tuple]:
                for cid, text in zip(cids, own):
                    found = shingle_set(text, hashes, width)
                    if set_key(found) == cid:
                        yield cid, found.tobytes()

            return step

        return cut_lineage(map_rows(joined, "cid long, set binary", work))

    # Most values are in one list only: they are counted first, in small rows, and go no further.
    lists = _lists(classes, _rarity(classes), percent)
    counts = lists.groupBy("value").agg(F.ceil(F.count(F.lit(1)) / PART).alias("parts"), F.count(F.lit(1)).alias("m"))
    shared = cut_lineage(lists.join(counts.where("m > 1").drop("m"), "value"))
    own = F.struct("cid", "n")
    hub, other = F.max_by(own, F.struct("common", "cid")), F.min_by(own, F.xxhash64("value", "cid"))
    pivots = shared.groupBy("value", "parts").agg(F.array(hub, other).alias("pivots"))
    # A long list's members are dealt over parts to meet its pivots.
    number = F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("_part")
    part = F.pmod(F.xxhash64("cid"), "parts").alias("_part")
    lists = shared.select("value", "cid", "n", part).join(pivots.select("value", "pivots", number), ["value", "_part"])

    first = lists.select("cid", "n", F.explode("pivots").alias("p")).where("cid <> p.cid").where(_near_sizes("n", "p.n", percent))
    first = first.select(F.col("cid").alias("a"), F.col("p.cid").alias("b"), F.col("n").alias("n_a"), F.col("p.n").alias("n_b"))
    met = _filtered(first.distinct(), classes, percent)
    # Each class's likeliest links join most of them; what stays apart meets again below.
    order = F.row_number().over(Window.partitionBy("a").orderBy(F.desc("estimate"), "b"))
    best = cut_lineage(met.withColumn("_order", order).where(F.col("_order") <= TRIED))
    links = _verified(best, texts, percent)
    labels = components(links)

    told = _labelled(shared.select("value", "cid", "n"), labels)
    opened = told.groupBy("value").agg(F.count(F.lit(1)).alias("m"), F.min("comp").alias("x"), F.max("comp").alias("y"))
    told = cut_lineage(told.join(opened.where("x < y").select("value", "m"), "value"))
    drop_kept(shared, best)
    left, right = _sides(told.where(F.col("m") <= SHORT))
    pairs = left.join(right, "value").where("comp_a < comp_b").where(_near_sizes("n_a", "n_b", percent))
    of_short = _filtered(pairs.select("a", "b", "n_a", "n_b").distinct(), classes, percent)
    rest = cut_lineage(of_short)
    more = _long_lists(told.where(F.col("m") > SHORT), classes, texts, percent).union(_verified(rest, texts, percent))
    drop_kept(told, classes)
    return rows, reps, components(links.union(more))


def _candidates(group: pd.DataFrame, sketch: list[np.ndarray], percent: int) -> Iterator[tuple[int, int]]:
    """Places of the pairs of one meeting whose sketches leave a link open and that no other list reports.

    Shared values are counted for all pairs by products of indicator matrices over the values that two members have. A pair
    is reported by one list only: that of the least value both are listed under.
    """
    value, same = int(group["value"].iloc[0]), group["lo"].iloc[0] == group["hi"].iloc[0]
    first = np.flatnonzero(group["t"] == group["lo"])
    second = first if same else np.flatnonzero(group["t"] == group["hi"])
    cids, sizes, comps = (group[c].to_numpy() for c in ("cid", "n", "comp"))
    least = np.array([shared_at_least(int(n), percent) for n in sizes])
    owner = np.repeat(np.arange(len(group)), [len(own) for own in sketch])
    _, code, count = np.unique(np.concatenate(sketch), return_inverse=True, return_counts=True)
    shared_by_two = count[code] > 1
    owner, code = owner[shared_by_two], (np.cumsum(count > 1) - 1)[code[shared_by_two]]
    shared = np.zeros((len(first), len(second)), dtype=np.float32)
    for start in range(0, int((count > 1).sum()), 4096):
        here = (code >= start) & (code < start + 4096)
        block = np.zeros((len(group), 4096), dtype=np.float32)
        block[owner[here], code[here] - start] = 1
        shared += block[first] @ block[second].T
    open_ = shared >= np.maximum(least[first][:, None], least[second][None, :])
    open_ &= comps[first][:, None] != comps[second][None, :]
    small, large = np.minimum(sizes[first][:, None], sizes[second][None, :]), np.maximum(sizes[first][:, None], sizes[second][None, :])
    open_ &= 100 * small >= percent * large
    listed = [set(own) for own in group["listed"]]
    for p, q in zip(*(place.tolist() for place in np.nonzero(open_))):
        p, q = int(first[p]), int(second[q])
        if same and cids[p] >= cids[q] or min(listed[p] & listed[q]) != value:
            continue
        if maybe_similar(sketch[p].tobytes(), sketch[q].tobytes(), int(sizes[p]), int(sizes[q]), percent) is not None:
            yield p, q


def _long_lists(lists: DataFrame, classes: DataFrame, texts: Callable[[DataFrame], DataFrame], percent: int) -> DataFrame:
    """Links (a, b), kept, among the members of long lists that join all that are linked, without a row for any pair.

    A list's members are dealt into tiles, and two tiles meet in one task. The members of pairs that sketches leave open meet
    once more with their full sets; what comes out are fewer links than members.
    """
    listed = lists.groupBy("cid").agg(F.collect_set("value").alias("listed"))  # as many as a sketch has values, at most
    rows = lists.join(listed, "cid").join(classes.select("cid", "sketch"), "cid")
    # Tiles hold so many members, and so many values of their full sets, on average.
    total = lists.groupBy("value").agg(F.ceil(F.greatest(F.count(F.lit(1)) / TILE, F.sum("n") / TILE_VALUES)).alias("tiles"))
    rows = rows.join(total, "value").withColumn("t", F.pmod(F.xxhash64("cid"), "tiles"))
    other = F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)
    rows = rows.withColumn("u", F.explode(other)).withColumns({"lo": F.least("t", "u"), "hi": F.greatest("t", "u")})
    keys, told = ["value", "lo", "hi"], ["t", "cid", "n", "comp", "listed"]

    def sieve(group: pd.DataFrame) -> pd.DataFrame:
        sketch = [np.frombuffer(own, np.uint64) for own in group["sketch"]]
        kept = {place for pair in _candidates(group, sketch, percent) for place in pair}
        return group.iloc[sorted(kept)][keys + told]

    def verify(group: pd.DataFrame) -> pd.DataFrame:
        own = [np.frombuffer(raw, np.uint64) for raw in group["set"]]
        root, links = list(range(len(own))), []

        def top(place: int) -> int:
            while root[place] != place:
                root[place] = place = root[root[place]]
            return place

        for p, q in _candidates(group, [x[:SKETCH] for x in own], percent):
            x, y = top(p), top(q)
            if x != y and similar_enough(len(np.intersect1d(own[p], own[q], assume_unique=True)), len(own[p]), len(own[q]), percent):
                root[max(x, y)] = min(x, y)
                links.append((int(group["cid"].iloc[p]), int(group["cid"].iloc[q])))
        return pd.DataFrame(links, columns=["a", "b"])

    shown = rows.select(*keys, *told, "sketch")
    schema = "value long, lo long, hi long, t long, cid long, n long, comp long, listed array<long>"
    tasks = int(lists.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    open_ = cut_lineage(shown.repartition(tasks, *keys).groupBy(*keys).applyInPandas(sieve, schema))
    sets = texts(open_.select("cid").distinct())
    met = open_.join(sets, "cid").select(*keys, *told, "set")
    links = cut_lineage(met.repartition(tasks, *keys).groupBy(*keys).applyInPandas(verify, "a long, b long"))
    drop_kept(open_, sets)
    return links


def _sides(lists: DataFrame) -> tuple[DataFrame, DataFrame]:
    sides = []
    for end in ("a", "b"):
        renamed = [F.col("cid").alias(end), F.col("n").alias(f"n_{end}"), F.col("comp").alias(f"comp_{end}")]
        sides.append(lists.select("value", *renamed))
    return sides[0], sides[1]


def near_duplicates(
    docs: DataFrame, percent: int = 85, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH,
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept, text_hash) of every row of ``docs``, which is read when called.

    Documents whose sets have a similarity of ``percent`` / 100 or more are linked; ``component_id`` is the least id that can
    be reached over links, and the row that has it is kept. A text of fewer words than a shingle is one shingle. Texts
    without words, null or empty, are linked with nothing and kept. Rows with one id and equal sets are all kept or all
    not. Null ids count in no minimum; where a component has no other, its rows have a null ``component_id`` and are kept.
    """
    rows, reps, labels = classes_and_links(docs, percent, id_col, text_col, width)
    named = _labelled(reps.select("cid", "rep"), labels)
    least = named.groupBy("comp").agg(F.min("rep").alias("component_id"))
    # Classes are as many as distinct texts; a class with many rows is split by the adaptive skew join.
    of_class = named.join(least, "comp").select("cid", "component_id")
    out = rows.join(of_class, "cid", "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select(
        "doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"), "text_hash",
    )
