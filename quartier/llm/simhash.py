"""Near-duplicates by SimHash fingerprints, told apart by tables of distances to reference fingerprints.

Fingerprint. A bit is 1 where more than half the hashes of a text's three-word shingles have it, repeats included.
Documents with one fingerprint are a class; all work is done on classes.

Distance tables. Of two fingerprints within ``MOST`` bits, the distances to any third differ by ``MOST`` at most. Each
fingerprint's distances to ``PIVOTS`` reference fingerprints (drawn from the table) are computed once for a list, and a pair
is discarded as soon as one pair of distances differs by more. Survivors are verified bit by bit.

Lists. Distance tables alone would have to be compared for all pairs. Therefore the bits are cut into six blocks: two
fingerprints within three bits agree in three blocks at least, so they meet in one of 20 lists, those of the fingerprints that
agree in the same three blocks. A long list is dealt into tiles that meet in pairs. What comes out of a meeting are links that
join its members to components, fewer than it has members, not its pairs; pairs joined already are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quartier.llm.arrow import map_rows
from quartier.llm.groups import components
from quartier.llm.words import split
from quartier.session import cut_lineage

WIDTH = 3
MOST = 3
HASH_SEED = 42
PIVOTS = 32
#: Widths of the blocks of bits; ``MOST`` blocks of a pair may differ, the others agree.
BLOCKS = (11, 11, 11, 11, 10, 10)
#: Members of a list that meet in one task, and rows that a task looks at together.
TILE = 2048
STEP = 32_768
#: Parts that the rows of one fingerprint, and the members of one list, are dealt over when they are joined.
DEALT = 32
SEED = 11


def _masks() -> list[int]:
    ends = np.cumsum(BLOCKS)
    blocks = [((1 << width) - 1) << int(end - width) for width, end in zip(BLOCKS, ends)]
    return blocks


_BLOCK_MASKS = _masks()
_CHOICES = list(combinations(range(len(BLOCKS)), len(BLOCKS) - MOST))


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def fingerprint(text: str | None, width: int = WIDTH) -> int:
    """The unsigned fingerprint of a text, A-Z lowered; with fewer words than ``width`` of the whole sequence, 0 of none."""
    words = split(text, lower=True)
    if not words:
        return 0
    width = min(width, len(words))
    runs = zip(*(islice(words, k, None) for k in range(width)))
    total, counts = len(words) - width + 1, np.zeros(64, dtype=np.int64)
    while some := [xxhash.xxh64_intdigest(b" ".join(run), HASH_SEED) for run in islice(runs, 65_536)]:
        bits = np.unpackbits(np.array(some, dtype="<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > total, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """(doc_id, fp) of every row: the fingerprint as a signed long of the same bits."""

    def work():
        def step(ids: list, texts: list) -> Iterator[tuple]:
            for key, text in zip(ids, texts):
                yield key, _signed(fingerprint(text, width))

        return step

    rows = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    return map_rows(rows, "doc_id long, fp long", work)


def _first_choice() -> np.ndarray:
    """For each set of agreeing blocks (as bits), the first choice of blocks among them."""
    out = np.full(1 << len(BLOCKS), -1, dtype=np.int64)
    for code in range(len(out)):
        for number, choice in enumerate(_CHOICES):
            if all(code >> block & 1 for block in choice):
                out[code] = number
                break
    return out


_FIRST = _first_choice()


def may_link(table: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which of the pairs (``a``, ``b``), places in ``table``, no reference fingerprint tells apart."""
    alive = np.arange(len(a))
    for start in range(0, table.shape[1], 8):
        block = table[:, start : start + 8]
        apart = np.abs(block[a[alive]] - block[b[alive]]).max(axis=1, initial=0)
        alive = alive[apart <= MOST]
    return alive


def meet(group: np.ndarray, choice: np.ndarray, tile: np.ndarray, fps: np.ndarray, pivots: np.ndarray) -> list[tuple[int, int]]:
    """Links that join the members of each group; rows of one ``group`` follow one another.

    In a group of two tiles (``tile`` 0 or 1) only members of different ones are compared; in others ``tile`` is -1. A pair is left to
    the first list that has it.
    """
    table = np.bitwise_count(fps[:, None] ^ pivots[None, :]).astype(np.int8)
    root, links = np.arange(len(fps)), []
    left, step = np.arange(len(fps)), 0
    while True:
        step += 1
        left = left[: np.searchsorted(left, len(fps) - step)]
        left = left[group[left] == group[left + step]]
        if not len(left):
            return links
        own = left[(root[left] != root[left + step]) & ((tile[left] < 0) | (tile[left] != tile[left + step]))]
        own = own[may_link(table, own, own + step)]
        differ = fps[own] ^ fps[own + step]
        near = np.bitwise_count(differ) <= MOST
        own, differ = own[near], differ[near]
        agree = sum(((differ & np.uint64(mask)) == 0).astype(np.int64) << k for k, mask in enumerate(_BLOCK_MASKS))
        own = own[_FIRST[agree] == choice[own]]
        for a in own.tolist():
            b, x, y = a + step, a, a + step
            while root[x] != x:
                x = root[x]
            while root[y] != y:
                y = root[y]
            if x != y:
                root[max(x, y)] = min(x, y)
                links.append((a, b))
        if len(own):
            while not np.array_equal(root, further := root[root]):
                root = further


def _links(classes: DataFrame) -> DataFrame:
    """Links (a, b) between fingerprints that join all that are within ``MOST`` bits of one another."""
    spark = classes.sparkSession
    drawn = classes.orderBy(F.xxhash64(F.lit(SEED), "fp"), "fp").limit(PIVOTS).collect()
    pivots = np.array([r.fp for r in drawn], dtype=np.int64).view(np.uint64)
    masks = [_signed(sum(_BLOCK_MASKS[b] for b in choice)) for choice in _CHOICES]
    lists = classes.select("fp", F.posexplode(F.array(*(F.lit(m).cast("long") for m in masks))).alias("choice", "mask"))
    lists = lists.select("fp", "choice", F.col("fp").bitwiseAND(F.col("mask")).alias("agreed"))
    heads = lists.groupBy("choice", "agreed").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
    # A list's members are dealt over parts for the join, for one list may hold a third of all fingerprints.
    heads = heads.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(DEALT - 1))))
    dealt = lists.withColumn("part", F.pmod(F.xxhash64("fp"), F.lit(DEALT)).cast("int"))
    rows = dealt.join(heads, ["choice", "agreed", "part"])
    tiles = F.ceil(F.col("m") / TILE)
    rows = rows.withColumn("t", F.pmod(F.xxhash64(F.lit(SEED), "fp"), tiles)).withColumn(
        "u", F.explode(F.sequence(F.lit(0).cast("long"), tiles - 1))
    )
    lo, hi = F.least("t", "u"), F.greatest("t", "u")
    side = F.when(lo == hi, -1).when(F.col("t") == lo, 0).otherwise(1).cast("int")
    rows = rows.select("choice", "agreed", lo.alias("lo"), hi.alias("hi"), side.alias("side"), "fp")
    keys = ["choice", "agreed", "lo", "hi"]
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartition(tasks, *keys).sortWithinPartitions(*keys, "fp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(parts: list[list[np.ndarray]], last: bool) -> tuple[list[np.ndarray], pa.RecordBatch]:
            columns = [np.concatenate(c) for c in zip(*parts)]
            new = np.zeros(len(columns[0]), dtype=bool)
            for c in columns[:4]:
                new[1:] |= c[1:] != c[:-1]
            end = len(new) if last else int(np.flatnonzero(new)[-1]) if new.any() else 0  # the last group may go on
            fps = columns[5][:end].view(np.uint64)
            links = meet(np.cumsum(new[:end]), columns[0][:end], columns[4][:end], fps, pivots)
            a, b = (columns[5][[pair[k] for pair in links]] if links else np.zeros(0, np.int64) for k in (0, 1))
            return [c[end:] for c in columns], pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

        parts: list[list[np.ndarray]] = []
        held = 0
        for batch in batches:
            parts.append([c.to_numpy(zero_copy_only=False) for c in batch.columns])
            held += batch.num_rows
            if held >= STEP:
                rest, out = found(parts, last=False)
                parts, held = [rest], len(rest[0])
                yield out
        if parts:
            yield found(parts, last=True)[1]

    return rows.mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row of ``docs``, which is read once, when called.

    ``fingerprint`` is 16 lowercase hex digits. Rows whose fingerprints differ in ``MOST`` bits or fewer are linked;
    ``component_id`` is the least id that can be reached over links. Texts without words, null or empty, have fingerprint
    zero and are linked like any other. Repeated rows are rows of one class. Null ids count in no minimum; where a
    component has no other, its ``component_id`` is null. An empty table gives an empty result.
    """
    rows = cut_lineage(fingerprints(docs, id_col, text_col, width))
    # Rows of one fingerprint are dealt over parts, so that no join has more than DEALT rows of a class on one key.
    part = F.pmod(F.xxhash64("doc_id"), F.lit(DEALT)).cast("int")
    rows = rows.withColumn("part", part)
    parts = cut_lineage(rows.groupBy("fp", "part").agg(F.min("doc_id").alias("least")))
    classes = cut_lineage(parts.groupBy("fp").agg(F.min("least").alias("least")))
    labels = components(_links(classes)).withColumnRenamed("cid", "fp")
    named = cut_lineage(classes.join(labels, "fp", "left").withColumn("comp", F.coalesce("comp", "fp")))
    ids = named.join(named.groupBy("comp").agg(F.min("least").alias("component_id")), "comp").select("fp", "component_id")
    of_parts = parts.select("fp", "part").join(ids, "fp")
    return rows.join(of_parts, ["fp", "part"]).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
