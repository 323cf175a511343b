"""Packing of token sequences into windows of one length: best-fit decreasing.

Every document is cut into full windows and one remainder. Full windows need no search. Remainders are spread over blocks of
about ``BLOCK`` by a hash; in each block they are taken from the longest to the shortest, and a segment tree over remaining
capacities gives the tightest open window that a remainder fits in. Only lengths move between tasks. A block of thousands
of remainders ends with a handful of windows that are not full, so splitting into blocks costs next to nothing.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quartier.llm.arrow import map_rows
from quartier.llm.encoding import task_encoder
from quartier.session import cut_lineage

WINDOW = 1024
#: Remainders packed together, on average.
BLOCK = 16_384

_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, _spread long"
_PLACED = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def cut_documents(
    docs: DataFrame, tokenizer: str, end_id: int = 0, window: int = WINDOW, id_col: str = "doc_id",
    text_col: str = "text", keep_ids: bool = False,
) -> DataFrame:
    """Pieces of at most ``window`` ids: full windows, then the remainder, of each document's ids and its end id.

    With ``keep_ids`` the ids come along, as little-endian unsigned 32-bit numbers. A null or empty text has the end id
    only. Rows with the same id are documents of their own.
    """
    end = np.array([end_id], dtype="<u4").tobytes()

    def work():
        encoder = task_encoder(tokenizer)

        def step(keys: list, texts: list) -> Iterator[tuple]:
            for key, ids in zip(keys, encoder.encode(texts)):
                ids += end
                total, spread = len(ids) // 4, zlib.crc32(ids)
                for start in range(0, total, window):
                    piece = ids[4 * start : 4 * (start + window)]
                    row = key, start, len(piece) // 4, zlib.crc32(piece), total, spread
                    yield (*row, piece) if keep_ids else row

        return step

    rows = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    return map_rows(rows, _PIECES + (", ids binary" if keep_ids else ""), work)


class OpenWindows:
    """Windows by remaining capacity, under a segment tree that counts them."""

    def __init__(self, window: int):
        self.leaves = 1 << window.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.open: list[list[int]] = [[] for _ in range(window + 1)]

    def put(self, capacity: int, which: int) -> None:
        self.open[capacity].append(which)
        self._add(capacity, 1)

    def _add(self, capacity: int, n: int) -> None:
        node = capacity + self.leaves
        while node:
            self.count[node] += n
            node >>= 1

    def take_tightest(self, length: int) -> tuple[int, int] | None:
        """The open window of least capacity of at least ``length``, no longer open; its capacity and number."""
        node = length + self.leaves
        if not self.count[node]:
            while node > 1 and (node & 1 or not self.count[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if self.count[2 * node] else 2 * node + 1
        capacity = node - self.leaves
        self._add(capacity, -1)
        return capacity, self.open[capacity].pop()


def best_fit(lengths: list[int], window: int) -> tuple[list[int], list[int]]:
    """Window number and offset of each of ``lengths``, which must come longest first."""
    windows, number, offset, made = OpenWindows(window), [], [], 0
    for length in lengths:
        found = windows.take_tightest(length)
        capacity, which = found or (window, made)
        made += found is None
        number.append(which)
        offset.append(window - capacity)
        if capacity > length:
            windows.put(capacity - length, which)
    return number, offset


def place(pieces: DataFrame, window: int = WINDOW) -> DataFrame:
    """Pieces with ``sequence_id`` and ``offset``; offsets are gapless from 0 in each sequence.

    ``pieces`` is read twice, so it should be a table. Sequence ids are unique, not consecutive: the block's number is in
    the upper half. The blocks' number follows from the count of pieces, so a block has the same load at any size.
    """
    blocks = max(1, round(pieces.count() / BLOCK))
    spread = F.pmod(F.xxhash64("doc_id", "start", "_spread"), F.lit(blocks))

    def pack(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values(["length", "doc_id", "start", "ids_crc32"], ascending=[False, True, True, True])
        number, offset = best_fit(block["length"].tolist(), window)
        first = int(block["_block"].iloc[0]) << 32
        placed = block.assign(sequence_id=np.array(number, dtype="int64") + first, offset=offset)
        return placed.drop(columns=["_block", "_spread"])

    return pieces.withColumn("_block", spread).groupBy("_block").applyInPandas(pack, _PLACED)


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int = 0, window: int = WINDOW, **columns: str) -> DataFrame:
    """All pieces of ``docs`` and where each lies. Encodes the texts when called and keeps the pieces' lengths as a table.

    Null and repeated ids are kept. An empty table gives an empty result; further columns are not looked at.
    """
    pieces = cut_lineage(cut_documents(docs, tokenizer, end_id, window, **columns))
    return place(pieces, window)


def sequences(pieces_with_ids: DataFrame, placed: DataFrame, window: int = WINDOW, pad_id: int = 0) -> DataFrame:
    """(sequence_id, ids) of each window, padded: the pieces' ids joined to their places and put in order."""
    keys = ["doc_id", "start", "ids_crc32", "length"]
    ids = pieces_with_ids.select(*keys, "ids").dropDuplicates(keys)
    same = [F.col(f"p.{k}").eqNullSafe(F.col(f"i.{k}")) for k in keys]
    rows = placed.alias("p").join(ids.alias("i"), same).select("sequence_id", "offset", "ids")
    pad = np.array([pad_id], dtype="<u4").tobytes()

    @F.udf("array<long>")
    def unpack(joined: bytes) -> list[int]:
        return np.frombuffer(joined + pad * (window - len(joined) // 4), "<u4").tolist()

    ordered = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    whole = F.aggregate(ordered, F.lit(b""), lambda text, piece: F.concat(text, piece["ids"]))
    return rows.groupBy("sequence_id").agg(whole.alias("_ids")).select("sequence_id", unpack("_ids").alias("ids"))
