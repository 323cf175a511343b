"""SentencePiece encoding and decoding, with giant documents cut into chunks that are worked on independently.

The vocabulary's encoding is byte-pair merging, and the library's ids are what counts, so the max-plus scan is not over
piece scores (their best sum is another segmentation) but over the rule that makes merging a path problem: an encoding is
the one chain of pieces in which every neighbouring pair, merged by itself, stays as it is. A chain weighs the sum of its
pairs' weights, 0 for a pair that stays and minus infinity for another, so the best chain is the encoding.

No piece crosses from a visible character to a space, so a text falls into words, whose ids a task remembers. A document
longer than ``CHUNK`` is cut. Where a word starts nearby, the cut is put there and has one boundary state. Elsewhere (long runs
without a space) a cut's states are the pieces that can lie across or end at it. Each chunk gives a matrix of the weights
from each state at its start to each state at its end; matrices are combined by the max-plus product, which is associative,
to find the state at every cut; then each chunk is traced by itself between its two states.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pandas as pd
import regex
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quartier.llm.arrow import kept_by_worker, map_rows
from quartier.session import cut_lineage

#: Characters of a chunk, and how far before a cut a word's start is looked for.
CHUNK = 16_384
NEARBY = 1024
#: Words and pairs remembered by a task before it starts anew.
MEMO = 400_000
SPACE = "▁"
_WORDS = regex.compile(r" +[^ ]*")

State = tuple[int, int]  # first and end of a piece, in characters of the whole text


class Pieces:
    """A byte-pair vocabulary with byte fallback, a space before the text, and spaces shown as one character."""

    def __init__(self, path: str):
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        size = range(self.library.get_piece_size())
        special = {i for i in size if self.library.is_control(i) or self.library.is_unknown(i) or self.library.is_byte(i)}
        names = [self.library.id_to_piece(i) for i in size]
        self.ids = {names[i]: i for i in size if i not in special}
        self.score = {names[i]: self.library.get_score(i) for i in size if i not in special}
        self.of_byte = [self.library.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.longest = max(map(len, self.ids))
        self.text = [names[i].replace(SPACE, " ").encode() if i not in special else b"" for i in size]
        for b, i in enumerate(self.of_byte):
            self.text[i] = bytes([b])
        self.memo: dict[str, bytes] = {"": np.array([self.ids[SPACE]], dtype="<u4").tobytes()}  # a space at the end
        self.pairs: dict[tuple[str, str], bool] = {}

    def words(self, text: str) -> list[str]:
        """The text in words, each with the spaces before it but the first, which is left out."""
        parts = text.replace(SPACE, " ").split(" ")
        if "" in parts:
            return [w[1:] for w in _WORDS.findall(" " + text.replace(SPACE, " "))] if text else []
        return parts

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit numbers."""
        split = [self.words(text) for text in texts]
        met = set().union(*split)
        new = [w for w in met if w not in self.memo]
        if len(self.memo) + len(new) > MEMO:
            self.memo = {w: ids for w, ids in self.memo.items() if len(w) < 8}
            new = [w for w in met if w not in self.memo]
        found = self.library.encode(new, num_threads=1)
        self.memo.update((w, np.array(ids, dtype="<u4").tobytes()) for w, ids in zip(new, found))
        return [b"".join([self.memo[w] for w in words]) for words in split]

    def decode(self, ids: bytes) -> str:
        """The text of ids; bytes that are no text are replaced. The space put before the text is taken away."""
        raw = b"".join([self.text[i] for i in np.frombuffer(ids, "<u4").tolist()])
        return raw.removeprefix(b" ").decode("utf-8", "replace")

    def own_ids(self, piece: str) -> list[int]:
        return [self.ids[piece]] if piece in self.ids else [self.of_byte[b] for b in piece.encode()]

    def stays(self, left: str, right: str) -> bool:
        """Whether merging the characters of both ends in these two pieces."""
        key = (left, right)
        if key not in self.pairs:
            if len(self.pairs) > MEMO:
                self.pairs.clear()
            parts = [*left, *right]
            while len(parts) > 1:
                score, at = max((self.score.get(a + b, -1e30), -k) for k, (a, b) in enumerate(zip(parts, parts[1:])))
                if score == -1e30:
                    break
                parts[-at : 2 - at] = [parts[-at] + parts[1 - at]]
            self.pairs[key] = parts == [left, right]
        return self.pairs[key]

    def is_piece(self, text: str) -> bool:
        return text in self.ids or len(text) == 1

    def states(self, text: str, cut: int) -> list[State]:
        """Pieces that hold the character before ``cut`` and end at it or beyond."""
        near = range(max(0, cut - self.longest), cut)
        return [
            (a, b) for a in near for b in range(cut, min(len(text), a + self.longest) + 1) if self.is_piece(text[a:b])
        ]

    def chains(self, text: str, start: State | None, end: int) -> dict[int, int]:
        """For each place that a chain from ``start`` can end at, up to beyond ``end``: where its last piece starts."""
        at = start[1] if start else 0
        last: dict[int, int] = {at: start[0] if start else -1}
        for stop in range(at + 1, min(len(text), end + self.longest) + 1):
            for first in range(max(at, stop - self.longest), stop):
                if first in last and self.is_piece(text[first:stop]):
                    before = last[first]
                    if before < 0 or self.stays(text[before:first], text[first:stop]):
                        last[stop] = first
                        break
        return last

    def matrix(self, text: str, starts: list[State | None], ends: list[State]) -> np.ndarray:
        """Weights between states: 0 where a chain leads from one to the other, else minus infinity."""
        cut = min((b for _, b in ends), default=0)
        out = np.full((len(starts), len(ends)), -np.inf)
        for row, start in enumerate(starts):
            last = self.chains(text, start, max((b for _, b in ends), default=cut))
            for column, (a, b) in enumerate(ends):
                if start == (a, b) or last.get(b) == a and (start is None or a >= start[1]):
                    out[row, column] = 0
        return out

    def trace(self, text: str, start: State | None, end: State) -> list[int]:
        """Ids of the pieces after ``start`` up to and with ``end``."""
        if start == end:
            return []
        last, pieces, at = self.chains(text, start, end[1]), [], end[1]
        stop = start[1] if start else 0
        while at > stop:
            pieces.append(text[last[at] : at])
            at = last[at]
        return [i for piece in reversed(pieces) for i in self.own_ids(piece)]


def max_plus(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The max-plus product of two matrices."""
    return (a[:, :, None] + b[None, :, :]).max(axis=1)


def find_states(matrices: list[np.ndarray]) -> list[int]:
    """The state at the end of each matrix on the best chain over all of them.

    Products from the left say what reaches a state, products from the right what follows from it.
    """
    left: list[np.ndarray] = []
    for m in matrices:
        left.append(max_plus(left[-1], m) if left else m)
    right = [np.zeros((matrices[-1].shape[1], 1))]
    for m in reversed(matrices[1:]):
        right.append(max_plus(m, right[-1]))
    return [int((a[0] + b[:, 0]).argmax()) for a, b in zip(left, reversed(right))]


def cuts(text: str, chunk: int, nearby: int = NEARBY) -> list[tuple[int, bool]]:
    """Places to cut a text (spaces shown) at, and whether a word starts there."""
    out, at = [], 0
    while len(text) - at > chunk:
        nominal = at + chunk
        clean = nominal
        while clean > max(at, nominal - nearby) and not (text[clean] == SPACE and text[clean - 1] != SPACE):
            clean -= 1
        found = clean > max(at, nominal - nearby)
        at = clean if found else nominal
        out.append((at, found))
    return out


def _chunk_rows(docs: DataFrame, margin: int, chunk: int) -> DataFrame:
    """(row, k, first, text, cut, clean): chunks with ``margin`` characters of their neighbours, of texts over ``chunk``.

    ``first`` is where the text with margins starts, ``cut`` where the chunk ends (its start is the end of the one before).
    """

    def work():
        def step(rows: list, texts: list) -> Iterator[tuple]:
            for row, text in zip(rows, texts):
                shown = SPACE + text.replace(" ", SPACE)
                ends = [*cuts(shown, chunk), (len(shown), True)]
                begin, was_clean = 0, True
                for k, (end, clean) in enumerate(ends):
                    first = max(0, begin - margin)
                    yield row, k, first, begin, end, was_clean, clean, shown[first : end + margin]
                    begin, was_clean = end, clean

        return step

    schema = "row long, k int, first long, begin long, cut long, clean_start boolean, clean boolean, text string"
    return map_rows(docs.select("row", "text"), schema, work)


def _ends(pieces: Pieces, text: str, first: int, begin: int, cut: int, clean_start: bool, clean: bool):
    """States at a chunk's two ends, in characters of ``text``; a clean end's only state is the end itself."""
    start = [(begin - first, begin - first)] if clean_start else pieces.states(text, begin - first)
    stop = [(cut - first, cut - first)] if clean else pieces.states(text, cut - first)
    return start, stop


def _between(pieces: Pieces, text: str, start: State, clean_start: bool, end: State, clean: bool) -> list[int]:
    """Ids from ``start`` to ``end``; from and to a clean cut the words between are encoded as they are."""
    if clean_start and clean:
        inner = text[start[1] + 1 : end[1]].replace(SPACE, " ")
        if not inner:  # a space alone
            return [pieces.ids[SPACE]]
        (ids,) = pieces.encode([inner])
        return np.frombuffer(ids, "<u4").tolist()
    own = text[: end[1]] if clean else text
    if clean:
        last = pieces.chains(own[start[1] :] if clean_start else own, None if clean_start else start, len(own))
        shift = start[1] if clean_start else 0
        return pieces.trace(own[shift:], None if clean_start else start, (last[len(own) - shift], len(own) - shift))
    if clean_start:
        return pieces.trace(own[start[1] :], None, (end[0] - start[1], end[1] - start[1]))
    return pieces.trace(own, start, end)


def _weights(pieces: Pieces, text: str, starts: list[State], clean_start: bool, ends: list[State], clean: bool) -> np.ndarray:
    if clean_start and clean:
        return np.zeros((1, 1))
    own = text[: ends[0][1]] if clean else text
    shift = starts[0][1] if clean_start else 0
    own = own[shift:]
    begin: list[State | None] = [None] if clean_start else [*starts]
    if not clean:
        return pieces.matrix(own, begin, [(a - shift, b - shift) for a, b in ends])
    # Any piece may be the last before a clean cut.
    reached = [len(own) in pieces.chains(own, s, len(own)) for s in begin]
    return np.where(np.array(reached)[:, None], 0.0, -np.inf)


def _giants(docs: DataFrame, model: str, chunk: int) -> DataFrame:
    """(row, ids) of texts longer than a chunk."""
    make = lambda: kept_by_worker(("pieces", model), lambda: Pieces(model))
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chunks = cut_lineage(_chunk_rows(docs, 64, chunk).repartition(tasks, "row", "k"))
    # Between clean cuts there is nothing to solve: what is left are chunks with an end inside a run without a space.
    free = F.col("clean_start") & F.col("clean")
    place = F.col("begin"), F.col("begin"), F.col("cut"), F.col("cut")
    plain = chunks.where(free).select("row", "k", *(c.alias(n) for c, n in zip(place, ("s0", "s1", "e0", "e1"))))

    def measure():
        pieces = make()

        def step(row, k, first, begin, cut, clean_start, clean, text) -> Iterator[tuple]:
            for r, n, f, b, c, x, y, t in zip(row, k, first, begin, cut, clean_start, clean, text):
                starts, ends = _ends(pieces, t, f, b, c, x, y)
                weights = _weights(pieces, t, starts, x, ends, y)
                told = [f + v for s in ends for v in s]
                reached = np.where(np.isinf(weights), 0, 1).astype(np.int8).tobytes()
                yield r, n, b if x else None, len(starts), len(ends), reached, told

        return step

    schema = "row long, k int, begin long, rows int, columns int, reached binary, ends array<long>"
    matrices = map_rows(chunks.where(~free), schema, measure)

    def solve(one: pd.DataFrame) -> pd.DataFrame:
        one = one.sort_values("k")
        shaped = [np.frombuffer(b, np.int8).reshape(r, c) for b, r, c in zip(one["reached"], one["rows"], one["columns"])]
        found = find_states([np.where(m > 0, 0.0, -np.inf) for m in shaped])
        ends = [(int(e[2 * i]), int(e[2 * i + 1])) for e, i in zip(one["ends"], found)]
        starts = [(0, 0), *ends[:-1]]  # of the chunk before, unless a clean cut is between
        starts = [s if pd.isna(b) else (int(b), int(b)) for b, s in zip(one["begin"], starts)]
        rows = [(r, k, *s, *e) for r, k, s, e in zip(one["row"], one["k"], starts, ends)]
        return pd.DataFrame(rows, columns=["row", "k", "s0", "s1", "e0", "e1"])

    solved = matrices.repartition(tasks, "row").groupBy("row")
    states = plain.union(solved.applyInPandas(solve, "row long, k int, s0 long, s1 long, e0 long, e1 long"))
    joined = chunks.join(states, ["row", "k"]).select(
        "row", "k", "first", "clean_start", "clean", "text", "s0", "s1", "e0", "e1"
    )

    def trace():
        pieces = make()

        def step(row, k, first, clean_start, clean, text, s0, s1, e0, e1) -> Iterator[tuple]:
            for r, n, f, x, y, t, a, b, c, d in zip(row, k, first, clean_start, clean, text, s0, s1, e0, e1):
                ids = _between(pieces, t, (a - f, b - f), x, (c - f, d - f), y)
                yield r, n, np.array(ids, dtype="<u4").tobytes()

        return step

    traced = map_rows(joined, "row long, k int, ids binary", trace)
    order = F.array_sort(F.collect_list(F.struct("k", "ids")))
    whole = F.concat_ws("", F.transform(order, lambda p: F.hex(p["ids"])))
    return traced.groupBy("row").agg(F.unhex(whole).alias("ids"))


def _as_it_is(pieces: Pieces, key: int | None, text: str, ids: bytes) -> tuple:
    return key, text, ids


def _encoded(docs: DataFrame, model: str, chunk: int, id_col: str, text_col: str, schema: str, row: Callable[..., tuple]) -> DataFrame:
    """What ``row`` makes of vocabulary, id, text and ids of every row, in the Python process that finds the ids of short texts."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))
    long = F.length("text") > chunk

    def short():
        pieces = kept_by_worker(("pieces", model), lambda: Pieces(model))

        def step(keys: list, texts: list) -> Iterator[tuple]:
            return map(partial(row, pieces), keys, texts, pieces.encode(texts))

        return step

    def whole():
        pieces = kept_by_worker(("pieces", model), lambda: Pieces(model))
        return partial(map, partial(row, pieces))

    giants = rows.where(long).withColumn("row", F.xxhash64("text"))
    solved = _giants(giants.groupBy("row").agg(F.first("text").alias("text")), model, chunk)
    traced = giants.join(solved, "row").select("doc_id", "text", "ids")
    return map_rows(rows.where(~long), schema, short).union(traced if row is _as_it_is else map_rows(traced, schema, whole))


def encode(docs: DataFrame, model: str, chunk: int = CHUNK, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, ids) of every row of ``docs``; ids as little-endian unsigned 32-bit numbers.

    A null or empty text has no ids. Texts longer than ``chunk`` go by chunks, over as many tasks; equal ones once.
    Repeated rows stay, further columns are not looked at.
    """
    return _encoded(docs, model, chunk, id_col, text_col, "doc_id long, text string, ids binary", _as_it_is)


def decode(ids: Column, model: str) -> Column:
    """The texts of ids as ``encode`` gives them."""

    @F.pandas_udf("string")
    def text(stored: pd.Series) -> pd.Series:
        pieces = kept_by_worker(("pieces", model), lambda: Pieces(model))
        return stored.map(pieces.decode)

    return text(ids)


def _digest(pieces: Pieces, key: int | None, text: str, ids: bytes) -> tuple:
    return key, len(ids) // 4, zlib.crc32(ids), pieces.decode(ids) == text.replace(SPACE, " ")


_DIGESTS = "doc_id long, n_tokens long, ids_crc32 long, round_trip boolean"


def digests(encoded: DataFrame, model: str) -> DataFrame:
    """(doc_id, n_tokens, ids_crc32, round_trip): whether the ids decode to the text, where a shown space is a space."""

    def work():
        return partial(map, partial(_digest, kept_by_worker(("pieces", model), lambda: Pieces(model))))

    return map_rows(encoded, _DIGESTS, work)


def encode_digests(docs: DataFrame, model: str, chunk: int = CHUNK, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """:func:`digests` of :func:`encode`, each made where the ids are found.

    Texts and ids do not go on to a second Python process, of which a task would have two at a time.
    """
    return _encoded(docs, model, chunk, id_col, text_col, _DIGESTS, _digest)
