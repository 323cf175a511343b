"""Exact token counts at every prefix of every text, kept so that budget questions need no encoding.

The count at a prefix is the count before its last space-separated part plus the count of that part's own prefix; the
former is the entry already made for the prefix that ends there, the latter is remembered for every part prefix met. One
entry is kept per character: by how much the count changes with it, as a little-endian 16-bit number (a further
character can lower the count, since it may let tokens merge). ``n_tokens`` is their sum.
"""

from __future__ import annotations

import json
import re
import sys
import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quartier.llm.arrow import kept_by_worker, map_rows
from quartier.llm.encoding import MEMO_PARTS, PartEncoder, byte_letters, stop_is_apart

#: A part longer than this is not remembered; the counts along its pieces come from their own recurrence.
LONG_PART = 64


#: What the vocabulary takes for white space (fixed characters), and runs that hold no letter and no digit.
_WHITE = re.compile("[\t\n\x0b\x0c\r\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
_NO_LETTERS = regex.compile(r"[^\s\p{L}\p{N}]*")


@cache
def _joins() -> frozenset[str]:
    """Characters that normal form may join with the one before, though they are not marks."""
    pairs = (unicodedata.decomposition(chr(c)).split() for c in range(sys.maxunicode + 1))
    second = {chr(int(p[1], 16)) for p in pairs if len(p) == 2 and not p[0].startswith("<")}
    jamo = [*range(0x1161, 0x1176), *range(0x11A8, 0x11C3)]  # fixed ranges: vowels and final consonants of Hangul
    return frozenset(second | {chr(c) for c in jamo})


def _shown(text: str) -> str:
    return "".join([c.lower() for c in unicodedata.normalize("NFC", text)])


def normal_ends(text: str) -> tuple[list[tuple[int, str | None]], str]:
    """For each character where the prefix that it ends lies in the normal form, and the normal form.

    (at, None) stands for its first ``at`` characters, (at, end) for these followed by ``end``.
    """
    if text.isascii():
        return [(k, None) for k in range(1, len(text) + 1)], text.lower()
    joins = _joins()
    starts = [k for k, c in enumerate(text) if c < "\u0300" or not (unicodedata.combining(c) or c in joins)]
    if not starts or starts[0]:
        starts.insert(0, 0)
    ends: list[tuple[int, str | None]] = []
    shown, at = [], 0
    for begin, stop in zip(starts, [*starts[1:], len(text)]):
        whole = _shown(text[begin:stop])
        for k in range(begin + 1, stop):
            part = _shown(text[begin:k])
            ends.append((at + len(part), None) if whole.startswith(part) else (at, part))
        shown.append(whole)
        at += len(whole)
        ends.append((at, None))
    return ends, "".join(shown)


class PrefixCounter:
    """Changes of the token count, character by character, for vocabularies that drop white space."""

    def __init__(self, path: str):
        self.encoder = PartEncoder(path)
        if self.encoder.keeps_spaces:
            raise ValueError("a part's ids must not depend on the white space around it")
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.pattern = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        self.special = regex.compile("(" + "|".join(regex.escape(t["content"]) for t in spec["added_tokens"]) + ")")
        self.long = LongPiece(spec["model"])
        self.counts: dict[str, int] = {"": 0}
        self.changes: dict[str, bytes] = {"": b""}

    def _learn(self, parts: set[str]) -> None:
        new = {p for p in parts if p not in self.changes}
        if len(self.changes) + len(new) > MEMO_PARTS // 2:  # short ones come most often
            self.changes = {p: b for p, b in self.changes.items() if len(p) < 8}
            new = {p for p in parts if p not in self.changes}
        if len(self.counts) > 2 * MEMO_PARTS:
            self.counts = {p: n for p, n in self.counts.items() if len(p) < 8}
        # A full stop or comma after a Latin letter is one more token.
        stopped = [p for p in new if p[-1] in ".," and len(p) <= LONG_PART and stop_is_apart(p)]
        new = {p[:-1] for p in stopped}.union(new.difference(stopped))
        new = {p for p in new if p not in self.changes}
        short = [p for p in new if len(p) <= LONG_PART]
        count, unknown = self.counts, []
        for p in short:  # where a prefix is known, so are those before it
            prefix = p
            while prefix not in count:
                count[prefix] = 0
                unknown.append(prefix)
                prefix = prefix[:-1]
        count.update(zip(unknown, self.encoder.counts(unknown)))
        # All parts' counts in one row, each from the 0 before its first character; differences across parts are not read.
        flat = [count[p[:i]] for p in short for i in range(len(p) + 1)]
        raw = np.diff(np.array(flat, dtype="<i2")).tobytes()
        at = 0
        for p in short:
            self.changes[p] = raw[at : at + 2 * len(p)]
            at += 2 * len(p) + 2
        self.changes.update((p, self.changes[p[:-1]] + b"\1\0") for p in stopped)

    def _pieces(self, text: str) -> list[str]:
        return self.pattern.findall(self.encoder.library.normalizer.normalize_str(text))

    def _each(self, pieces: list[str], long: dict[int, LongRun] | None = None) -> list[int]:
        """Counts after every character of ``pieces``; runs of pieces over ``LONG_PART`` are put in ``long`` by number."""
        asked = list({piece[:i] for piece in pieces if len(piece) <= LONG_PART for i in range(1, len(piece) + 1)})
        known = dict(zip(asked, self.encoder.counts(asked)))
        out, before = [], 0
        for number, piece in enumerate(pieces):
            if len(piece) > LONG_PART:
                run = self.long.run(piece)
                ends = run.counts
                if long is not None:
                    long[number] = run
            else:
                ends = [known[piece[:i]] for i in range(1, len(piece) + 1)]
            out += [before + n for n in ends]
            before = out[-1]
        return out

    def _ordinary(self, text: str) -> list[int]:
        """Counts after every character of a text without white space and special strings.

        A prefix's normal form is a prefix of the whole normal form, but for those that end between a letter and its marks:
        they are the normal form up to the letter, and another end.
        """
        ends, shown = normal_ends(text)
        if shown != self.encoder.library.normalizer.normalize_str(text):  # another version of the character tables
            return self.encoder.counts([text[:i] for i in range(1, len(text) + 1)])
        pieces = self.pattern.findall(shown)
        long: dict[int, LongRun] = {}
        counts = [0, *self._each(pieces, long)]
        starts = np.cumsum([0, *map(len, pieces)])
        return [counts[at] if end is None else self._other_end(shown, pieces, starts, counts, long, at, end) for at, end in ends]

    def _other_end(self, shown: str, pieces: list[str], starts: np.ndarray, counts: list[int], long: dict, at: int, end: str) -> int:
        """The count of ``shown[:at] + end``: only the last piece before ``at`` can go on in ``end``."""
        if not at:
            return self.encoder.counts([end])[0]
        number = int(np.searchsorted(starts, at - 1, side="right")) - 1
        begin = int(starts[number])
        if number not in long or at - begin <= LONG_PART:
            return counts[begin] + self.encoder.counts([shown[begin:at] + end])[0]
        # A run this long is letters, or neither letters nor digits, and goes on as such.
        first = self.pattern.findall(shown[at - 1] + end)[0][1:] if shown[at - 1] != "'" else _NO_LETTERS.match(end)[0]
        rest = end[len(first) :]
        return counts[begin] + long[number].with_end(at - begin, first) + (self.encoder.counts([rest])[0] if rest else 0)

    def _long(self, part: str) -> bytes:
        """Changes along a part of any length: earlier pieces of a part never depend on what follows them."""
        counts, before = [0], 0
        for k, text in enumerate(self.special.split(part)):
            if k % 2:  # a special string is one token when whole, ordinary text (of the piece before it, too) until then
                tail = (self._pieces(last) or [""])[-1] if last else ""
                base = before - (self._each([tail])[-1] if tail else 0)
                partly = self.encoder.counts([tail + text[:i] for i in range(1, len(text))])
                counts += [base + n for n in partly] + [before + 1]
            elif text:
                counts += [before + n for n in self._ordinary(text)]
            before, last = counts[-1], text
        return np.diff(np.array(counts, dtype="<i4")).astype("<i2").tobytes()

    def along(self, texts: list[str | None]) -> list[bytes]:
        """The changes for each text; null counts as empty. White space changes nothing."""
        get = self.changes.get
        split, new = [], set()
        for text in texts:
            parts = _WHITE.sub(" ", text or "").split(" ")
            found = list(map(get, parts))
            split.append((parts, found))
            if None in found:
                new.update(part for part, own in zip(parts, found) if own is None)
        self._learn(new)
        out = []
        for parts, found in split:
            if None in found:
                found = [self._known(part) if own is None else own for part, own in zip(parts, found)]
            out.append(b"\0\0".join(found))
        return out

    def _known(self, part: str) -> bytes:
        return self.changes[part] if part in self.changes else self._long(part)


class LongPiece:
    """Counts at every prefix of one piece in time linear in its length.

    Byte-pair encoding of a string is the one sequence of vocabulary entries in which each neighbouring pair, encoded by
    itself, stays as it is. So the last token of each prefix follows from the last tokens of shorter ones: it is the entry
    that ends there and goes with the last token of the prefix before it. A second step puts the word's end on.
    """

    END = "</w>"

    def __init__(self, model: dict):
        pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        self.rank = {(a, b): k for k, (a, b) in enumerate(pairs)}
        self.vocabulary = model["vocab"]
        self.longest = max(len(v.removesuffix(self.END)) for v in self.vocabulary)
        self.goes: dict[tuple[str, str], bool] = {}
        self.letter = {b: c for c, b in byte_letters().items()}

    def _symbols(self, token: str) -> list[str]:
        if token.endswith(self.END):
            plain = token.removesuffix(self.END)
            return [*plain[:-1], plain[-1] + self.END]
        return [*token]

    def _stays(self, left: str, right: str) -> bool:
        key = (left, right)
        if key not in self.goes:
            parts = self._symbols(left) + self._symbols(right)
            while len(parts) > 1:
                best, at = min((self.rank.get(pair, 1 << 60), k) for k, pair in enumerate(zip(parts, parts[1:])))
                if best == 1 << 60:
                    break
                parts[at : at + 2] = [parts[at] + parts[at + 1]]
            if len(self.goes) >= MEMO_PARTS:
                self.goes.clear()
            self.goes[key] = parts == [left, right]
        return self.goes[key]

    def run(self, piece: str) -> LongRun:
        text = "".join(self.letter[b] for b in piece.encode())
        last: list[str | None] = [""]
        number, ended = [0], [0]
        self.extend(text, last, number, ended, 0)
        return LongRun(self, text, np.cumsum([0, *(len(c.encode()) for c in piece)]), last, number, ended)

    def extend(self, text: str, last: list[str | None], number: list[int], ended: list[int], offset: int) -> None:
        """Go on to the end of ``text``; its first ``offset`` characters are left out of all four."""
        for end in range(len(last), len(text) + 1):
            last.append(None)
            number.append(0)
            ended.append(0)
            for start in range(max(0, end - self.longest), end):
                before, token = last[start], text[start:end]
                if before is None:
                    continue
                whole = not start and not offset
                if last[end] is None and token in self.vocabulary and (whole or self._stays(before, token)):
                    last[end], number[end] = token, number[start] + 1
                token += self.END
                if not ended[end] and token in self.vocabulary and (whole or self._stays(before, token)):
                    ended[end] = number[start] + 1


class LongRun:
    """A long piece with the last token of each prefix."""

    def __init__(self, of: LongPiece, text: str, ends: np.ndarray, last: list, number: list[int], ended: list[int]) -> None:
        self.of, self.text, self.ends, self.last, self.number, self.ended = of, text, ends, last, number, ended

    @property
    def counts(self) -> list[int]:
        """Token counts of the prefixes that end with each character, each taken as a whole word."""
        return [self.ended[e] for e in self.ends[1:]]

    def with_end(self, characters: int, end: str) -> int:
        """The count of the first ``characters`` of the piece followed by ``end``."""
        at = int(self.ends[characters])
        if not end:
            return self.ended[at]
        offset = max(0, at - self.of.longest)
        text = self.text[offset:at] + "".join(self.of.letter[b] for b in end.encode())
        parts = self.last[offset : at + 1], self.number[offset : at + 1], self.ended[offset : at + 1]
        self.of.extend(text, *parts, offset)
        return parts[2][-1]


def prefix_counts(docs: DataFrame, tokenizer: str, store: bool = True, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens, changes) of every row of ``docs``.

    ``changes`` has one 16-bit number per character of the text; ``store=False`` leaves it out after use. A null or empty
    text has no bytes, tokens or changes. Repeated rows stay, further columns are not looked at. A text of any length is
    read whole; its longest part without a space takes memory in proportion to its length.
    """

    def work():
        counter = kept_by_worker(("prefixes", tokenizer), lambda: PrefixCounter(tokenizer))

        def step(ids: list, texts: list) -> Iterator[tuple]:
            for key, text, changes in zip(ids, texts, counter.along(texts)):
                total = int(np.frombuffer(changes, "<i2").sum(dtype=np.int64))
                yield key, len((text or "").encode()), total, changes if store else None

        return step

    rows = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    out = map_rows(rows, "doc_id long, n_bytes long, n_tokens long, changes binary", work)
    return out if store else out.drop("changes")


def tokens_of_prefix(changes: Column, characters: Column) -> Column:
    """Token count of the first ``characters`` characters of a text, from its stored changes."""

    @F.pandas_udf("long")
    def count(stored: pd.Series, cut: pd.Series) -> pd.Series:
        return pd.Series([int(np.frombuffer(b, "<i2")[:n].sum(dtype=np.int64)) for b, n in zip(stored, cut)])

    return count(changes, characters)


def longest_within(changes: Column, budget: Column) -> Column:
    """How many characters of a text can be kept so that they, and every shorter cut, need at most ``budget`` tokens."""

    @F.pandas_udf("long")
    def cut(stored: pd.Series, most: pd.Series) -> pd.Series:
        out = []
        for b, n in zip(stored, most):
            over = np.flatnonzero(np.cumsum(np.frombuffer(b, "<i2"), dtype=np.int64) > n)
            out.append(int(over[0]) if len(over) else len(b) // 2)
        return pd.Series(out, dtype="int64")

    return cut(changes, budget)
