"""Token ids of whole texts, as the tokenizers library gives them, with a memo of the parts between spaces.

Both vocabularies cut a text at spaces before anything else, so a text's ids are those of its space-separated parts, one
after the other. A task keeps the ids of parts it has met and asks the library only for new ones, many at a time. Where
the vocabulary keeps white space (byte-level BPE), a space belongs to the part after it and runs of white space are cut
only at single spaces between visible characters.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterable

import numpy as np
import tiktoken
from tokenizers import Tokenizer

from quartier.llm.arrow import kept_by_worker

#: Parts remembered by a task before it starts anew.
MEMO_PARTS = 500_000
#: What stands between the parts of a shared call, and in none of them, where white space is kept or dropped; it is one
#: token. Parts that do hold it are put apart by the end-of-text string.
_BETWEEN = {True: "\n\n", False: "0"}
#: Fixed value: how byte-level vocabularies cut a text.
_PIECES = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_SINGLE_SPACE = re.compile(r"(?<=\S) (?=\S)")


def byte_letters() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + k): b for k, b in enumerate(hidden)}


def _same_merges(model: dict) -> tiktoken.Encoding | None:
    """The same vocabulary for a library that is quicker, if ids are in the order of merges, as that library needs.

    It serves texts of Latin-1 characters without special strings: for these the two libraries give the same ids.
    """
    letters = byte_letters()
    ranks = {bytes(map(letters.__getitem__, token)): i for token, i in model["vocab"].items()}
    merged = [model["vocab"]["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
    if merged != sorted(merged) or len(ranks) != len(model["vocab"]):
        return None
    return tiktoken.Encoding("same", pat_str=_PIECES, mergeable_ranks=ranks, special_tokens={})


def _is_latin(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def stop_is_apart(part: str) -> bool:
    """Whether the last character of ``part``, a full stop or comma, is a piece of its own: it follows a Latin letter.

    A letter whose lower case ends in a combining mark is none such: mark and stop are one piece.
    """
    return "A" <= part[-2:-1] < "\u0250" and part[-2].lower().isalpha()


def task_encoder(path: str) -> PartEncoder:
    return kept_by_worker(("encoder", path), lambda: PartEncoder(path))


def id_bytes(path: str) -> int:
    """Bytes that hold any id of the vocabulary: 2 or 4."""
    return 2 if Tokenizer.from_file(path).get_vocab_size(with_added_tokens=True) <= 1 << 16 else 4


class LatinWords:
    """Ids of single words of Latin-1 letters in a vocabulary with word ends, by the quicker library.

    That library merges bytes, so a word's last byte, which is a symbol of its own here, is written as another byte: a letter
    as its capital (words are in lower case), a continuation byte as its low six bits.
    """

    END = "</w>"
    INNER = bytes([*range(97, 123), 0xC3, *range(0x80, 0xC0)])

    def __init__(self, ranks: dict[bytes, int]):
        self.as_last = np.arange(256, dtype=np.uint8)
        for b in self.INNER:
            self.as_last[b] = self._as_last(b)
        spare = 1 << 20
        whole = {bytes([b]): spare + b for b in range(256)} | ranks
        coding = tiktoken.Encoding("words", pat_str=r"[\s\S]+", mergeable_ranks=whole, special_tokens={})
        self.merge = coding._core_bpe.encode_single_piece

    @staticmethod
    def _as_last(byte: int) -> int:
        return byte - 32 if byte < 128 else byte & 0x3F

    @classmethod
    def of(cls, model: dict) -> LatinWords | None:
        """None if ids are not in the order of merges."""
        merged = [model["vocab"]["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
        if merged != sorted(merged):
            return None
        letters, ranks = byte_letters(), {}
        for token, i in model["vocab"].items():
            plain = token.removesuffix(cls.END)
            raw = bytes(letters.get(c, 0) for c in plain)
            if raw and not raw.translate(None, cls.INNER):
                if plain != token:
                    if raw[-1] == 0xC3:
                        continue
                    raw = raw[:-1] + bytes([cls._as_last(raw[-1])])
                ranks[raw] = i
        return cls(ranks)

    def many(self, parts: list[str]) -> list[bytes | None]:
        """Each word's ids, or None for a part that is not such a word."""
        found: list[bytes | None] = [None] * len(parts)
        words = [k for k, part in enumerate(parts) if part.isalpha() and len(part) <= 200]
        if not words:
            return found
        # Letters hold no space, in lower case too. Changed bytes may be one, so words are cut at a byte that text never has.
        lowered = " ".join([parts[k] for k in words]).lower().encode() + b" "
        codes = np.frombuffer(lowered, dtype=np.uint8).copy()
        ends = np.flatnonzero(codes == 32)
        codes[ends - 1] = self.as_last[codes[ends - 1]]
        codes[ends] = 255
        raws = codes[:-1].tobytes().split(b"\xff")
        if lowered.translate(None, self.INNER + b" "):
            strange = np.flatnonzero(~np.isin(np.frombuffer(lowered, dtype=np.uint8), list(self.INNER + b" ")))
            other = set(np.searchsorted(ends, strange).tolist())
            words = [k for w, k in enumerate(words) if w not in other]
            raws = [raw for w, raw in enumerate(raws) if w not in other]
        flat, at = array("I"), 0
        ends = []
        for ids in map(self.merge, raws):  # no list is kept: many would cost collections of garbage
            flat.fromlist(ids)
            ends.append(4 * len(flat))
        whole = np.array(flat, dtype="<u4").tobytes()
        for k, end in zip(words, ends):
            found[k] = whole[at:end]
            at = end
        return found


class PartEncoder:
    """Encodes texts to little-endian unsigned 32-bit ids; special strings are read as the library does by default."""

    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.keeps_spaces = spec["pre_tokenizer"]["type"] == "ByteLevel"
        self.word = None if self.keeps_spaces else LatinWords.of(spec["model"])
        self.quick = _same_merges(spec["model"]) if self.keeps_spaces else None
        self.between = [(b, int(self._array(b)[0])) for b in (_BETWEEN[self.keeps_spaces], "<|endoftext|>")]
        self.stops = {p: self._ids(p) for p in ".,"}
        self.memo: dict[str, bytes | None] = {}
        self.first: dict[str, bytes] = {}

    def _array(self, text: str) -> np.ndarray:
        (found,) = self.library.encode_batch_fast([text], add_special_tokens=False)
        return np.array(found.ids, dtype="<u4")

    def _ids(self, text: str) -> bytes:
        return self._array(text).tobytes()

    def many(self, parts: list[str]) -> list[bytes]:
        """Ids of each part, as they are after a space."""
        if not self.word:
            return self._by_library(parts)
        found = self.word.many(parts)
        rest = iter(self._by_library([p for p, ids in zip(parts, found) if ids is None]))
        return [next(rest) if ids is None else ids for ids in found]

    def counts(self, parts: list[str]) -> list[int]:
        """How many ids each part has."""
        return [len(ids) // 4 for ids in self.many(parts)]

    def _by_library(self, parts: list[str]) -> list[bytes]:
        lead = " " if self.keeps_spaces else ""
        plain = [p for p in parts if 0 < len(p) < 256 and "<|" not in p]
        if self.keeps_spaces:
            plain = [p for p in plain if not p[-1].isspace()]
        found: dict[str, bytes] = {}
        for between, mark in self.between:
            alone = [p for p in plain if p not in found and between not in p] if found else [p for p in plain if between not in p]
            space = "" if self.keeps_spaces else " "
            ids = self._array(f"{space}{between}{space}".join([lead + p for p in alone]))
            cuts = np.flatnonzero(ids == mark)
            if len(cuts) == len(alone) - 1:
                raw, ends = ids.tobytes(), [*(4 * cuts).tolist(), 4 * len(ids)]
                found.update(zip(alone, (raw[a:b] for a, b in zip([0, *(e + 4 for e in ends[:-1])], ends))))
        return [found[p] if p in found else self._ids(lead + p) for p in parts]

    def _learn(self, new: list[str]) -> None:
        """Remember the ids of distinct parts that are not remembered."""
        if len(self.memo) + len(new) > MEMO_PARTS:  # short parts come most often
            self.memo = {p: ids for p, ids in self.memo.items() if len(p) < 8}
        if self.keeps_spaces:  # what begins with white space depends on the part before it
            self.memo.update((p, b"") for p in new if not p or p[0].isspace())
            new = [p for p in new if p and not p[0].isspace()]
        core = {p: p[:-1] for p in new if p[-1:] in self.stops and stop_is_apart(p)}
        new = [p for p in {core.get(p, p) for p in new} if p not in self.memo]
        self.memo.update(zip(new, self.many(new)))
        self.memo.update((p, self.memo[c] + self.stops[p[-1]]) for p, c in core.items())

    def _found(self, split: Iterable[list[str]]) -> list[tuple[list[str], list[bytes]]]:
        """Each text's parts and their ids, from the memo once the new ones are in it."""
        get = self.memo.get
        out, new, gaps = [], set(), []
        for parts in split:
            found = list(map(get, parts))
            out.append((parts, found))
            if None in found:
                gaps.append((parts, found, [k for k, ids in enumerate(found) if ids is None]))
                new.update([parts[k] for k in gaps[-1][2]])
        if new:
            self._learn(list(new))
            memo = self.memo
            for parts, found, places in gaps:
                for k in places:
                    found[k] = memo[parts[k]]
        return out

    def _spaced(self, text: str) -> bytes:
        """The ids of a text with runs of white space, where these are kept."""
        first, *parts = _SINGLE_SPACE.split(text)
        return self._ids(first) + b"".join(self.many(parts))

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text; null counts as empty."""
        shown = [text or "" for text in texts]
        if not self.quick:
            return self._by_parts(shown)
        plain = {k for k, text in enumerate(shown) if _is_latin(text) and "<|" not in text}
        rest = [k for k in range(len(shown)) if k not in plain]
        others = dict(zip(rest, self._by_parts([shown[k] for k in rest])))
        ids = self.quick.encode_to_numpy
        return [ids(t).astype("<u4").tobytes() if k in plain else others[k] for k, t in enumerate(shown)]

    def _by_parts(self, shown: list[str]) -> list[bytes]:
        if not self.keeps_spaces:
            return [b"".join(ids) for _, ids in self._found(text.replace("\n", " ").split(" ") for text in shown)]
        out = []
        for text, (parts, ids) in zip(shown, self._found(text.split(" ") for text in shown)):
            if not parts[0] or not all(ids):  # parts that begin with white space have no ids of their own
                out.append(self._spaced(text))
                continue
            if parts[0] not in self.first:
                if len(self.first) >= MEMO_PARTS:
                    self.first.clear()
                self.first[parts[0]] = self._ids(parts[0])
            out.append(self.first[parts[0]] + b"".join(ids[1:]))
        return out
