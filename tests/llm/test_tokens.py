"""Encoding, prefix counts, packing and token files against the tokenizers library itself."""

from __future__ import annotations

import random
import time
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from quartier.llm import encoding, packing, prefixes, tokenfiles
from quartier.session import scratch_path

BYTE, WORD = (public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "word_bpe_49k.json"))
PARTS = [" ", "  ", "\n", "\t", "a", "B", "the", "é", "é", "́", "0", "12", "'s", "'", "re", "<|endoftext|>", "<|",
         " ", "😀", "中文", "!", "...", "\r\n", "Σ", "İ", "İ.", "Í,", "\x00", "end. ", "\n\n"]
SCHEMA = "doc_id long, text string, ids string, start string, changes string, part string"


def texts(n: int, seed: int = 5) -> list[str]:
    pick = random.Random(seed)
    return ["".join(pick.choices(PARTS, k=pick.randint(0, 24))) for _ in range(n)]


def library(path: str, some: list[str]) -> list[list[int]]:
    return [e.ids for e in Tokenizer.from_file(path).encode_batch(some, add_special_tokens=False)]


def table(spark, rows: list[tuple]):
    return spark.createDataFrame([(i, t, "?", "?", "?", "?") for i, t in rows], SCHEMA)


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_ids_are_the_library_s(path):
    some = texts(4000)
    got = encoding.PartEncoder(path).encode([*some, None])
    assert [np.frombuffer(b, "<u4").tolist() for b in got] == [*library(path, some), []]


def test_stops_after_any_latin_letter():
    letters = [chr(c) for c in range(0x20, 0x250)]
    some = [f"{before}{c}{stop}{after}" for c in letters for stop in ".," for before in ("", "ab", "BELGES") for after in ("", " ve x")]
    for path in (BYTE, WORD):
        got = encoding.PartEncoder(path).encode(some)
        assert [np.frombuffer(b, "<u4").tolist() for b in got] == library(path, some)
    changes = prefixes.PrefixCounter(WORD).along(some)
    assert [int(np.frombuffer(b, "<i2").sum()) for b in changes] == [len(ids) for ids in library(WORD, some)]


def test_words_are_merged_together():
    """Words of other letters among them go to the library; no list of ids is kept for a word."""
    encoder, pick = encoding.PartEncoder(WORD), random.Random(8)
    letters = "abcdefghijklmnopqrstuvwxyzABCÀÉßéàñöÿžšΣσжİªµ"
    parts = list(dict.fromkeys("".join(pick.choices(letters, k=pick.randint(1, 12))) for _ in range(3000)))
    parts += ["a" * 200, "b" * 201, "à" * 120, "12", "x1", ".", "中文"]
    want = library(WORD, parts)
    assert [np.frombuffer(ids, "<u4").tolist() for ids in encoder.many(parts)] == want
    assert encoder.counts(parts) == [len(ids) for ids in want]
    found = encoder.word.many(parts)
    assert any(ids is None for ids in found) and all(ids is None or isinstance(ids, bytes) for ids in found)
    assert encoder.word.many(["12", ""]) == [None, None] and encoder.word.many([]) == []


def test_count_at_every_prefix():
    pick = random.Random(3)
    some = texts(300) + ["".join(pick.choices(["erth", "ing", "q" * 9, "中文字", "!!", "12", "'re"], k=40)) for _ in range(20)]
    some += ["abcab" * 50, "zé" * 80, "the<|endoftext|>" * 8 + "!!!<|endoftext|>ab" * 5, "é" * 50]
    for text, changes in zip(some, prefixes.PrefixCounter(WORD).along(some)):
        want = [len(ids) for ids in library(WORD, [text[:i] for i in range(1, len(text) + 1)])]
        assert np.cumsum(np.frombuffer(changes, "<i2")).tolist() == want


@pytest.mark.parametrize("unit", ["abcdefgh", "ab\tcd\x0b", "中文\u3000字", "DERGİ", "e\u0301x", "e\u0323\u0301", "a,b;", "<|endoftext|>x", "가\u11a8", "q1"])
def test_a_long_part_takes_linear_time(unit):
    counter = prefixes.PrefixCounter(WORD)
    text = unit * 40
    (changes,) = counter.along([text])
    want = [len(ids) for ids in library(WORD, [text[:i] for i in range(1, len(text) + 1)])]
    assert np.cumsum(np.frombuffer(changes, "<i2")).tolist() == want
    text = unit * (100_000 // len(unit))
    start = time.process_time()
    (changes,) = counter.along([text])
    assert time.process_time() - start < 30
    assert np.frombuffer(changes, "<i2").sum() == len(library(WORD, [text])[0]) and len(changes) == 2 * len(text)


def test_marks_in_long_parts():
    pick = random.Random(8)
    units = ["e", "\u0301", "\u0323", "İ", "'", "s", "x" * 70, "!" * 70, "ß", "Σ", "중", "ᄀ", "\u1161", "\u11a8", "\u09c7", "\u09be", "Å", "1", ","]
    some = ["x" * 66 + "".join(pick.choices(units, k=12)) for _ in range(120)]
    for text, changes in zip(some, prefixes.PrefixCounter(WORD).along(some)):
        want = [len(ids) for ids in library(WORD, [text[:i] for i in range(1, len(text) + 1)])]
        assert np.cumsum(np.frombuffer(changes, "<i2")).tolist() == want, ascii(text)


def test_prefix_table_answers_budgets(spark):
    some = [*texts(40), None, ""]
    stored = prefixes.prefix_counts(table(spark, list(enumerate(some))), WORD)
    cut = stored.withColumn("kept", prefixes.longest_within(stored.changes, stored.n_tokens.cast("long") - stored.n_tokens + 5))
    for r in cut.collect():
        text = some[r.doc_id] or ""
        assert (r.n_bytes, r.n_tokens) == (len(text.encode()), len(library(WORD, [text])[0]))
        counts = [len(ids) for ids in library(WORD, [text[:i] for i in range(1, len(text) + 1)])]
        assert r.kept == next((i for i, n in enumerate(counts) if n > 5), len(text))


def test_best_fit_takes_the_tightest_window():
    pick = random.Random(1)
    lengths = sorted((pick.randint(1, 60) for _ in range(400)), reverse=True)
    number, offset = packing.best_fit(lengths, 64)
    left: dict[int, int] = {}
    for length, which, at in zip(lengths, number, offset):
        fits = [free for free in left.values() if free >= length]
        if which in left:
            assert left[which] == min(fits) and at == 64 - left[which]
        else:
            assert not fits and at == 0
        left[which] = left.get(which, 64) - length


def test_packing_keeps_every_id_once(spark):
    some = [*texts(200), "word and " * 2000, None, "", None]
    docs = table(spark, [*enumerate(some), (None, "no id"), (7, some[7])])
    rows = packing.pack_documents(docs, BYTE, window=128).collect()
    want = [[*ids, 0] for ids in library(BYTE, [t or "" for t in some])]
    own, inside = defaultdict(list), defaultdict(list)
    for r in rows:
        own[r.doc_id].append(r)
        inside[r.sequence_id].append((r.offset, r.length))
    for i, ids in enumerate(want):
        if i != 7:
            at = 0
            for r in sorted(own[i], key=lambda r: r.start):
                piece = np.array(ids[at : at + r.length], "<u4").tobytes()
                assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(piece))
                at += r.length
            assert at == len(ids)
    assert len(own[7]) == 2 * len([1 for _ in range(0, len(want[7]), 128)]) and len(own[None]) >= 1
    for places in inside.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 128
    used = sum(r.length for r in rows)
    assert len(inside) * 128 - used < 2 * 128
    assert packing.pack_documents(docs.limit(0), BYTE).count() == 0


def test_sequences_hold_the_ids(spark):
    docs = table(spark, list(enumerate(texts(30))))
    pieces = packing.cut_documents(docs, BYTE, window=32, keep_ids=True)
    placed = packing.pack_documents(docs, BYTE, window=32)
    ids = {r.sequence_id: r.ids for r in packing.sequences(pieces, placed, 32).collect()}
    assert all(len(x) == 32 for x in ids.values())
    for r in placed.collect():
        piece = np.array(ids[r.sequence_id][r.offset : r.offset + r.length], "<u4").tobytes()
        assert zlib.crc32(piece) == r.ids_crc32


def test_token_files_give_back_every_document(spark):
    some = [*texts(120), None, "", "long " * 30000]
    keys = random.Random(2).sample(range(-500, 500), len(some))
    docs = table(spark, [*zip(keys, some), (None, "x y"), (keys[0], "again")]).repartition(6)
    path = scratch_path(spark, "tokens")
    tokenfiles.write_token_files(docs, path, WORD)
    got = sorted(tokenfiles.digests(spark, path).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == [None, *sorted([*keys, keys[0]])]
    at = 0
    by_key = dict(zip(keys, library(WORD, [t or "" for t in some])))
    for r in got:
        assert r.start == at
        at += r.n_tokens
        if r.doc_id not in (None, keys[0]):
            ids = [*by_key[r.doc_id], 1]
            assert (r.n_tokens, r.ids_crc32) == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
    (one,) = tokenfiles.read_documents(spark, path, [keys[-1]]).collect()
    assert np.frombuffer(one.ids, "<u4").tolist() == [*by_key[keys[-1]], 1]
    assert tokenfiles.read_documents(spark, path).count() == len(got)


def test_token_files_of_an_empty_table(spark):
    path = scratch_path(spark, "tokens")
    tokenfiles.write_token_files(spark.createDataFrame([], SCHEMA), path, WORD)
    assert tokenfiles.digests(spark, path).count() == 0
