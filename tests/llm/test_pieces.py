from __future__ import annotations

import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from quartier.llm import pieces

MODEL = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=MODEL)
PARTS = [" ", "  ", "a", "the", "ing", "th", "er", "\n", "é", "中文", "😀", "\t", ".", "'s", "12", "<s>", "aaaa", "ation"]


def texts(n: int, most: int, seed: int, parts=PARTS) -> list[str]:
    pick = random.Random(seed)
    return ["".join(pick.choices(parts, k=pick.randint(0, most))) for _ in range(n)]


def test_words_give_the_library_s_ids():
    some = [*texts(1500, 25, 1), "", " ", "▁a ▁", "   x"]
    got = pieces.Pieces(MODEL).encode(some)
    assert [np.frombuffer(b, "<u4").tolist() for b in got] == LIBRARY.encode(some)


@pytest.mark.parametrize("chunk", [7, 40])
def test_chunks_give_the_library_s_ids(spark, chunk, monkeypatch):
    monkeypatch.setattr(pieces, "NEARBY", 5)
    solid = [p for p in PARTS if " " not in p]
    some = texts(60, 60, 2) + texts(60, 60, 3, solid) + ["a" * 200, "x" * 90 + " y" * 90, None, "", " " * 50]
    rows = [(i, t, "?") for i, t in enumerate(some)] + [(0, some[0], "?"), (None, "no id " * 20, "?")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string").repartition(4)
    encoded = pieces.encode(docs, MODEL, chunk=chunk)
    got = encoded.withColumn("back", pieces.decode(encoded.ids, MODEL)).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is not None:
            text = some[r.doc_id] or ""
            assert np.frombuffer(r.ids, "<u4").tolist() == LIBRARY.encode(text), text
            assert r.back == text
    assert all(r.round_trip for r in pieces.digests(encoded, MODEL).collect())


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert pieces.encode(docs, MODEL).count() == 0


def plan_steps(df) -> int:
    return df._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow")


def test_digests_are_made_where_the_ids_are_found(spark):
    """Digests of short texts go through one Python process, not a second one beside it."""
    some = [*texts(40, 30, 4), "a" * 200, "long " * 60, None, "", *["x" * 90 + " y" * 90] * 2]
    docs = spark.createDataFrame(list(enumerate(some)), "doc_id long, text string").repartition(3)
    got = pieces.encode_digests(docs, MODEL, chunk=40)
    apart = pieces.digests(pieces.encode(docs, MODEL, chunk=40), MODEL)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, apart.collect()))
    assert got.count() == len(some)
    short = docs.where("length(text) < 40")
    steps = [plan_steps(pieces.encode_digests(short, MODEL, chunk=40)), plan_steps(pieces.encode(short, MODEL, chunk=40))]
    assert steps[0] == steps[1] + 1  # for giants, which have their ids by then
