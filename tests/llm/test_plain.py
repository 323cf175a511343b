"""Estimators against versions that go document by document."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from plain import fused, good_shares, maximal, toxic_scores
from test_language import SCHEMA, rows, text
from test_toxicity import brute_segments, table

from quartier.llm import language, quality, toxicity


def test_fused_languages_of_documents(spark):
    pick = random.Random(8)
    some = [(i, t, lang if i % 3 else pick.choice([None, "xx", "de"]), s if i % 11 else None, "?", "?") for i, t, lang, s, *_ in rows(160)]
    some += [(500, None, "en", "s1", "?", "?"), (501, "", "en", "s1", "?", "?"), (502, "in", "de", "s1", "?", "?"), (503, "zq xq", None, "s9", "?", "?")]
    docs = spark.createDataFrame(some, SCHEMA)
    model = language.fit(docs)
    got = {r.key: r for r in language.identify_documents(docs, model).collect()}
    for row, (lang, posterior, accepted) in zip(some, fused(model, [(r[1], r[3], None, None, r[2]) for r in some])):
        mine = got[row[0]]
        assert (mine.lang, mine.accepted) == (lang, accepted) and mine.posterior == pytest.approx(posterior, abs=2e-6), row


def test_fused_languages_of_pages(spark):
    pick = random.Random(9)
    model = language.fit(spark.createDataFrame([*rows()], SCHEMA))
    pages, plain = [], []
    for i in range(120):
        lang = pick.choice(["de", "en", "fr"])
        host = pick.choice([f"www.a{pick.randint(0, 3)}.{pick.choice(['de', 'com'])}", f"b{pick.randint(0, 2)}.fr", None])
        said, body = pick.choice([lang, lang, "en", "pt", None]), text(lang, pick.randint(1, 12), pick)
        pages.append((i, host and f"https://{host}/x{i}", f"<html{f' lang={said}' if said else ''}><p>{body}</p>"))
        names = host.split(".") if host else []
        plain.append((body, host, ".".join(names[-2:]) or None, names[-1] if names else None, said))
    got = {r.key: r for r in language.identify_pages(spark.createDataFrame(pages, "page_id long, url string, html string"), model).collect()}
    for i, (lang, posterior, accepted) in enumerate(fused(model, plain)):
        assert (got[i].lang, got[i].accepted) == (lang, accepted) and got[i].posterior == pytest.approx(posterior, abs=2e-6)


def test_plain_segments_are_the_maximal_ones():
    pick = random.Random(3)
    for _ in range(200):
        scores = [round(pick.uniform(-3, 3), 6) for _ in range(pick.randint(0, 18))]
        assert maximal(scores) == pytest.approx([sum(scores[a:b]) for a, b in brute_segments(scores)])


def test_toxic_scores(spark):
    docs, labels = table(spark, 700)
    pick = random.Random(4)
    some = [(r.doc_id, r.text) for r in docs.collect()]
    words = sorted({w for _, t in some for w in t.split()})
    some += [(10_000 + i, " ".join(pick.choices([*words, "blarg", "blarg", "grumph"], k=60))) for i in range(60)] + [(20_000, ""), (20_001, some[0][1])]
    told = [(r.doc_id, r.toxic) for r in labels.collect()] + [(10_000 + i, i % 2) for i in range(60)]
    docs = spark.createDataFrame(some, "doc_id long, text string")
    labels = spark.createDataFrame(told, "doc_id long, toxic int")
    got = {r.doc_id: r.score for r in toxicity.score(docs, toxicity.fit(docs, labels)).collect()}
    want = {i: p for (i, _), p in zip(some, toxic_scores(some, told))}
    assert got == pytest.approx(want, abs=1e-6)
    out = [i for i, _ in some[:700] if zlib.crc32(str(i).encode()) % 5 == 0]
    assert sum((want[i] >= 0.5) != (i % 8 == 0) for i in out) <= 0.05 * len(out)


def test_the_logistic_curve_is_the_likeliest():
    rng = np.random.default_rng(2)
    x = rng.normal(3, 5, 400)
    y = (rng.random(400) < 1 / (1 + np.exp(-(0.7 * x - 2)))).astype(float)
    slope, level = toxicity.logistic(x, y)

    def loss(a, b):
        z = a * x + b
        return np.sum(np.logaddexp(0, z) - y * z) + 0.5e-3 * (a * x.std()) ** 2

    here = loss(slope, level)
    assert all(here <= loss(slope + da, level + db) + 1e-6 for da in (-0.01, 0, 0.01) for db in (-0.02, 0, 0.02))


def test_posteriors_of_vote_patterns():
    pick = random.Random(5)
    documents = []
    for _ in range(1500):
        good = pick.random() < 0.75
        documents.append(tuple(pick.choices((-1, 0, 1), weights=(1, 5, 6) if good else (6, 5, 1))[0] for _ in range(6)))
    counts = {}
    for votes in documents:
        counts[votes] = counts.get(votes, 0) + 1
    fitted = quality.fit(sorted(counts.items()))
    plain = good_shares(documents)
    assert [fitted[v] for v in documents] == pytest.approx(plain, abs=1e-5)
