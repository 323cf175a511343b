from __future__ import annotations

import random
import zlib

import numpy as np

from quartier.llm import toxicity


def brute_segments(scores: list[float]) -> list[tuple[int, int]]:
    """All maximal segments by their definition: take the best segment, then go on left and right of it."""
    if not scores:
        return []
    best = max(
        ((sum(scores[a:b]), -(b - a), -a) for a in range(len(scores)) for b in range(a + 1, len(scores) + 1)), default=None
    )
    if best is None or best[0] <= 0:
        return []
    a = -best[2]
    b = a - best[1]
    return [*brute_segments(scores[:a]), (a, b), *((x + b, y + b) for x, y in brute_segments(scores[b:]))]


def test_segments_are_the_maximal_ones():
    pick = random.Random(1)
    for _ in range(400):
        scores = [round(pick.uniform(-3, 3), 6) for _ in range(pick.randint(0, 18))]
        assert [(a, b) for a, b, _ in toxicity.segments(np.array(scores))] == brute_segments(scores)


def table(spark, n: int = 1500):
    pick = random.Random(2)
    common = ["".join(pick.choices("abdefgilmnorst", k=pick.randint(2, 8))) for _ in range(300)]
    bad = ["blarg", "snotty", "grumph"]
    rows, labels = [], []
    for i in range(n):
        words = pick.choices(common, k=pick.randint(20, 120))
        toxic = i % 8 == 0
        if toxic:
            at = pick.randrange(len(words))
            words[at:at] = [w for _ in range(3) for w in (pick.choice(bad), pick.choice(common))]
        rows.append((i, " ".join(words), "?", "?"))
        labels.append((i, int(toxic), "?"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string, passages string")
    return docs, spark.createDataFrame(labels, "doc_id long, toxic int, text string")


def test_held_out_accuracy_and_passages(spark):
    docs, labels = table(spark)
    model = toxicity.fit(docs, labels)
    rows = docs.select("doc_id", "text").collect()
    texts = {r.doc_id: toxicity.words(r.text) for r in rows}
    for r in toxicity.score(docs, model).withColumn("out", toxicity.held_out()).collect():
        assert r.out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert (r.score >= 0.5) == (r.doc_id % 8 == 0)
        for p in r.passages:
            assert {"blarg", "snotty", "grumph"} & {w.decode() for w in texts[r.doc_id][p.first : p.end]}


def test_held_out_labels_are_not_learnt(spark):
    docs, labels = table(spark, 400)
    flipped = labels.withColumn("toxic", toxicity.F.when(toxicity.held_out(), 1 - labels.toxic).otherwise(labels.toxic))
    assert toxicity.fit(docs, labels) == toxicity.fit(docs, flipped)


def test_edge_rows(spark):
    docs, labels = table(spark, 400)
    odd = [(None, None, "?", "?"), (-1, "", "?", "?"), (-1, "", "?", "?"), (-2, "blarg " * 50000, "?", "?"), (-3, "123 !!", "?", "?")]
    more = docs.union(spark.createDataFrame(odd, docs.schema))
    for model in (toxicity.fit(more, labels.union(labels)), toxicity.fit(docs, labels.limit(0)), toxicity.fit(docs.limit(0), labels)):
        got = toxicity.score(more, model, keep=["text"]).collect()
        assert len(got) == 405 and all(0 <= r.score <= 1 for r in got)
    assert toxicity.score(docs.limit(0), model).count() == 0


def test_long_clean_texts_stay(spark):
    """Clean texts joined to very long ones: each has chance passages in proportion to its length."""
    pick = random.Random(5)
    docs, labels = table(spark, 3000)
    texts = {r.doc_id: r.text.split() for r in docs.collect()}
    for i, words in texts.items():
        if i % 8 and i % 25 == 1:
            words[pick.randrange(len(words))] = pick.choice(["blarg", "snotty", "grumph"])
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in texts.items()], "doc_id long, text string")
    model = toxicity.fit(docs, labels)
    clean = [w for i, w in texts.items() if i % 8]
    long = [(k, " ".join(w for part in pick.choices(clean, k=n) for w in part)) for k, n in enumerate([10, 100, 1000, 5000] * 5)]
    got = toxicity.score(spark.createDataFrame(long, docs.schema), model).collect()
    assert [r.doc_id for r in got if r.score >= 0.5] == []
    scored = toxicity.score(docs, model).collect()
    assert sum((r.score >= 0.5) != (r.doc_id % 8 == 0) for r in scored) <= 0.01 * len(scored)
