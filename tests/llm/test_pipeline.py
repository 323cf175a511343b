from __future__ import annotations

from collections import defaultdict

import corpus_pipeline
from plain import fused, toxic_scores
from quartier.llm import language
from test_neardup import brute

DATA = "/root/testdata/sf0.001"


def test_stages_keep_the_columns_and_one_of_each_group(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select(*corpus_pipeline.COLUMNS)
    docs = docs.union(docs.where("doc_id % 7 = 0"))
    before = docs
    for name, stage in corpus_pipeline.STAGES[:3]:
        before, docs = docs, corpus_pipeline.cut_lineage(stage(spark, docs, DATA))
        assert docs.columns == corpus_pipeline.COLUMNS, name
        assert docs.count() > 0.6 * before.count()
    given = {r.doc_id: r.text for r in before.collect()}
    kept = [r.doc_id for r in docs.collect()]
    assert sorted(kept) == sorted(i for i, (_, least) in brute(given, percent=80).items() if i == least)
    packed = corpus_pipeline.STAGES[3][1](spark, docs, DATA).collect()
    tokens = defaultdict(int)
    for r in packed:
        tokens[r.doc_id] += r.length
    assert sorted(tokens) == sorted(kept) and all(tokens[r.doc_id] == r.doc_tokens for r in packed)


def test_language_and_toxicity_stages_equal_plain_versions(spark):
    """Kept ids of the given documents, a rare language and very long clean texts among them."""
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select(*corpus_pipeline.COLUMNS)
    first = [r for r in docs.orderBy("doc_id").collect() if r.text and len(r.text) < 3_000]
    clean = " ".join(r.text for r in first[:12])
    rare = [(90_000 + i, f"wyz kral hrad dvor most {i} reka hora " * 6, "cs", "s", 1) for i in range(3)]
    long = [(91_000, clean, first[0].lang, first[0].source, 1)]
    rows = [tuple(r) for r in first] + rare + long
    docs = spark.createDataFrame(rows, docs.schema)
    model = language.fit(docs)
    plain = fused(model, [(r[1], r[3], None, None, r[2] and r[2].lower()) for r in rows])
    kept = {r.doc_id for r in corpus_pipeline.keep_known_languages(spark, docs, DATA).select("doc_id").collect()}
    assert kept == {r[0] for r, (_, _, accepted) in zip(rows, plain) if accepted}
    assert {r[0] for r in rare} <= kept and len(kept) > 0.9 * len(rows)

    labels = [(r.doc_id, r.toxic) for r in spark.read.parquet(f"{DATA}/labels.parquet").collect()]
    shown = [(r[0], r[1]) for r in rows]
    want = {i for (i, _), p in zip(shown, toxic_scores(shown, labels)) if p < 0.5}
    kept = {r.doc_id for r in corpus_pipeline.drop_toxic(spark, docs, DATA).select("doc_id").collect()}
    assert kept == want
    toxic = dict(labels)
    assert all(i in kept for i, _ in shown if toxic.get(i) == 0)


def test_odd_rows_pass_through(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select(*corpus_pipeline.COLUMNS)
    odd = spark.createDataFrame([(None, None, None, None, None), (-1, "", "en", None, 0), (None, "the and of", None, "s", 1)], docs.schema)
    for _, stage in corpus_pipeline.STAGES[:3]:
        docs = corpus_pipeline.cut_lineage(stage(spark, docs.union(odd), DATA))
    assert docs.count() > 0
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, odd.limit(0), DATA).count() == 0


def test_near_copies_from_four_fifths_are_dropped(spark):
    """Texts of 100 shingles that share their first 90 (90/110), 89 (89/111) and 88 (88/112) with the one before."""
    rows, at = [], 0
    for shared in (90, 89, 88):
        words = [f"v{at + k}" for k in range(104)]
        other = words[: shared + 4] + [f"u{at + k}" for k in range(100 - shared)]
        rows += [(at + k, " ".join(w), "en", "s", 0) for k, w in enumerate((words, other))]
        at += 1000
    schema = "doc_id long, text string, lang string, source string, n_chars int"
    kept = corpus_pipeline.drop_near_duplicates(spark, spark.createDataFrame(rows, schema), DATA)
    assert sorted(r.doc_id for r in kept.collect()) == [0, 1000, 2000, 2001]
