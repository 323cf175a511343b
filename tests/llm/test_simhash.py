from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from quartier.llm import queries, simhash
from quartier.llm.groups import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(text):
    words = WORD.findall((text or "").translate(LOWER))
    shingles = [" ".join(words[k : k + 3]) for k in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def groups(points: list[int]) -> list[int]:
    """The place of the first member of each point's component, by comparing all pairs."""
    values = np.array(points, dtype=np.uint64)
    label = list(range(len(points)))
    for i in range(len(points)):
        for j in np.flatnonzero(np.bitwise_count(values[:i] ^ values[i]) <= 3).tolist():
            x, y = sorted((label[i], label[j]))
            if x != y:
                label = [x if other == y else other for other in label]
    return label


def docs_of(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    return df.select("*", F.lit("?").alias("fp"), F.lit("?").alias("part"), F.lit("?").alias("component_id"))


def test_equals_all_pairs_of_texts(spark):
    pick = random.Random(4)
    words = [f"w{k}" for k in range(2000)]
    rows = [(900, None), (901, ""), (902, " \n"), (903, "One"), (904, "one\ttwo"), (905, "ONE two"), (906, "É é x")]
    for n in (3, 20, 150, 400):
        for _ in range(12):
            base = pick.choices(words, k=n)
            rows += [(len(rows), " ".join(base)), (len(rows) + 1000, " ".join(base).upper())]
            for edits in (1, 1, 2, 4):
                other = list(base)
                for _ in range(edits):
                    other[pick.randrange(n)] = pick.choice(words)
                rows.append((len(rows) + 5000, "  ".join(other)))
    rows.append((99_999, "long " * 200_000))
    pick.shuffle(rows)
    rows.sort(key=lambda r: r[0])
    got = {r.doc_id: r for r in simhash.near_duplicates(docs_of(spark, rows)).collect()}
    prints = {i: plain(text) for i, text in rows}
    assert {i: r.fingerprint for i, r in got.items()} == {i: f"{value:016x}" for i, value in prints.items()}
    ids = [i for i, _ in rows]
    want = groups([prints[i] for i in ids])
    assert {i: got[i].component_id for i in ids} == {i: ids[w] for i, w in zip(ids, want)}
    assert len(set(want)) < len(ids) - 60


def near(pick, point, most):
    for bit in pick.sample(range(64), pick.randint(0, most)):
        point ^= 1 << bit
    return point


@pytest.mark.parametrize("tile, step", [(2048, 32_768), (8, 16)])
def test_links_join_all_close_fingerprints(spark, monkeypatch, tile, step):
    monkeypatch.setattr(simhash, "TILE", tile)
    monkeypatch.setattr(simhash, "STEP", step)
    pick = random.Random(tile)
    points = {0, (1 << 64) - 1, 7, 15}
    for _ in range(150):
        base = pick.getrandbits(64)
        points |= {near(pick, base, 5) for _ in range(4)}
    crowd = pick.getrandbits(64)
    points |= {near(pick, crowd, 9) for _ in range(150)}
    chain = pick.getrandbits(64)
    for _ in range(40):
        chain = near(pick, chain, 3)
        points.add(chain)
    points = sorted(points)
    classes = spark.createDataFrame([(simhash._signed(p),) for p in points], "fp long").repartition(3)
    links = simhash._links(classes)
    found = {r.cid % 2**64: r.comp for r in components(links).collect()}
    want = groups(points)
    got = [found.get(p, simhash._signed(p)) for p in points]
    assert len(set(zip(got, want))) == len(set(got)) == len(set(want))


def test_tables_discard_no_close_pair():
    pick = random.Random(9)
    a = [pick.getrandbits(64) for _ in range(500)]
    b = [near(pick, x, 3) for x in a]
    points = np.array(a + b + [pick.getrandbits(64) for _ in range(500)], dtype=np.uint64)
    table = np.bitwise_count(points[:, None] ^ points[None, 1000:1032]).astype(np.int8)
    first = np.arange(500)
    assert len(simhash.may_link(table, first, first + 500)) == 500
    assert len(simhash.may_link(table, first, first + 1000)) < 25


def test_edge_rows(spark):
    schema = "doc_id long, text string"
    assert simhash.near_duplicates(spark.createDataFrame([], schema)).count() == 0
    rows = [(1, "a b c"), (1, "a b c"), (None, "A b  c"), (None, "x"), (None, None), (5, "")] + [(9, "same text here")] * 300
    got = simhash.near_duplicates(spark.createDataFrame(rows, schema)).collect()
    assert len(got) == len(rows)
    found = sorted({(r.doc_id or -1, r.component_id or -1, r.fingerprint) for r in got})
    abc, x, same = (f"{plain(t):016x}" for t in ("a b c", "x", "same text here"))
    zero = "0" * 16
    assert found == sorted([(1, 1, abc), (-1, 1, abc), (-1, -1, x), (-1, 5, zero), (5, 5, zero), (9, 9, same)])


def test_query_on_the_given_documents(spark):
    sf_dir = "/root/testdata/sf0.001"
    got = queries.op11_simhash(spark, sf_dir)
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    rows = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect())
    prints = [plain(text) for _, text in rows]
    want = [(i, f"{p:016x}", rows[w][0]) for (i, _), p, w in zip(rows, prints, groups(prints))]
    assert sorted(tuple(r) for r in got.collect()) == want
