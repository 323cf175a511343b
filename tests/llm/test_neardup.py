from __future__ import annotations

import random
import re
import tracemalloc

import pytest
import xxhash

from quartier.llm import neardup
from quartier.llm.words import WordHashes

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(texts: dict[int, str | None], percent: int = 85) -> dict[int, tuple[int, int]]:
    """(set size, least id of the component) by comparing all pairs."""
    sets = {}
    for i, text in texts.items():
        words = WORD.findall((text or "").translate(LOWER))
        whole = {tuple(words[k : k + 5]) for k in range(len(words) - 4)} or ({tuple(words)} if words else set())
        sets[i] = whole
    parent = {i: i for i in texts}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(texts)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {i: (len(sets[i]), root(i)) for i in ids}


def corpus(seed: int = 3) -> dict[int, str | None]:
    pick = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(3000)]
    passage = " ".join(pick.choices(vocabulary, k=60))

    def text(n):
        return pick.choices(vocabulary, k=n)

    def edited(words, edits):
        words = list(words)
        for _ in range(edits):
            words[pick.randrange(len(words))] = pick.choice(vocabulary)
        return words

    out: list[str | None] = [None, "", " \n", "one", "One", "one two three", "ONE two\tthree", "\x1c a b c d e"]
    for n in (8, 30, 120, 200, 700):
        for _ in range(4):
            base = text(n)
            out += [" ".join(base), " ".join(base).upper(), " ".join(base)]
            out += [" ".join(edited(base, e)) for e in (1, 1, 2, max(1, n // 60), max(1, n // 40), max(1, n // 30), n // 10)]
    hub = text(300)
    out += [" ".join(edited(hub, pick.randint(1, 6))) for _ in range(60)]
    out += [passage + " " + " ".join(text(pick.randint(5, 80))) for _ in range(60)]
    chain = text(150)
    for _ in range(30):
        chain = edited(chain, 1)
        out.append(" ".join(chain))
    pick.shuffle(out)
    return dict(enumerate(out))


@pytest.mark.parametrize("short, tile", [(48, 512), (2, 8)])
def test_equals_all_pairs(spark, monkeypatch, short, tile):
    monkeypatch.setattr(neardup, "SHORT", short)
    monkeypatch.setattr(neardup, "TILE", tile)
    texts = corpus()
    docs = spark.createDataFrame([(i, t, "?", "?", "?") for i, t in texts.items()], "doc_id long, text string, n string, cid string, kept string")
    got = {r.doc_id: r for r in neardup.near_duplicates(docs.repartition(4)).collect()}
    want = brute(texts)
    assert len(got) == len(texts)
    assert {i: (r.n_shingles, r.component_id) for i, r in got.items()} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got.values())


def test_edge_rows(spark):
    schema = "doc_id long, text string"
    assert neardup.near_duplicates(spark.createDataFrame([], schema)).count() == 0
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (None, "x y"), (2, None), (2, "")]
    got = neardup.near_duplicates(spark.createDataFrame(rows, schema)).collect()
    found = sorted((r.doc_id or 0, r.n_shingles, r.component_id or 0, r.kept) for r in got)
    assert found == [(0, 1, 0, True), (0, 2, 1, False), (1, 2, 1, True), (1, 2, 1, True), (2, 0, 2, True), (2, 0, 2, True)]


def test_shared_values_have_a_sound_bound():
    pick = random.Random(5)
    for n in (20, 100, 128, 150, 400, 3000):
        union = n + n * 15 // 85
        for _ in range(200):
            least = sorted(pick.sample(range(10**9), union))[: neardup.SKETCH]
            common = pick.sample(range(union), -(-85 * union // 100))
            shared = sum(1 for k in common if k < len(least))
            assert shared >= neardup.shared_at_least(n, 85)


def test_rows_without_ids_cost_no_more_than_others(spark):
    """Every row has the same (null) id, so only texts tell them apart."""
    pick = random.Random(6)
    texts = [" ".join(pick.choices([f"w{k}" for k in range(500)], k=150)) for _ in range(400)]
    texts += [t + " end" for t in texts[:100]]
    rows = [(None, t) for t in texts]
    got = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))
    assert got.count() == 500 and got.where("kept AND component_id IS NULL").count() == 500


def test_a_crowd_at_the_threshold_in_small_tiles(spark, monkeypatch):
    """Copies of one text with some words changed each: many pairs just below and above the threshold, in long lists."""
    monkeypatch.setattr(neardup, "SHORT", 4)
    monkeypatch.setattr(neardup, "TILE", 16)
    pick = random.Random(12)
    words = [f"w{k}" for k in range(4000)]
    base = pick.choices(words, k=260)
    texts = {}
    for i in range(120):
        other = list(base)
        for place in pick.sample(range(260), pick.choice([3, 5, 6, 8])):
            other[place] = pick.choice(words)
        texts[i] = " ".join(other)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.near_duplicates(docs, percent=80).collect()}
    assert got == brute(texts, percent=80)


def test_hashing_words_holds_no_memory():
    hashes, texts = WordHashes(), [[b"word %d" % k for k in range(first, first + 1000)] for first in range(0, 100_000, 1000)]
    tracemalloc.start()
    for words in texts:
        assert hashes.of(words)[-1] == xxhash.xxh3_64_intdigest(words[-1])
    held = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert held < 1_000_000
    assert hashes.of([]).dtype == "uint64" and not len(hashes.of([]))


def test_reading_texts_leaves_no_large_direct_buffers(spark, tmp_path):
    """One file whose column of texts is one chunk of about 16 MB."""
    pick = random.Random(8)
    rows = [(i, pick.randbytes(2048).hex()) for i in range(4000)]
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(str(tmp_path / "docs"))
    bean = spark._jvm.java.lang.Class.forName("java.lang.management.BufferPoolMXBean")
    pools = list(spark._jvm.java.lang.management.ManagementFactory.getPlatformMXBeans(bean))
    direct = next(pool for pool in pools if pool.getName() == "direct")
    spark._jvm.java.lang.System.gc()
    before = direct.getMemoryUsed()
    assert neardup.sketches(spark.read.parquet(str(tmp_path / "docs"))).where("n > 0").count() == 4000
    assert direct.getMemoryUsed() - before < 6_000_000
