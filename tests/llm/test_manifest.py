from __future__ import annotations

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from compare import connect, differences
from quartier.llm import manifest, queries

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, text):
    values = [row["doc_id"], row["source"], row["lang"], row["n_chars"], text]
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][k : k + 8])) for k in range(0, len(out[-1]), 8)])
    return out


def steps(built, i):
    for level in built[:-1]:
        run = level[i // 8 * 8 : i // 8 * 8 + 8]
        yield i % 8, run[: i % 8] + run[i % 8 + 1 :]
        i //= 8


def brute(rows):
    """What the query returns, node by node in Python."""
    groups = {}
    for row in rows:
        groups.setdefault(row["lang"], []).append((leaf(row, row["text"]), row))
    keys = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for key in keys:
        groups[key].sort(key=lambda x: (x[1]["doc_id"] is not None, x[1]["doc_id"] or 0, x[0]))
        trees[key] = levels([own for own, _ in groups[key]])
    top = levels([trees[key][-1][0] for key in keys])
    out = []
    for place, key in enumerate(keys):
        for i, (own, row) in enumerate(groups[key]):
            path = [*steps(trees[key], i), *steps(top, place)]
            text, shown = row["text"], own
            if row["doc_id"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 3 == 0:
                lowered = text if text is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
                shown = leaf(row, lowered)
            for index, others in path:
                shown = sha("".join(others[:index]) + shown + "".join(others[index:]))
            proof = sha("".join("".join(others) for _, others in path))
            out.append((row["doc_id"], own, trees[key][-1][0], top[-1][0], proof, shown, shown == top[-1][0]))
    return sorted(out, key=str)


def table(spark, tmp_path, rows):
    df = spark.createDataFrame([tuple(r[c] for c in ("doc_id", "text", "lang", "source", "n_chars")) for r in rows], SCHEMA)
    df = df.select("*", F.lit(1).alias("digest"), F.lit(2).alias("group"), F.lit(3).alias("position"), F.lit(4).alias("leaf"))
    df.repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path)


def row(i, lang, text="Some TEXT", source="s", n=3):
    return {"doc_id": i, "text": text, "lang": lang, "source": source, "n_chars": n}


CASES = {
    "empty": [],
    "one": [row(1, "en")],
    "eight": [row(k, "en", f"Text {k}") for k in range(8)],
    "many": [row(k, lang, f"É {k} " * (k % 5), None if k % 7 == 0 else "s") for lang, n in
             (("en", 521), (None, 9), ("fr", 64), ("de", 1), ("é", 65), ("z", 2)) for k in range(n)],
    "languages": [row(k, f"l{k % 70}", f"T{k}") for k in range(150)],
    "odd": [row(None, None, None, None, None), row(None, None, None, None, None), row(3, "en", ""), row(3, "en", ""),
            row(3, "en", "A"), *[row(5, "fr", "SAME")] * 140, row(-9, "fr", "x" * 100_000), row(6, "", "- 1:")],
}


@pytest.mark.parametrize("case", CASES)
def test_equals_a_plain_tree(spark, tmp_path, case):
    got = queries.op12_merkle_manifest(spark, table(spark, tmp_path, CASES[case]))
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(CASES[case])


def test_some_leaves_only(spark):
    docs = spark.createDataFrame([(k, "en" if k % 3 else "fr", str(k)) for k in range(700)], "doc_id long, lang string, text string")
    built = manifest.build(docs, manifest.row_digest(F.col("doc_id"), F.col("text")), keep={"doc_id": F.col("doc_id")})
    wanted = spark.createDataFrame([("=en", 5), ("=en", 5), ("=en", 460), ("=fr", 0), ("=fr", 99_999)], "group string, position long")
    some = {r.doc_id: r for r in manifest.proofs(built, wanted).collect()}
    every = {r.doc_id: r for r in manifest.proofs(built).collect()}
    assert len(some) == 3 and all(every[i] == r.asDict() or every[i].asDict() == r.asDict() for i, r in some.items())


def test_query_equals_sql(spark):
    sf_dir = "/root/testdata/sf0.001"
    name = "op12_merkle_manifest"
    assert differences(queries.QUERIES[name](spark, sf_dir), connect(sf_dir), queries.ORACLE_SQL[name]) == []
