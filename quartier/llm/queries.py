"""The registered queries of the operators, each over its whole table with production parameters."""

from __future__ import annotations

import string

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from quartier.llm import (
    hardneg, language, manifest, neardup, packing, pieces, prefixes, quality, sharding, simhash, tokenfiles, toxicity, vectors,
)
from quartier.session import cut_lineage, scratch_path

BYTE_BPE, WORD_BPE, PIECE_BPE = "byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE))


def op2_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(_table(spark, sf_dir, "documents"), percent=85).drop("text_hash")


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(_table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    scored = toxicity.score(docs, toxicity.fit(docs, _table(spark, sf_dir, "labels")))
    predicted = (F.col("score") >= 0.5).cast("int").alias("predicted")
    return scored.select("doc_id", toxicity.held_out().alias("held_out"), "score", predicted, F.size("passages").alias("n_passages"))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = sharding.interleave(_table(spark, sf_dir, "documents"), shards=40)
    return shards.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "source",
    )


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts at every prefix are kept as a table; the total, and how much fits the limit, are read from it."""
    limit = 2048
    docs = _table(spark, sf_dir, "documents")
    kept = cut_lineage(prefixes.prefix_counts(docs, public_tokenizers.path(WORD_BPE)).drop("n_tokens"))
    characters = F.expr("octet_length(changes) div 2")
    n_tokens = prefixes.tokens_of_prefix(F.col("changes"), characters)
    fits = prefixes.longest_within(F.col("changes"), F.lit(limit))
    counts = kept.select("doc_id", "n_bytes", n_tokens.alias("n_tokens"), fits.alias("characters_within_limit"))
    return counts.withColumn("over_limit", F.col("n_tokens") > limit)


def op7_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _table(spark, sf_dir, "embeddings")
    return vectors.neighbours(table, F.col("vec_id") % 20 == 0, k=20)


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode_digests(_table(spark, sf_dir, "documents"), public_tokenizers.path(PIECE_BPE))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and pages: only pages declare a language in markup and have addresses, so each table has its evidence."""
    docs = _table(spark, sf_dir, "documents")
    model = language.fit(docs)
    none, key = F.lit(None).cast("long"), F.col("key")
    told = ["lang", "posterior", "text_lang", "declared", F.col("accepted").alias("kept")]
    of_docs = language.identify_documents(docs, model).select(key.alias("doc_id"), none.alias("page_id"), *told)
    pages = language.identify_pages(_table(spark, sf_dir, "pages"), model)
    return of_docs.union(pages.select(none.alias("doc_id"), key.alias("page_id"), *told))


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "tokens")
    tokenfiles.write_token_files(_table(spark, sf_dir, "documents"), path, public_tokenizers.path(WORD_BPE), end_id=1)
    return tokenfiles.digests(spark, path)


def op11_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row proved against the manifest; every third row, by a CRC of its id, with its letters A-Z lowered."""
    docs = _table(spark, sf_dir, "documents")
    columns = ["doc_id", "source", "lang", "n_chars", "text"]
    lowered = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    tampered = manifest.row_digest(*(F.col(c) for c in columns[:-1]), lowered)
    touched = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    built = manifest.build(
        docs, manifest.row_digest(*(F.col(c) for c in columns)),
        keep={"doc_id": F.col("doc_id"), "shown": F.when(touched, tampered)},
    )
    proved = manifest.proofs(built).withColumn("root", F.lit(built.root))
    folded = manifest.fold(F.coalesce("shown", "leaf"), F.col("path"))
    return proved.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(manifest.siblings(F.col("path")), 256).alias("proof_sha256"),
        folded.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of every seventh row are changed first, as the task sets them."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hardneg.mine(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, label)


QUERIES = {
    "op1_packing": op1_packing,
    "op2_neardup": op2_neardup,
    "op3_quality": op3_quality,
    "op4_toxicity": op4_toxicity,
    "op5_sharding": op5_sharding,
    "op6_token_counts": op6_token_counts,
    "op7_neighbours": op7_neighbours,
    "op8_sentencepiece": op8_sentencepiece,
    "op9_language_id": op9_language_id,
    "op10_token_files": op10_token_files,
    "op11_simhash": op11_simhash,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_hard_negatives": op13_hard_negatives,
    "pipeline": corpus_pipeline.run,
}

# --- SQL, only where DuckDB can state the whole result -------------------------------------------------------------


def _framed(value: str) -> str:
    return f"coalesce(strlen(CAST({value} AS VARCHAR)) || ':' || CAST({value} AS VARCHAR), '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(_framed(v) for v in ("doc_id", "source", "lang", "n_chars", text)) + ")"


_LOWERED = f"translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
_CRC32 = """xor(list_reduce(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT)),
    lambda c, b: list_reduce(range(8), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)), xor(c, b)), 4294967295), 4294967295)"""


def _levels(name: str, base: str) -> str:
    """All nodes above those of ``base`` (level, g, i, h, n), and the runs of siblings among them."""
    return f"""{name}(level, g, i, h, n) AS (
    {base}
    UNION ALL
    SELECT level + 1, g, i // 8, sha256(string_agg(h, '' ORDER BY i)), (n + 7) // 8
    FROM {name} WHERE n > 1 GROUP BY level, g, i // 8, n
), {name}_runs AS (
    SELECT level, g, i // 8 AS run, list(h ORDER BY i) AS kids FROM {name} WHERE n > 1 GROUP BY ALL
)"""


def _steps(leaf: str, runs: str, g: str, i: str) -> str:
    """For each leaf its siblings to the left and right, level by level."""
    own = f"({i} >> CAST(3 * level AS BIGINT)) % 8"
    return f"""SELECT id, list(array_to_string(kids[1:{own}], '') || '|' || array_to_string(kids[{own} + 2:], '') ORDER BY level) AS steps
    FROM {leaf} JOIN {runs} ON {runs}.g = {g} AND run = {i} >> CAST(3 * level + 3 AS BIGINT) GROUP BY id"""


_MERKLE = f"""WITH RECURSIVE leaves AS (
    SELECT row_number() OVER () AS id, doc_id, coalesce('=' || lang, '') AS g, {_leaf("text")} AS leaf,
           CASE WHEN {_CRC32} % 3 = 0 THEN {_leaf(_LOWERED)} ELSE {_leaf("text")} END AS shown
    FROM documents
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
           count(*) OVER (PARTITION BY g) AS n FROM leaves
), {_levels("node", "SELECT 0, g, i, leaf, n FROM placed")}, subroots AS (
    SELECT g AS lang, h AS subroot, row_number() OVER (ORDER BY g) - 1 AS ordinal, count(*) OVER () AS langs
    FROM node WHERE n = 1
), {_levels("upper", "SELECT 0, '', ordinal, subroot, langs FROM subroots")}, below AS (
    {_steps("placed", "node_runs", "placed.g", "placed.i")}
), above AS (
    {_steps("(SELECT ordinal AS id, * FROM subroots)", "upper_runs", "''", "ordinal")}
), proved AS (
    SELECT placed.doc_id, leaf, shown, subroot, (SELECT h FROM upper WHERE n = 1) AS root,
           list_concat(coalesce(below.steps, []), coalesce(above.steps, [])) AS steps
    FROM placed JOIN subroots ON placed.g = subroots.lang
    LEFT JOIN below ON placed.id = below.id LEFT JOIN above ON ordinal = above.id
), folded AS (
    SELECT doc_id, leaf, subroot, root, sha256(replace(array_to_string(steps, ''), '|', '')) AS proof_sha256,
           list_reduce(steps, lambda h, s: sha256(split_part(s, '|', 1) || h || split_part(s, '|', 2)), shown) AS folded_root
    FROM proved
) SELECT *, folded_root = root AS verified FROM folded"""

_HARD_NEGATIVES = """WITH taken AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), pair AS (
    SELECT a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id,
           CAST(list_sum(list_transform(list_zip(a.v, b.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
    FROM taken a JOIN taken b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
), positive AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM pair WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
), ranked AS (
    SELECT anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
           CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
    FROM positive JOIN pair USING (anchor_id)
    WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
) SELECT * FROM ranked WHERE rank <= 3"""

ORACLE_SQL: dict[str, str] = {
    "op13_hard_negatives": _HARD_NEGATIVES,
    "op12_merkle_manifest": _MERKLE,
}
