"""Documents to packed training sequences: language ID, toxicity, near-duplicates, packing.

Each stage reads all that its predecessor kept; every stage but the last returns the columns of ``documents``. Rows with one
id and one text are one document: from near-duplicates on, one of them is left.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quartier.llm import language, neardup, packing, toxicity
from quartier.session import cut_lineage

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: The stages call operators that SQL cannot express; tests hold them against brute force.
ORACLE_SQL = None


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified. Null and empty texts go: they are in no language."""
    model = language.fit(docs)
    evidence = cut_lineage(language.document_rows(docs, model, keep=COLUMNS))
    return language.fuse(evidence, model, keep=COLUMNS).where("accepted").select(*COLUMNS)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose probability of the toxic label is below one half."""
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score(docs, model, keep=COLUMNS).where("score < 0.5").select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, linked at a similarity of 0.8 or more: the one of least id."""
    found = cut_lineage(neardup.near_duplicates(docs, percent=80).where("kept"))
    kept = found.groupBy("doc_id", "text_hash").agg(F.count(F.lit(1)).alias("_rows")).alias("k")
    rows = docs.select(*COLUMNS, F.xxhash64(F.col("text").cast("string")).alias("_hash")).alias("d")
    same = F.col("d.doc_id").eqNullSafe(F.col("k.doc_id")) & (F.col("d._hash") == F.col("k.text_hash"))
    joined = rows.join(kept, same).select("d.*", "_rows")
    once = joined.where("_rows = 1").select(*COLUMNS)
    return once.union(joined.where("_rows > 1").dropDuplicates(["doc_id", "_hash"]).select(*COLUMNS))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document with its place in a sequence of 1024 tokens."""
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("language_id", keep_known_languages),
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's result on ``documents`` of ``sf_dir``; every stage but the last is kept as a table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(*COLUMNS)
    for name, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return docs
