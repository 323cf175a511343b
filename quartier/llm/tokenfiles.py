"""Token files: each document's ids compressed by itself with a shared zstandard dictionary, behind an offset index.

A file set is a folder with two Parquet tables, so that Spark's own commit protocol keeps it whole when executors are lost
and any store that Spark reads will do.

``dictionary``: one row (dict_hash, content). The dictionary is trained on the serialized ids of a bounded sample.
``blocks``: rows (part, block, before, first_id, last_id, n_tokens, dict_hash, width, doc_ids, counts, offsets, frames). ``frames``
holds the documents' zstandard frames end to end; document i lies in frames[offsets[i]:offsets[i + 1]] and has counts[i]
ids of ``width`` bytes, little-endian; ``before`` ids
precede the block in its part. Blocks and documents are in ascending id order, null ids first. A short document is
read by its block's row (Parquet statistics on first_id and last_id skip the others) and its own frame alone.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string

from quartier.llm.arrow import STEP_ROWS, map_rows
from quartier.llm.encoding import PartEncoder, id_bytes, task_encoder

#: Documents, and characters of each, that the dictionary is trained on; and its size in bytes.
SAMPLE_DOCS = 1000
SAMPLE_CHARS = 4000
DICTIONARY_BYTES = 32_768
#: A block ends with the document that takes its frames beyond this.
BLOCK_BYTES = 1 << 20
LEVEL = 3

_BLOCKS = (
    "part int, block int, before long, first_id long, last_id long, n_tokens long, dict_hash long, width int, "
    "doc_ids array<long>, counts array<long>, offsets array<long>, frames binary"
)


def _serialize(ids: bytes, width: int) -> bytes:
    return ids if width == 4 else np.frombuffer(ids, "<u4").astype("<u2").tobytes()


def train_dictionary(docs: DataFrame, tokenizer: str, end_id: int, id_col: str, text_col: str) -> bytes:
    """A dictionary from the ``SAMPLE_DOCS`` documents of least id hash; no bytes if they are too few to train on."""
    hashes = docs.select(F.xxhash64(id_col).alias("h"))
    last = hashes.orderBy("h").limit(SAMPLE_DOCS).agg(F.max("h")).first()[0]
    if last is None:
        return b""
    sample = docs.select(F.xxhash64(id_col).alias("h"), F.substring(text_col, 1, SAMPLE_CHARS).alias("t"))
    texts = [r.t for r in sample.where(F.col("h") <= last).orderBy("h", "t").limit(SAMPLE_DOCS).collect()]
    width, end = id_bytes(tokenizer), np.array([end_id], dtype="<u4").tobytes()
    samples = [_serialize(ids + end, width) for ids in PartEncoder(tokenizer).encode(texts)]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b""


def dictionary_hash(content: bytes) -> int:
    return zlib.crc32(content)


class _Block:
    def __init__(self) -> None:
        self.ids: list[int | None] = []
        self.counts: list[int] = []
        self.offsets = [0]
        self.frames: list[bytes] = []

    def add(self, key: int | None, count: int, frame: bytes) -> bool:
        """Add a document; whether the block is full."""
        self.ids.append(key)
        self.counts.append(count)
        self.offsets.append(self.offsets[-1] + len(frame))
        self.frames.append(frame)
        return self.offsets[-1] > BLOCK_BYTES

    def row(self, part: int, block: int, before: int, dict_hash: int, width: int) -> tuple:
        known = [i for i in self.ids if i is not None]
        ends = (known[0], known[-1]) if known else (None, None)
        head = part, block, before, *ends, sum(self.counts), dict_hash, width
        return *head, self.ids, self.counts, self.offsets, b"".join(self.frames)


def write_token_files(
    docs: DataFrame, path: str, tokenizer: str, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text",
) -> None:
    """Write the ids of every text, each with ``end_id``, to ``path`` in ascending id order.

    A null or empty text is the end id alone. Rows with the same id stay documents of their own, next to each other, in the
    order of their texts' hashes. Further columns are not looked at. An empty table gives a file set without blocks.
    """
    spark = docs.sparkSession
    content = train_dictionary(docs, tokenizer, end_id, id_col, text_col)
    dict_hash, width = dictionary_hash(content), id_bytes(tokenizer)
    spark.createDataFrame([(dict_hash, content)], "dict_hash long, content binary").write.parquet(f"{path}/dictionary")
    end = np.array([end_id], dtype="<u4").tobytes()
    kind = _parse_datatype_string(_BLOCKS)
    assert isinstance(kind, StructType)
    arrow = to_arrow_schema(kind)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = task_encoder(tokenizer)
        shared = zstandard.ZstdCompressionDict(content) if content else None
        pack = zstandard.ZstdCompressor(level=LEVEL, dict_data=shared, write_checksum=True).compress
        part, number, before, block = TaskContext.get().partitionId(), 0, 0, _Block()

        def done() -> pa.RecordBatch:
            row = block.row(part, number, before, dict_hash, width)
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, arrow)], schema=arrow)

        for batch in batches:
            for start in range(0, batch.num_rows, STEP_ROWS):
                keys, texts = (c.to_pylist() for c in batch.slice(start, STEP_ROWS).columns[:2])
                for key, ids in zip(keys, encoder.encode(texts)):
                    if block.add(key, len(ids) // 4 + 1, pack(_serialize(ids + end, width))):
                        yield done()
                        number, before, block = number + 1, before + sum(block.counts), _Block()
        if block.ids:
            yield done()

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    ordered = rows.repartitionByRange("id").sortWithinPartitions("id", F.xxhash64("text"))
    ordered.mapInArrow(write, kind).write.parquet(f"{path}/blocks")


def _decoder(content: bytes) -> Callable[[bytes, int], np.ndarray]:
    shared = zstandard.ZstdCompressionDict(content) if content else None
    unpack = zstandard.ZstdDecompressor(dict_data=shared).decompress
    return lambda frame, width: np.frombuffer(unpack(frame), f"<u{width}").astype("<u4")


def _opened(spark: SparkSession, path: str) -> tuple[DataFrame, bytes]:
    """The blocks, each with the token count before it, and the dictionary. The blocks' hashes must be the dictionary's."""
    ((dict_hash, content),) = spark.read.parquet(f"{path}/dictionary").select("dict_hash", "content").collect()
    if dictionary_hash(content) != dict_hash:
        raise ValueError("the dictionary is not the one that was written")
    blocks = spark.read.schema(_BLOCKS).parquet(f"{path}/blocks")
    # One row per part, and parts are as many as one write had tasks: a small table for one window.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = blocks.groupBy("part").agg(F.sum("n_tokens").alias("_n"))
    parts = parts.select("part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_part_start"))
    good = F.when(F.col("dict_hash") == dict_hash, F.col("frames")).otherwise(F.raise_error(F.lit("other dictionary")))
    blocks = blocks.withColumn("frames", good).join(parts, "part")
    return blocks.withColumn("start", F.col("_part_start") + F.col("before")), content


def read_documents(spark: SparkSession, path: str, wanted: list[int] | None = None) -> DataFrame:
    """(doc_id, start, ids) of the documents, ids as little-endian unsigned 32-bit numbers; ``start`` counts all before.

    With ``wanted``, a short list of ids, only their blocks' rows are read and only their frames decompressed.
    """
    blocks, content = _opened(spark, path)
    if wanted is not None:
        covers = [(F.col("first_id") <= i) & (F.col("last_id") >= i) for i in wanted]
        blocks = blocks.where(F.reduce(F.array(*covers), F.lit(False), lambda a, b: a | b) if covers else F.lit(False))
    keep = set(wanted) if wanted is not None else None

    def work():
        decode = _decoder(content)

        def step(start: list, width: list, ids: list, counts: list, offsets: list, frames: list) -> Iterator[tuple]:
            for first, w, own, ns, cuts, raw in zip(start, width, ids, counts, offsets, frames):
                for key, n, a, b in zip(own, ns, cuts, cuts[1:]):
                    if keep is None or key in keep:
                        yield key, first, decode(raw[a:b], w).tobytes()
                    first += n

        return step

    columns = blocks.select("start", "width", "doc_ids", "counts", "offsets", "frames")
    return map_rows(columns, "doc_id long, start long, ids binary", work)


def digests(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from its decompressed ids."""
    blocks, content = _opened(spark, path)

    def work():
        decode = _decoder(content)

        def step(start: list, width: list, ids: list, counts: list, offsets: list, frames: list) -> Iterator[tuple]:
            for first, w, own, cuts, raw in zip(start, width, ids, offsets, frames):
                for key, a, b in zip(own, cuts, cuts[1:]):
                    found = decode(raw[a:b], w)
                    yield key, first, len(found), zlib.crc32(found.tobytes())
                    first += len(found)

        return step

    columns = blocks.select("start", "width", "doc_ids", "counts", "offsets", "frames")
    return map_rows(columns, "doc_id long, start long, n_tokens long, ids_crc32 long", work)
