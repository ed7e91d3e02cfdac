"""Token ids in compressed blocks with a shared dictionary (operator 10).

A table of blocks in Parquet.  Documents stand in ascending doc_id order; each
is compressed alone against one dictionary trained on serialized id arrays, so
that a short document is read by its offset without its neighbours and still
compresses well.  Columns of a block:

part, block        place of the block: blocks in this order hold ascending ids
least_id, greatest_id  bounds of the ids in the block, for scans that seek one
doc_ids            documents of the block (null ids come first)
n_tokens           ids in each, with the end id
offsets            n + 1 byte offsets of the documents' frames in ``frames``
dictionary_sha256  hash of the dictionary that the frames need
frames             zstandard frames, one after another

The dictionary lies beside the blocks as a table of one row.  Spark writes and
commits both, so the output is whole whatever executors are lost.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from isoframe.llm.scratch import written
from isoframe.llm.textkit import arrow_slices
from isoframe.llm.tokens import encoder

END_ID = 2
#: Documents, and first ids of each, that the dictionary is trained on at most.
SAMPLE_DOCS, SAMPLE_IDS = 2000, 4096
DICTIONARY_BYTES = 64 << 10
#: Compressed bytes after which a block is closed.
BLOCK_BYTES = 1 << 20

BLOCKS = (
    "part int, block int, least_id long, greatest_id long, doc_ids array<long>, n_tokens array<long>, offsets array<long>, "
    "dictionary_sha256 string, frames binary"
)
NAMES = [c.split()[0] for c in BLOCKS.split(", ")]
ROWS = "part int, block int, place int, doc_id long, n_tokens long, ids_crc32 long"


def train_dictionary(docs: DataFrame, vocabulary: str, end_id: int = END_ID) -> bytes:
    """A zstandard dictionary from a bounded sample of documents.

    The sample is the SAMPLE_DOCS rows of smallest hashed doc_id, and at most
    SAMPLE_IDS ids of each.  Too small a sample gives an empty dictionary.
    """
    import zstandard

    def serialized(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode, end = encoder(vocabulary), np.array([end_id], "<u4").tobytes()
        for batch in batches:
            yield pd.DataFrame({"ids": [(encode.ids(t) + end)[: 4 * SAMPLE_IDS] for t in batch.text]})

    # SAMPLE_DOCS ids; rows of equal doc_id come with theirs, so the second limit.
    chosen = docs.select("doc_id").where("doc_id IS NOT NULL").orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_DOCS).distinct()
    texts = docs.join(F.broadcast(chosen), "doc_id").select(F.substring("text", 1, 4 * SAMPLE_IDS).alias("text")).limit(SAMPLE_DOCS)
    samples = [bytes(r["ids"]) for r in texts.mapInPandas(serialized, "ids binary").collect()]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, level=3).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b""


def _frames(docs: DataFrame, vocabulary: str, dictionary: bytes, end_id: int) -> DataFrame:
    """doc_id, n_tokens and the compressed ids of each row."""
    import zstandard

    # At most DICTIONARY_BYTES.
    shared = docs.sparkSession.sparkContext.broadcast(dictionary)

    def compressed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(vocabulary), np.array([end_id], "<u4").tobytes()
        press = zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(shared.value) if shared.value else None)
        for batch in batches:
            for a, b, raw in arrow_slices(batch.column("text")):
                ids = [encode.ids(text.decode()) + end for text in raw]
                counts = pa.array([len(x) // 4 for x in ids], pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(a, b - a), counts, pa.array(map(press.compress, ids), pa.binary())], ["doc_id", "n_tokens", "frame"])

    return docs.mapInArrow(compressed, "doc_id long, n_tokens long, frame binary")


def write_tokens(docs: DataFrame, path: str, vocabulary: str, end_id: int = END_ID) -> None:
    """Encode every whole text and write it in the block format under ``path``.

    A null text is empty: its ids are the end id alone.  Rows of equal doc_id
    are all kept, in order of their frames; other columns of ``docs`` aren't
    used.  An empty table gives a table without blocks.

    Texts are encoded where they lie; only the compressed frames are sorted.
    """
    spark = docs.sparkSession
    plain = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    dictionary = train_dictionary(plain, vocabulary, end_id)
    digest = hashlib.sha256(dictionary).hexdigest()
    spark.createDataFrame([(digest, bytearray(dictionary))], "dictionary_sha256 string, dictionary binary").coalesce(1).write.parquet(f"{path}/dictionary")
    # Written, since a range partitioning reads its input twice.
    frames = written(_frames(plain, vocabulary, dictionary, end_id), "frames")

    def blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        part, block = TaskContext.get().partitionId(), 0
        doc_ids, n_tokens, offsets, kept = [], [], [0], []

        def closed() -> pd.DataFrame:
            known = [x for x in doc_ids if x is not None]
            row = (part, block, min(known, default=None), max(known, default=None), doc_ids, n_tokens, offsets, digest, b"".join(kept))
            return pd.DataFrame([row], columns=NAMES).astype({"least_id": "Int64", "greatest_id": "Int64"})

        for batch in batches:
            for doc_id, n, frame in zip(batch.doc_id.astype("object"), batch.n_tokens.tolist(), batch.frame, strict=True):
                kept.append(frame)
                doc_ids.append(None if pd.isna(doc_id) else int(doc_id))
                n_tokens.append(n)
                offsets.append(offsets[-1] + len(frame))
                if offsets[-1] >= BLOCK_BYTES:
                    yield closed()
                    block, doc_ids, n_tokens, offsets, kept = block + 1, [], [], [0], []
        if doc_ids:
            yield closed()

    # Equal ids share a partition; the frame breaks ties, so a retry writes the same.
    by_id = F.col("doc_id").asc_nulls_first()
    ordered = frames.repartitionByRange(by_id).sortWithinPartitions(by_id, "n_tokens", "frame")
    ordered.mapInPandas(blocks, BLOCKS).write.parquet(f"{path}/blocks")


def _dictionary(spark: SparkSession, path: str) -> tuple[str, bytes]:
    row = spark.read.parquet(f"{path}/dictionary").head()
    return row["dictionary_sha256"], bytes(row["dictionary"])


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """Documents of a written table: doc_id, start, n_tokens, ids_crc32.

    ``start`` counts the ids of all documents before; it comes from sums over
    blocks, then over parts, so that no task sees all documents.
    """
    import zstandard

    digest, dictionary = _dictionary(spark, path)
    shared = spark.sparkContext.broadcast(dictionary)

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(shared.value) if shared.value else None)
        for batch in batches:
            for i in range(batch.num_rows):
                part, block, doc_ids, at, needs, frames = (batch.column(c)[i] for c in ("part", "block", "doc_ids", "offsets", "dictionary_sha256", "frames"))
                if needs.as_py() != digest:
                    raise ValueError(f"block {part}.{block} needs another dictionary")
                frames, at = memoryview(frames.as_buffer()), at.as_py()
                ids = [press.decompress(frames[a:b]) for a, b in zip(at, at[1:])]
                n = len(ids)
                columns = [pa.array(np.full(n, part.as_py()), pa.int32()), pa.array(np.full(n, block.as_py()), pa.int32()), pa.array(range(n), pa.int32()), pa.concat_arrays([doc_ids.values])]
                columns += [pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array([zlib.crc32(x) for x in ids], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in ROWS.split(", ")])

    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks")
    rows = blocks.select("part", "block", "doc_ids", "offsets", "dictionary_sha256", "frames").mapInArrow(documents, ROWS)
    sizes = blocks.select("part", "block", F.aggregate("n_tokens", F.lit(0).cast("long"), lambda s, x: s + x).alias("n"))
    parts = sizes.groupBy("part").agg(F.sum("n").alias("n"))
    # A row for each file that was written.
    before_part = parts.select("part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before_part"))
    before = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    begins = sizes.select("part", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")).join(before_part, "part")
    running = Window.partitionBy("part", "block").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    return rows.join(begins, ["part", "block"]).select(
        "doc_id", (F.col("before_part") + F.col("before") + F.coalesce(F.sum("n_tokens").over(running), F.lit(0))).alias("start"), "n_tokens", "ids_crc32",
    )


def read_document(spark: SparkSession, path: str, doc_id: int) -> np.ndarray | None:
    """Ids of one document, found by the index and decompressed alone.

    The least and greatest ids let the scan skip the files and row groups that
    can't hold it; of rows with equal ids, one is read.
    """
    import zstandard

    _, dictionary = _dictionary(spark, path)
    at = F.expr(f"array_position(doc_ids, {int(doc_id)}L)").cast("int")
    may = (F.col("least_id") <= int(doc_id)) & (F.col("greatest_id") >= int(doc_id))
    found = spark.read.schema(BLOCKS).parquet(f"{path}/blocks").where(may).withColumn("at", at).where("at > 0")
    row = found.select(F.expr("substring(frames, int(offsets[at - 1]) + 1, int(offsets[at] - offsets[at - 1]))").alias("frame")).head()
    if row is None:
        return None
    press = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)
    return np.frombuffer(press.decompress(bytes(row["frame"])), "<u4")
