"""Token-ID output in bit-plane files.

``write_ids`` tokenizes documents and writes their ids; ``read_docs`` reads the
files back.  The file format is a Parquet folder of *chunk* rows:

* ids are laid end to end in ascending document order and cut into blocks of a
  fixed number of ids (``block_ids``; the last block of a shard may be short),
* a block is transposed into planes - byte planes (plane j holds byte j of
  every id) or bit planes (plane j holds bit j, eight ids a byte) - and each
  plane is compressed with zstandard on its own; high planes are nearly
  constant and vanish,
* the other columns are the chunk index: shard, block, number of ids, first id's
  place in the shard, CRC-32 of the block, and the documents in the block with
  their offset and length.  Parquet stores columns apart, so reading the index
  doesn't touch the payload, and one document is read from its blocks alone.

A shard is what one task wrote.  Shards are ranges of (doc_id, text hash), so
shard order is document order, and a document's place in the whole stream is the
sum of the earlier shards' ids plus its place in the shard.

Scale: one range shuffle of the texts, no shuffle of ids or payloads.  A task holds
one Arrow batch, one open block and the words' memo (bounded in bytes).  Only per-shard totals (one row for
each task) are summed in one place.

Defined cases: null text is an empty document (only the end id); a null doc_id
sorts first; repeated doc_ids are kept, ordered by text; an empty table gives
empty files; a very long text is encoded whole and fills as many blocks as it needs;
further columns of the input, whatever their names, are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelkit.llm import common as C
from panelkit.llm.wordcache import word_ids

CHUNK = T.StructType([
    T.StructField("shard", T.LongType()), T.StructField("block", T.LongType()),
    T.StructField("first", T.LongType()), T.StructField("n_ids", T.LongType()),
    T.StructField("crc32", T.LongType()), T.StructField("layout", T.StringType()),
    T.StructField("planes", T.ArrayType(T.BinaryType())),
    T.StructField("ordinals", T.ArrayType(T.LongType())), T.StructField("doc_ids", T.ArrayType(T.LongType())),
    T.StructField("offsets", T.ArrayType(T.LongType())), T.StructField("lengths", T.ArrayType(T.LongType())),
])
PIECE = T.StructType([T.StructField(n, T.LongType()) for n in (
    "shard", "ordinal", "doc_id", "at", "n", "crc")])


def planes_of(ids: np.ndarray, layout: str) -> list[bytes]:
    """The planes of a block of unsigned 32-bit ids, low plane first."""
    raw = ids.astype("<u4").view(np.uint8).reshape(-1, 4)
    if layout == "byte":
        return [np.ascontiguousarray(raw[:, j]).tobytes() for j in range(4)]
    bits = np.unpackbits(raw, axis=1, bitorder="little")
    return [np.packbits(bits[:, j], bitorder="little").tobytes() for j in range(32)]


def ids_of(planes: list[bytes], n: int, layout: str) -> np.ndarray:
    """Inverse of ``planes_of``."""
    if layout == "byte":
        raw = np.stack([np.frombuffer(p, np.uint8, n) for p in planes], axis=1)
    else:
        bits = np.stack([np.unpackbits(np.frombuffer(p, np.uint8), count=n, bitorder="little") for p in planes], axis=1)
        raw = np.packbits(bits, axis=1, bitorder="little")
    return np.ascontiguousarray(raw).view("<u4").reshape(-1)


class _Writer:
    """Cuts the ids of one shard into blocks."""

    def __init__(self, shard: int, block_ids: int, layout: str, level: int):
        self.shard, self.size, self.layout = shard, block_ids, layout
        self.zip = zstandard.ZstdCompressor(level=level)
        self.block = self.ordinal = 0
        self._open()

    def _open(self):
        self.ids, self.held = [], 0
        self.ordinals, self.doc_ids, self.offsets, self.lengths = [], [], [], []

    def add(self, doc_id, ids: np.ndarray):
        """Take a document's ids; yields the rows of the blocks that it fills."""
        at = 0
        while at < len(ids):
            part = ids[at:at + self.size - self.held]
            self.ordinals.append(self.ordinal)
            self.doc_ids.append(doc_id)
            self.offsets.append(self.held)
            self.lengths.append(len(part))
            self.ids.append(part)
            self.held += len(part)
            at += len(part)
            if self.held == self.size:
                yield self.flush()
        self.ordinal += 1

    def flush(self) -> dict:
        ids = np.concatenate(self.ids)
        row = {
            "shard": self.shard, "block": self.block, "first": self.block * self.size, "n_ids": len(ids),
            "crc32": zlib.crc32(ids.astype("<u4").tobytes()), "layout": self.layout,
            "planes": [self.zip.compress(p) for p in planes_of(ids, self.layout)],
            "ordinals": self.ordinals, "doc_ids": self.doc_ids, "offsets": self.offsets, "lengths": self.lengths,
        }
        self.block += 1
        self._open()
        return row


def write_ids(docs: DataFrame, path: str, tokenizer: str, end_id: int | None = 1, block_ids: int = 1 << 16,
              layout: str = "byte", level: int = 3, cache_bytes: int = 64 << 20) -> None:
    """Tokenize ``docs`` (doc_id, text) and write the id files to ``path``."""
    spark = docs.sparkSession
    C.ship(spark)
    schema = C.arrow(CHUNK)

    def encode(batches):
        from pyspark import TaskContext

        words = word_ids(tokenizer, cache_bytes)
        out = _Writer(TaskContext.get().partitionId(), block_ids, layout, level)
        end = np.array([] if end_id is None else [end_id], np.uint32)
        for b in batches:
            for doc_id, text in zip(b.column("doc_id").to_pylist(), C.payloads(b, "text"), strict=True):
                for row in out.add(doc_id, np.concatenate([words.encode(text), end])):
                    yield pa.RecordBatch.from_pylist([row], schema)
        if out.held:
            yield pa.RecordBatch.from_pylist([out.flush()], schema)

    ordered = (C.texts(docs).withColumn("h", F.xxhash64("text"))
               .repartitionByRange(C.partitions(spark), "doc_id", "h").sortWithinPartitions("doc_id", "h", "text")
               .select("doc_id", "text"))
    ordered.mapInArrow(encode, CHUNK).write.parquet(path)


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(CHUNK).parquet(path)


def decode_block(row: dict) -> np.ndarray:
    """The ids of one chunk row; a damaged block raises."""
    unzip = zstandard.ZstdDecompressor()
    ids = ids_of([unzip.decompress(p) for p in row["planes"]], row["n_ids"], row["layout"])
    if zlib.crc32(ids.tobytes()) != row["crc32"]:
        raise ValueError(f"block {row['shard']}/{row['block']} is damaged")
    return ids


def _times(a: int, b: int) -> int:
    """Product of two polynomials modulo the CRC-32 polynomial (reflected)."""
    out = 0
    for i in range(31, -1, -1):
        if b >> i & 1:
            out ^= a
        a = (a >> 1) ^ (0xEDB88320 if a & 1 else 0)
    return out


def crc32_join(left: int, right: int, right_bytes: int) -> int:
    """CRC-32 of two byte strings laid end to end, from their own CRCs."""
    power, square, n = 1 << 31, 1 << 30, 8 * right_bytes  # x^0 and x^1
    while n:
        if n & 1:
            power = _times(power, square)
        square = _times(square, square)
        n >>= 1
    return _times(left, power) ^ right


def read_docs(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the files: doc_id, shard, ordinal (in the shard), start (ids before
    it in the whole stream), n_tokens, ids_crc32 (of its ids as little-endian 32-bit)."""
    C.ship(spark)
    schema = C.arrow(PIECE)

    def pieces(batches):
        for b in batches:
            for row in b.to_pylist():
                raw = decode_block(row).tobytes()
                yield C.batch(
                    schema, shard=[row["shard"]] * len(row["doc_ids"]), ordinal=row["ordinals"], doc_id=row["doc_ids"],
                    at=[row["first"] + o for o in row["offsets"]], n=row["lengths"],
                    crc=[zlib.crc32(raw[4 * o:4 * (o + n)]) for o, n in zip(row["offsets"], row["lengths"], strict=True)])

    @F.pandas_udf("long")
    def joined(col):
        out = []
        for parts in col:
            crc = 0
            for p in parts:
                crc = crc32_join(crc, int(p["crc"]), 4 * int(p["n"]))
            out.append(crc)
        import pandas as pd
        return pd.Series(out, dtype="int64")

    found = read_blocks(spark, path).mapInArrow(pieces, PIECE)
    docs = found.groupBy("shard", "ordinal").agg(
        F.first("doc_id").alias("doc_id"), F.min("at").alias("at"), F.sum("n").alias("n_tokens"),
        F.first("crc").alias("crc"),
        F.sort_array(F.collect_list(F.struct("at", "n", "crc"))).alias("parts"))
    whole = F.size("parts") == 1
    # only the few documents that cross a block border need their pieces' CRCs joined
    docs = docs.select("shard", "ordinal", "doc_id", "at", "n_tokens", "crc",
                       F.when(~whole, F.col("parts")).otherwise(F.array().cast("array<struct<at:bigint,n:bigint,crc:bigint>>")).alias("parts"))
    docs = docs.withColumn("joined", joined("parts"))
    totals = read_blocks(spark, path).groupBy("shard").agg(F.sum("n_ids").alias("total"))
    before = totals.select("shard", (F.sum("total").over(Window.orderBy("shard")) - F.col("total")).alias("before"))
    return docs.join(before, "shard").select(
        "doc_id", (F.col("before") + F.col("at")).alias("start"), "n_tokens",
        F.when(F.size("parts") > 0, F.col("joined")).otherwise(F.col("crc")).alias("ids_crc32"), "shard", "ordinal")
