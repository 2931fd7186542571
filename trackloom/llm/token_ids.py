"""Token ids in binary files: frequency-ranked ids, byte-aligned variable-length coding with separate control bytes.

A file is a block of documents in ascending doc_id order:
  magic "TLV1" | documents u32 | ids u32 | data bytes u32 | doc_ids i64 each | ids of each document u32 | control | data
All numbers are little-endian. Each id is stored as its rank by frequency in the corpus (0: most frequent), in one to
four bytes; control bytes hold four two-bit lengths each, so frequent ids take a byte and a quarter. Decoding looks all
lengths up in a table of 256 x 4, turns them into offsets by a running sum and gathers. The ranks' ids are written
beside the blocks. Blocks are rows of a Parquet table in the shared folder (shard, block, n_ids, payload), so that
Spark's committer keeps them whole when executors are lost and any store will do.

Steps: tokenise once and write the ids; count them (the vocabulary bounds what reaches the driver); range-sort by
doc_id, code, write. Positions come from sums per shard and running sums within a shard.

Defined results: null text is empty (the end id alone); rows sharing a doc_id lie side by side in order of their
length and a hash of their ids; null doc_ids come first and read back as null; an empty table gives no files; other
columns are ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trackloom.llm import tokens
from trackloom.llm.common import ids_and_texts, slices, written

MAGIC = b"TLV1"
HEAD = struct.Struct("<4sIII")
NULL_ID = -(2**63)
#: Lengths of the four ids of a control byte, two bits each from the low end.
LENGTHS = ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3).astype(np.uint8) + 1
BLOCK_IDS = 1 << 18
#: About 128 MB of a shard's blocks.
SHARD_IDS = 1 << 26


def pack(values: np.ndarray) -> tuple[bytes, bytes]:
    """(control, data) of unsigned 32-bit values."""
    values = values.astype("<u4", copy=False)
    extra = (values > 0xFF).astype(np.uint8) + (values > 0xFFFF) + (values > 0xFFFFFF)
    padded = np.zeros(-(-len(values) // 4) * 4, np.uint8)
    padded[: len(values)] = extra
    quads = padded.reshape(-1, 4)
    control = quads[:, 0] | quads[:, 1] << 2 | quads[:, 2] << 4 | quads[:, 3] << 6
    data = values.view(np.uint8).reshape(-1, 4)[np.arange(4) <= extra[:, None]]
    return control.astype(np.uint8).tobytes(), data.tobytes()


def unpack(control: bytes, data: bytes, n: int) -> np.ndarray:
    lengths = LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:n]
    ends = np.cumsum(lengths, dtype=np.int64)
    starts = ends - lengths
    raw = np.frombuffer(data, np.uint8)
    out = raw[starts].astype(np.uint32)
    for k in (1, 2, 3):
        more = np.flatnonzero(lengths > k)
        if not len(more):
            break
        out[more] |= raw[starts[more] + k].astype(np.uint32) << np.uint32(8 * k)
    return out


def to_file(doc_ids: np.ndarray, counts: np.ndarray, ranks: np.ndarray) -> bytes:
    control, data = pack(ranks)
    return b"".join(
        [HEAD.pack(MAGIC, len(doc_ids), len(ranks), len(data)), doc_ids.astype("<i8").tobytes(), counts.astype("<u4").tobytes(), control, data]
    )


def from_file(payload: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(doc_ids, ids of each document, ranks)."""
    magic, n_docs, n_ids, n_data = HEAD.unpack_from(payload)
    if magic != MAGIC:
        raise ValueError("not a token file")
    at = HEAD.size
    doc_ids = np.frombuffer(payload, "<i8", n_docs, at)
    counts = np.frombuffer(payload, "<u4", n_docs, at + 8 * n_docs)
    at += 12 * n_docs
    n_control = -(-n_ids // 4)
    return doc_ids, counts, unpack(payload[at : at + n_control], payload[at + n_control : at + n_control + n_data], n_ids)


def tokenised(docs: DataFrame, path: str, end_id: int = 0) -> DataFrame:
    """doc_id, n, ids (zstd of little-endian u32), tie: no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, squeeze = tokens.Encoder.of(path, end_id), zstandard.ZstdCompressor(level=1)
        for b in slices(batches, "text", 4 << 20):
            ids, ends = encoder.encode(b.column("text"))
            own = [x.astype("<u2" if x.max(initial=0) < 1 << 16 else "<u4") for x in np.split(ids, ends[:-1])]
            raw = [(b"2" if x.itemsize == 2 else b"4") + x.tobytes() for x in own]
            yield pa.RecordBatch.from_arrays(
                [
                    b.column("doc_id"), pa.array([len(x) for x in own], pa.int64()),
                    pa.array([squeeze.compress(x) for x in raw], pa.binary()), pa.array([zlib.crc32(x) for x in raw], pa.int64()),
                ],
                names=["doc_id", "n", "ids", "tie"],
            )

    return ids_and_texts(docs).mapInArrow(run, "doc_id long, n long, ids binary, tie long")


def _raw_ids(column: pa.Array) -> list[np.ndarray]:
    opened = zstandard.ZstdDecompressor()
    raw = [opened.decompress(x) for x in column.to_pylist()]
    return [np.frombuffer(x, "<u2" if x[:1] == b"2" else "<u4", offset=1).astype(np.uint32) for x in raw]


def frequency_ranks(ids: DataFrame) -> np.ndarray:
    """The ids by frequency over all documents, most frequent first, ties to the smaller id. A row per id reaches the
    driver: the vocabulary's size is the bound."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for b in batches:
            c = np.bincount(np.concatenate([np.zeros(0, np.uint32), *_raw_ids(b.column("ids"))]), minlength=len(total))
            c[: len(total)] += total
            total = c
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(total[seen], pa.int64())], names=["id", "n"])

    rows = ids.select("ids").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toPandas()
    return rows.sort_values(["n", "id"], ascending=[False, True])["id"].to_numpy(np.int64)


def write(docs: DataFrame, path: str, end_id: int = 0) -> tuple[DataFrame, DataFrame]:
    """(blocks, vocabulary) as read back from the files: blocks shard, block, n_ids, payload; vocabulary rank, id."""
    spark = docs.sparkSession
    ids = written(tokenised(docs, path, end_id).withColumn("row", F.monotonically_increasing_id()), "token-ids")
    by_rank = frequency_ranks(ids)
    vocabulary = written(spark.createDataFrame(list(enumerate(by_rank.tolist())), "rank long, id long").coalesce(1), "token-vocabulary")
    ranks = np.zeros(int(by_rank.max(initial=-1)) + 1, np.uint32)
    ranks[by_rank] = np.arange(len(by_rank), dtype=np.uint32)
    shared = spark.sparkContext.broadcast(ranks)
    total = ids.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, shard, doc_ids, own, held = 0, -1, [], [], 0

        def done() -> pa.RecordBatch:
            payload = to_file(np.array(doc_ids, np.int64), np.array([len(x) for x in own]), shared.value[np.concatenate(own)])
            return pa.RecordBatch.from_arrays(
                [pa.array([shard], pa.int32()), pa.array([block], pa.int32()), pa.array([held], pa.int64()), pa.array([payload], pa.binary())],
                names=["shard", "block", "n_ids", "payload"],
            )

        for b in batches:
            shard = b.column("shard")[0].as_py() if b.num_rows else shard
            for doc_id, x in zip(b.column("doc_id").to_pylist(), _raw_ids(b.column("ids"))):
                doc_ids.append(NULL_ID if doc_id is None else doc_id)
                own.append(x)
                held += len(x)
                if held >= BLOCK_IDS:
                    yield done()
                    block, doc_ids, own, held = block + 1, [], [], 0
        if own:
            yield done()

    order = ["doc_id", "n", "tie", "row"]  # the row keeps ranges even where rows repeat
    ranged = ids.repartitionByRange(1 + total // SHARD_IDS, *order).sortWithinPartitions(*order).select(
        "doc_id", "ids", F.spark_partition_id().alias("shard"),
    )
    return written(ranged.mapInArrow(code, "shard int, block int, n_ids long, payload binary"), "token-blocks", large_rows=True), vocabulary


def read(blocks: DataFrame, vocabulary: DataFrame, with_ids: bool = False) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 and, if asked, ids: decoded from the blocks."""
    spark = blocks.sparkSession
    by_rank = spark.sparkContext.broadcast(vocabulary.toPandas().sort_values("rank")["id"].to_numpy(np.uint32))
    shards = blocks.groupBy(F.col("shard").alias("s")).agg(F.sum("n_ids").alias("held"))
    shards = shards.select(
        "s",
        F.coalesce(F.sum("held").over(Window.orderBy("s").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"),
    )
    inside = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    heads = blocks.select("shard", "block", "n_ids").withColumn("inside", F.coalesce(F.sum("n_ids").over(inside), F.lit(0)))
    heads = heads.join(shards, F.col("shard") == F.col("s")).select(
        F.col("shard").alias("of_shard"), F.col("block").alias("of_block"),
        (F.col("before") + F.col("inside")).alias("block_start"),
    )
    fields = "doc_id long, n_tokens long, ids_crc32 long, offset long, shard int, block int" + ", ids array<int>" * with_ids

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for shard, block, payload in zip(b.column("shard").to_pylist(), b.column("block").to_pylist(), b.column("payload")):
                doc_ids, counts, ranks = from_file(payload.as_buffer().to_pybytes())
                ids = by_rank.value[ranks].astype("<u4", copy=False)
                ends = np.cumsum(counts, dtype=np.int64)
                own = np.split(ids, ends[:-1])
                columns = [
                    pa.array(doc_ids, pa.int64(), mask=doc_ids == NULL_ID), pa.array(counts.astype(np.int64)), pa.array([zlib.crc32(x) for x in own], pa.int64()),
                    pa.array(ends - counts), pa.array(np.full(len(doc_ids), shard, np.int32)), pa.array(np.full(len(doc_ids), block, np.int32)),
                ]
                if with_ids:
                    columns.append(pa.array([x.astype(np.int32) for x in own], pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(columns, names=[f.split()[0] for f in fields.split(", ")])

    decoded = blocks.select("shard", "block", "payload").mapInArrow(decode, fields)
    placed = decoded.join(heads, (F.col("shard") == F.col("of_shard")) & (F.col("block") == F.col("of_block")))
    return placed.select("doc_id", (F.col("block_start") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32", *["ids"] * with_ids)
