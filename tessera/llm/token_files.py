"""Operator 4: token ids as directly addressable codes.

An id is split into chunks of ``CHUNK`` bits, lowest first. Level k holds the
k-th chunk of every id that has one, as bytes, and a bitmap whose bit says
whether the id goes on at level k + 1. A rank directory gives the number of
set bits before each block of the bitmap, so the place of an id at the next
level is one directory entry plus one popcount: any token is read without
decoding its neighbours.

Documents are range-partitioned by id and written in ascending order as
segments of whole documents. A segment is one row of the output table: its
place (shard, segment), its first and last document, its number of ids, and
the bytes of its codes and document directory. Rows of a segment are bounded
by ``SEGMENT_IDS`` ids plus one document.

Defined cases: null text is empty; every document ends with ``end_id``;
documents of equal id keep the order of a hash of their text (null ids come
first); an empty table writes no segment; only the id and text columns are
read, so further columns cannot clash.
"""

from __future__ import annotations

import os
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..session import checkpoint_dir
from .common import slices
from .tokens import worker_encoder

CHUNK = 8
RANK_BLOCK = 512
SEGMENT_IDS = 1 << 20
MAGIC = b"DAC1"
SEGMENT_SCHEMA = "shard int, segment int, first_doc long, last_doc long, n_docs long, n_ids long, codes binary"


def encode_ids(ids: np.ndarray) -> bytes:
    """Magic, number of levels; for each level its size, chunks, bitmap and rank directory."""
    out, rest, levels = [], ids.astype(np.uint32), 0
    while levels == 0 or len(rest):
        more = rest >> CHUNK != 0
        bits = np.packbits(more, bitorder="little")
        ranks = np.concatenate([[0], np.cumsum(more, dtype=np.int64)])[:-1][::RANK_BLOCK].astype("<u4")
        out += [struct.pack("<Q", len(rest)), (rest & 0xFF).astype(np.uint8).tobytes(), bits.tobytes(), ranks.tobytes()]
        rest, levels = (rest >> CHUNK)[more], levels + 1
    return MAGIC + struct.pack("<I", levels) + b"".join(out)


class Codes:
    """Random access to the ids of one segment."""

    def __init__(self, data: bytes):
        if data[:4] != MAGIC:
            raise ValueError("not a directly addressable code")
        self.levels, at = [], 8
        for _ in range(struct.unpack_from("<I", data, 4)[0]):
            size = struct.unpack_from("<Q", data, at)[0]
            at += 8
            chunks = np.frombuffer(data, np.uint8, size, at)
            at += size
            bits = np.frombuffer(data, np.uint8, -(-size // 8), at)
            at += len(bits)
            ranks = np.frombuffer(data, "<u4", -(-size // RANK_BLOCK), at)
            at += 4 * len(ranks)
            self.levels.append((chunks, bits, ranks))

    def _rank(self, level: int, at: int) -> int:
        """Set bits before ``at``: one directory entry and the bits after its block's start."""
        _, bits, ranks = self.levels[level]
        if at >= len(self.levels[level][0]):
            return len(self.levels[level + 1][0]) if level + 1 < len(self.levels) else 0
        block = at // RANK_BLOCK
        own = np.unpackbits(bits[block * RANK_BLOCK // 8:at // 8 + 1], bitorder="little")
        return int(ranks[block]) + int(own[:at - block * RANK_BLOCK].sum())

    def __len__(self) -> int:
        return len(self.levels[0][0])

    def __getitem__(self, at: int) -> int:
        value = 0
        for level, (chunks, bits, _) in enumerate(self.levels):
            value |= int(chunks[at]) << CHUNK * level
            if not bits[at // 8] >> at % 8 & 1:
                break
            at = self._rank(level, at)
        return value

    def ids(self, start: int, stop: int) -> np.ndarray:
        """The ids of a range: at each level a contiguous run of chunks."""
        value = np.zeros(stop - start, np.uint32)
        where = None
        for level, (chunks, bits, _) in enumerate(self.levels):
            own = chunks[start:stop].astype(np.uint32) << np.uint32(CHUNK * level)
            if where is None:
                value |= own
            else:
                value[where] |= own
            more = np.unpackbits(bits[start // 8:-(-stop // 8)], bitorder="little")
            more = more[start % 8:start % 8 + stop - start].astype(bool)
            if not more.any():
                break
            where = np.flatnonzero(more) if where is None else where[more]
            start, stop = self._rank(level, start), self._rank(level, stop)
        return value


def write_token_files(docs: DataFrame, path: str, tokenizer: str = "word_bpe_49k.json", end_id: int = 2,
                      partitions: int | None = None, segment_ids: int = SEGMENT_IDS,
                      id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write the ids of all documents, in ascending order of their id, as files under ``path``."""
    spark = docs.sparkSession
    text = F.col(text_col).cast("string")
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("h"))
    keys = [F.col("doc_id").asc_nulls_first(), F.col("h")]
    count = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = slim.repartitionByRange(count, *keys).sortWithinPartitions(*keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = worker_encoder(tokenizer)
        end = np.array([end_id], "=u4").tobytes()
        shard, segment = TaskContext.get().partitionId(), 0
        doc_ids: list = []
        parts: list[bytes] = []
        held = 0

        def flush() -> pa.RecordBatch:
            sizes = np.array([len(p) // 4 for p in parts], "<u8")
            ids = np.frombuffer(b"".join(parts), "=u4")
            missing = np.array([d is None for d in doc_ids], np.uint8)
            names = np.array([d or 0 for d in doc_ids], "<i8")
            directory = struct.pack("<Q", len(doc_ids)) + names.tobytes() + missing.tobytes() + sizes.tobytes()
            row = (shard, segment, doc_ids[0], doc_ids[-1], len(doc_ids), len(ids), directory + encode_ids(ids))
            kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            return pa.record_batch([pa.array([v], k) for v, k in zip(row, kinds)],
                                   [f.split()[0] for f in SEGMENT_SCHEMA.split(", ")])

        for batch in batches:
            for part in slices(batch):
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    own = encode(text or "") + end
                    doc_ids.append(doc_id)
                    parts.append(own)
                    held += len(own) // 4
                    if held >= segment_ids:
                        yield flush()
                        doc_ids, parts, held, segment = [], [], 0, segment + 1
        if doc_ids:
            yield flush()

    ordered.mapInArrow(run, SEGMENT_SCHEMA).write.parquet(path)


def segment_starts(spark: SparkSession, path: str) -> DataFrame:
    """(shard, segment, seg_start): ids before each segment; only the slim columns are read.

    Shards are summed first, so the one ordered pass sees a row per shard.
    """
    slim = spark.read.schema(SEGMENT_SCHEMA).parquet(path).select("shard", "segment", "n_ids")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = (slim.groupBy("shard").agg(F.sum("n_ids").alias("ids"))
              .select("shard", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("shard_start")))
    within = Window.partitionBy("shard").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    return (slim.select("shard", "segment", "n_ids", F.coalesce(F.sum("n_ids").over(within), F.lit(0)).alias("inner"))
            .join(shards, "shard")
            .select("shard", "segment", (F.col("shard_start") + F.col("inner")).alias("seg_start"), "n_ids"))


def open_segment(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, Codes]:
    """(document ids, which of them are null, their first places with the end, codes)."""
    count = struct.unpack_from("<Q", data)[0]
    names = np.frombuffer(data, "<i8", count, 8)
    missing = np.frombuffer(data, np.uint8, count, 8 + 8 * count).astype(bool)
    sizes = np.frombuffer(data, "<u8", count, 8 + 9 * count).astype(np.int64)
    return names, missing, np.concatenate([[0], np.cumsum(sizes)]), Codes(data[8 + 17 * count:])


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of each document, decoded from the files."""
    segments = spark.read.schema(SEGMENT_SCHEMA).parquet(path).select("shard", "segment", "codes")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, segment, data in zip(*(c.to_pylist() for c in batch.columns)):
                names, missing, bounds, codes = open_segment(data)
                ids = codes.ids(0, len(codes)).astype("<u4")
                crcs = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(bounds[:-1], bounds[1:])]
                rows = len(names)
                yield pa.record_batch(
                    [pa.array(np.full(rows, shard, np.int32)), pa.array(np.full(rows, segment, np.int32)),
                     pa.array(names, pa.int64(), mask=missing), pa.array(bounds[:-1]), pa.array(np.diff(bounds)),
                     pa.array(crcs, pa.int64())],
                    ["shard", "segment", "doc_id", "within", "n_tokens", "ids_crc32"])

    rows = segments.mapInArrow(run, "shard int, segment int, doc_id long, within long, n_tokens long, ids_crc32 long")
    starts = segment_starts(spark, path).drop("n_ids")
    return rows.join(starts, ["shard", "segment"]).select(
        "doc_id", (F.col("seg_start") + F.col("within")).alias("start"), "n_tokens", "ids_crc32")


def read_tokens(spark: SparkSession, path: str, positions: DataFrame) -> DataFrame:
    """(position, token_id) for the global places in ``positions``, by random access.

    Each segment is opened once for the places in it; no block is decoded.
    """
    starts = segment_starts(spark, path).where("n_ids > 0")
    step = SEGMENT_IDS
    cells = F.explode(F.sequence(F.floor(F.col("seg_start") / step), F.floor((F.col("seg_start") + F.col("n_ids") - 1) / step)))
    places = positions.select(F.col("position").cast("long").alias("position"))
    found = (starts.withColumn("cell", cells)
             .join(places.withColumn("cell", F.floor(F.col("position") / step)), "cell")
             .where((F.col("position") >= F.col("seg_start")) & (F.col("position") < F.col("seg_start") + F.col("n_ids")))
             .select("shard", "segment", "position", (F.col("position") - F.col("seg_start")).alias("at")))
    files = spark.read.schema(SEGMENT_SCHEMA).parquet(path).select("shard", "segment", "codes")

    def pick(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[int] = []
        if left.num_rows:
            codes = open_segment(left.column("codes")[0].as_py())[3]
            out = [codes[at] for at in right.column("at").to_pylist()]
        positions = right.column("position") if left.num_rows else pa.array([], pa.int64())
        return pa.table({"position": positions, "token_id": pa.array(out, pa.int64())})

    return (files.groupBy("shard", "segment").cogroup(found.groupBy("shard", "segment"))
            .applyInArrow(pick, "position long, token_id long"))


def token_files(docs: DataFrame, tokenizer: str = "word_bpe_49k.json", end_id: int = 2) -> DataFrame:
    """Write the files into the shared folder and read every document back from them."""
    spark = docs.sparkSession
    path = os.path.join(checkpoint_dir(spark), f"token-files-{uuid.uuid4().hex}")
    write_token_files(docs, path, tokenizer, end_id)
    return read_documents(spark, path)
