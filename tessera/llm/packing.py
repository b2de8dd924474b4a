"""Operator 2: best-fit packing with certified bin counts.

Documents become pieces of at most ``capacity`` token ids; every piece is an
item. Items are dealt to partitions of bounded size and each partition runs
best-fit decreasing. A dual-feasible-function lower bound certifies a
partition whose bin count equals the bound. While the bins of all partitions
together exceed the bound of the whole input (from its length histogram),
each partition gives up its emptiest bins, enough of them to hold its gap in
free space; their documents are exchanged, dealt to fewer partitions, and
packed anew, also where one partition is left. The exchange ends at the bound
or when a round gains nothing; a round that needs more bins than the one
before is dropped for it. Only slim rows (ids and lengths) take part.

Defined cases: null text is empty; every document ends with ``end_id``, so an
empty one is a single id; rows are packed one by one, repeated rows and null
ids included; an empty table gives no rows; only the id and text columns are
read, so further columns cannot clash.
"""

from __future__ import annotations

import sys
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import materialise, slices
from .tokens import worker_encoder

#: Items that one partition packs: bounds a task's memory.
GROUP_ITEMS = 50_000
PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long"
#: Largest parameter of the stair-step functions.
STAIRS = 24


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int, end_id: int, with_ids: bool = False,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of each document: all of ``capacity`` ids but the first, which may be shorter."""
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    names = [f.split()[0] for f in PIECE_SCHEMA.split(", ")] + ["ids"] * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = worker_encoder(tokenizer)
        end = np.array([end_id], "=u4").tobytes()
        for batch in batches:
            for part in slices(batch):
                out: list[list] = [[] for _ in names]
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    ids = encode(text or "") + end
                    if sys.byteorder != "little":
                        ids = np.frombuffer(ids, "=u4").astype("<u4").tobytes()
                    size = len(ids) // 4
                    begin, piece = 0, 0
                    stop = size % capacity or capacity
                    while begin < size:
                        own = ids[4 * begin:4 * stop]
                        row = (doc_id, piece, begin, stop - begin, zlib.crc32(own), own)
                        for column, value in zip(out, row):
                            column.append(value)
                        begin, stop, piece = stop, stop + capacity, piece + 1
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
                yield pa.record_batch([pa.array(c, k) for c, k in zip(out, kinds)], names)

    return slim.mapInArrow(run, PIECE_SCHEMA + ", ids binary" * with_ids)


def lower_bound(lengths: np.ndarray, counts: np.ndarray, capacity: int) -> int:
    """Bins that any packing needs: the best of the dual feasible functions.

    For a threshold t, lengths over capacity - t count as a whole bin and
    those under t as nothing; for a stair k, a length x counts as
    floor((k+1)x/capacity)/k bins, or x/capacity where that is a whole step.
    """
    if not len(lengths):
        return 0
    x, c = lengths.astype(np.int64), counts.astype(np.int64)
    best = -(-int((x * c).sum()) // capacity)
    order = np.argsort(x)
    x, c = x[order], c[order]
    for t in np.unique(np.minimum(x, capacity - x)[(x <= capacity // 2) | (capacity - x < x)]):
        whole, kept = x > capacity - t, x >= t
        load = int(c[whole].sum()) * capacity + int((x * c)[kept & ~whole].sum())
        best = max(best, -(-load // capacity))
    for k in range(1, STAIRS + 1):
        steps = (k + 1) * x
        exact = steps % capacity == 0
        # in units of 1 / (k * capacity) of a bin
        load = int((np.where(exact, x * k, (steps // capacity) * capacity) * c).sum())
        best = max(best, -(-load // (k * capacity)))
    return best


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bin of each item, its offset there, fill of each bin)."""
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    free: list[int] = []
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask = 0  # bit r: some bin has r free
    for item in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[item])
        fits = mask >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            at = open_bins[room].pop()
            if not open_bins[room]:
                mask ^= 1 << room
        else:
            room, at = capacity, len(free)
            free.append(capacity)
        bins[item], offsets[item] = at, capacity - room
        free[at] = left = room - size
        if left:
            open_bins[left].append(at)
            mask |= 1 << left
    return bins, offsets, capacity - np.array(free, np.int64)


def _pack_round(pool: DataFrame, groups: int, number: int, capacity: int) -> DataFrame:
    """One best-fit run of every partition, with the bins it would exchange marked."""

    def pack(table: pa.Table) -> pa.Table:
        lengths = table.column("length").to_numpy()
        bins, offsets, fill = best_fit_decreasing(lengths, capacity)
        sizes, counts = np.unique(lengths, return_counts=True)
        gap = len(fill) - lower_bound(sizes, counts, capacity)
        emptiest = np.argsort(fill, kind="stable")
        room = np.cumsum(capacity - fill[emptiest])
        given = int(np.searchsorted(room, max(gap, 1) * capacity)) + 1
        released = np.zeros(len(fill), bool)
        released[emptiest[:given]] = True
        released &= fill < capacity
        group = table.column("grp")[0].as_py()
        table = table.drop_columns(["grp"])
        for name, column in (("sequence_id", (number << 53 | group << 20) + bins), ("offset", offsets),
                             ("released", released[bins]), ("opens", (offsets == 0).astype(np.int64))):
            table = table.append_column(name, pa.array(column))
        return table

    dealt = pool.withColumn("grp", F.pmod(F.monotonically_increasing_id(), F.lit(groups)))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pool.schema)
    return dealt.groupBy("grp").applyInArrow(
        pack, f"{schema}, sequence_id long, offset long, released boolean, opens long")


def pack(pieces: DataFrame, capacity: int, group_items: int = GROUP_ITEMS) -> DataFrame:
    """``pieces`` (with a ``length`` column) plus sequence_id and offset."""
    if not 1 < group_items < 1 << 20:
        raise ValueError("group_items must be under 2^20")
    pool = materialise(pieces, "pieces")
    histogram = pool.groupBy("length").count().toPandas()  # at most ``capacity`` rows
    bound = lower_bound(histogram["length"].to_numpy(), histogram["count"].to_numpy(), capacity)
    waiting, settled, number = int(histogram["count"].sum()), None, 0
    others, best, before = 0, None, None  # bins settled before this round; all bins after the last one, what it released
    names = pool.columns
    while True:
        groups = max(1, -(-waiting // group_items))
        packed = materialise(_pack_round(pool, groups, number, capacity), "packed")
        bins, free, free_items = packed.agg(
            F.coalesce(F.sum("opens"), F.lit(0)),
            F.coalesce(F.sum(F.when(F.col("released"), F.col("opens"))), F.lit(0)),
            F.count(F.when(F.col("released"), 1))).first()
        total = others + bins
        gained = best is None or total < best
        last = total == bound or free < 2 or not gained or number == 63
        placed = packed.select(*names, "sequence_id", "offset", "released")
        # a round that needs more bins than the one before is not kept
        keep = (before if best is not None and total > best else placed if last else placed.where(~F.col("released"))).drop("released")
        settled = keep if settled is None else settled.unionByName(keep)
        if last:
            return settled
        before = placed.where("released")
        pool, waiting, others = before.select(*names), free_items, total - free
        best, number = total, number + 1


def pack_documents(docs: DataFrame, tokenizer: str = "byte_bpe_50k.json", capacity: int = 1024, end_id: int = 2,
                   with_ids: bool = False, group_items: int = GROUP_ITEMS) -> DataFrame:
    """A row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset[, ids]."""
    packed = pack(token_pieces(docs, tokenizer, capacity, end_id, with_ids), capacity, group_items)
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] + ["ids"] * with_ids
    return packed.select(*names)


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids, doc_ids) of pieces that carry their ids; a group holds one sequence at most."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "ids")))
    joined = F.aggregate("parts", F.lit(b""), lambda a, p: F.concat(a, p["ids"]))
    return (packed.groupBy("sequence_id").agg(parts.alias("parts"))
            .select("sequence_id", joined.alias("ids"), F.col("parts.doc_id").alias("doc_ids")))
