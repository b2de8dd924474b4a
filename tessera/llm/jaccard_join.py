"""Operator 8: exact n-gram Jaccard join by T-occurrence search (DivideSkip).

A document is the set of its distinct word n-grams (hashed to 64 bits). Two
documents link when their Jaccard similarity reaches ``percent``. The work is
done in four steps, none of which emits all pairs of a group.

1. *Signatures.* Of each set the least p(n) = n - ceil(s n) + l(n) hashes are
   indexed (s: the similarity, l(n): ``SPARE`` percent of n). Two linked
   documents miss at most n - ceil(s n) hashes of each other, so they share at
   least l(m) indexed hashes, m being the smaller size allowed to a partner.
   Equal sets are indexed once.
2. *Skipping long lists.* The number of documents that index a hash is the length
   of its inverted list. A document skips its l(ceil(s n)) - 1 longest lists,
   ties kept: too few to hold all that it shares with a partner. Lists are
   ordered by length alone, the same for both, so one list is left to both.
   Documents with fewer shared lists than that link with nothing.
3. *Candidate blocks.* The left lists join neighbouring sizes into a chain, and
   the connected chains are blocks. Every link lies within one block.
4. *Search.* Whole sets meet once per block. In a block, lists with the same
   documents count as one with a weight. Each set is a query for the sets
   before it (by size) with T occurrences: the longest lists are put aside,
   the short ones are merged, and what they leave is binary-probed in the
   long ones; a pair counts only if its exact overlap is enough. Sets
   already joined through others are not probed again. A block beyond
   ``BLOCK_HASHES`` is split into sub-blocks, each pair of which is searched.

Defined cases: texts that are null or have no words have an empty set and link
with nothing; fewer words than n make one n-gram; rows with the same id are
one document, linked with what any of its texts links with; rows without an id
are returned with their set size and a null component; an empty table gives
no rows; only the id and text columns are read, so further columns cannot
clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import Memo, materialise, per_worker, slices
from .components import components

#: Percent of a set's size indexed beyond the least prefix.
SPARE = 15
#: Hashes of one block that are searched in one task.
BLOCK_HASHES = 4_000_000
#: Indexed hashes held by a task before it deals them out, and meant for one list partition.
DEAL_HASHES, PART_HASHES = 1_000_000, 400_000
#: Share of T that the lists put aside may weigh.
ASIDE = 0.8
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


def spare(n):
    return np.maximum(1, np.asarray(n, np.int64) * SPARE // 100)


def least_partner(n, percent: int):
    """ceil(percent/100 * n): the least overlap with, and size of, a partner."""
    return -(-np.asarray(n, np.int64) * percent // 100)


def shingle_hashes(text: str | None, size: int, word_hash) -> np.ndarray:
    """Sorted distinct hashes of the word n-grams of a text."""
    words = text.encode().translate(LOWER).split() if text else []
    if not words:
        return np.zeros(0, np.uint64)
    w = np.array([word_hash[x] for x in words], np.uint64)
    width = min(size, len(w))
    h = np.full(len(w) - width + 1, width, np.uint64)
    for k in range(width):
        h = (h ^ (h >> np.uint64(29))) * MIX[0] + w[k:len(w) - width + 1 + k]
    h = (h ^ (h >> np.uint64(32))) * MIX[1]
    h = (h ^ (h >> np.uint64(29))) * MIX[0]
    return np.unique(h ^ (h >> np.uint64(32)))


def _hasher():
    import xxhash

    return Memo(xxhash.xxh3_64_intdigest, 150_000)


def pack48(hashes: np.ndarray) -> bytes:
    """The upper 48 bits of each hash."""
    return hashes.astype(">u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def unpack48(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 6, 8), np.uint8)
    out[:, 2:] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return out.reshape(-1).view(">u8").astype(np.int64)


def signatures(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """(doc_id, n, digest, prefix) of every row of (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        word_hash = per_worker(("shingles",), _hasher)
        for batch in batches:
            for part in slices(batch):
                sizes, digests, prefixes = [], [], []
                for text in part.column(1).to_pylist():
                    h = shingle_hashes(text, size, word_hash)
                    n = len(h)
                    sizes.append(n)
                    digests.append(xxhash.xxh3_128_digest(h.tobytes()))
                    prefixes.append(pack48(h[:min(n, n - int(least_partner(n, percent)) + int(spare(n)))]) if n else b"")
                yield pa.record_batch([part.column(0), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()),
                                       pa.array(prefixes, pa.binary())], ["doc_id", "n", "digest", "prefix"])

    return docs.mapInArrow(run, "doc_id long, n long, digest binary, prefix binary")


def planes(values: np.ndarray, kind: str) -> bytes:
    """The first bytes of all values, then the second ones, ...: shuffle files compress the empty ones away."""
    return np.ascontiguousarray(values.astype(kind).view(np.uint8).reshape(len(values), -1).T).tobytes()


def from_planes(data: bytes, kind: str) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(width, -1).T).view(kind).reshape(-1)


def _deal(parts: int):
    """Deals the indexed hashes of many documents out to ``parts`` list partitions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, int, bytes]] = []
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            ids, sizes, prefixes = zip(*held)
            hashes = unpack48(b"".join(prefixes))
            owner = np.repeat(np.arange(len(ids), dtype=np.uint32), [len(p) // 6 for p in prefixes])
            part = (hashes % parts).astype(np.int32)
            order = np.lexsort((hashes, part))
            bounds = np.searchsorted(part[order], np.arange(parts + 1))
            ids, sizes = np.array(ids, np.int64), np.array(sizes, np.int64)
            for p in range(parts):
                own = order[bounds[p]:bounds[p + 1]]
                if len(own):
                    docs = owner[own]
                    row = (planes(hashes[own], "<i8"), planes(ids[docs], "<i8"), planes(sizes[docs], "<u4"))
                    yield pa.record_batch([pa.array([p], pa.int32()), *[pa.array([x], pa.binary()) for x in row]],
                                          ["part", "hashes", "ids", "sizes"])

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                held.append(row)
                size += len(row[2]) // 6
                if size >= DEAL_HASHES:
                    yield from flush()
                    held, size = [], 0
        if held:
            yield from flush()

    return run


def list_partitions(indexed: DataFrame, parts: int) -> DataFrame:
    """(part, hashes, ids, sizes): the indexed hashes of (rep, n, prefix), one list partition a task.

    Dealt by a hash of ``part``, some tasks would hold several list partitions at once.
    """
    dealt = indexed.select("rep", "n", "prefix").mapInArrow(_deal(parts), "part int, hashes binary, ids binary, sizes binary")
    return dealt.repartitionById(parts, "part")


def _lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(hash, rep, n, df) of every list of two documents or more in this task's list partitions."""
    held: dict[int, list] = {}
    for batch in batches:
        for part, *block in zip(*(c.to_pylist() for c in batch.columns)):
            held.setdefault(part, []).append(block)
    while held:
        blocks = held.popitem()[1]
        hashes = np.concatenate([from_planes(b[0], "<i8") for b in blocks])
        ids = np.concatenate([from_planes(b[1], "<i8") for b in blocks])
        sizes = np.concatenate([from_planes(b[2], "<u4") for b in blocks]).astype(np.int64)
        del blocks
        order = np.lexsort((sizes, ids, hashes))
        hashes, ids, sizes = hashes[order], ids[order], sizes[order]
        fresh = np.append(True, (hashes[1:] != hashes[:-1]) | (ids[1:] != ids[:-1]) | (sizes[1:] != sizes[:-1]))
        hashes, ids, sizes = hashes[fresh], ids[fresh], sizes[fresh]
        starts = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1]))
        df = np.diff(np.append(starts, len(hashes)))
        df = np.repeat(df, df)
        long = df > 1
        columns = [c[long] for c in (hashes, ids, sizes, df)]
        for at in range(0, len(columns[0]), 100_000):
            yield pa.record_batch([pa.array(c[at:at + 100_000]) for c in columns], ["hash", "rep", "n", "df"])


def _chains(percent: int):
    """Edges of neighbouring sizes in each list; a task's first and last row, to tie its ends to the next task's."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, last, names = TaskContext.get().partitionId(), None, ["a", "b", "kind", "task", "hash", "n"]

        def ends(row, kind: int) -> pa.RecordBatch:
            values = (row[1], row[1], kind, task, row[0], row[2])
            return pa.record_batch([pa.array([int(v)], pa.int64()) for v in values], names)

        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(i).to_numpy() for i in range(3)]
            if last is None:
                yield ends([c[0] for c in columns], 1)
            else:
                columns = [np.concatenate([[v], c]) for v, c in zip(last, columns)]
            last = [c[-1] for c in columns]
            h, rep, n = columns
            near = (h[1:] == h[:-1]) & (n[:-1] * 100 >= n[1:] * percent)
            pairs = np.unique(np.stack([rep[:-1][near], rep[1:][near]], 1), axis=0)
            zero = np.zeros(len(pairs), np.int64)
            yield pa.record_batch([pa.array(x) for x in (pairs[:, 0].copy(), pairs[:, 1].copy(), zero, zero, zero, zero)], names)
        if last is not None:
            yield ends(last, 2)

    return run


def candidate_edges(signed: DataFrame, percent: int) -> DataFrame:
    """(a, b): chains that connect every two sets that may link."""
    spark = signed.sparkSession
    named = signed.where("doc_id is not null and n > 0")
    total = named.agg(F.coalesce(F.sum(F.octet_length("prefix")), F.lit(0))).first()[0] // 6
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-int(total) // PART_HASHES))
    # equal sets are indexed once, under their least id; a map-side aggregate meets hot copies first
    indexed = named.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("prefix").alias("prefix"))
    rows = list_partitions(indexed, parts).mapInArrow(_lists, "hash long, rep long, n long, df long")
    skipped = F.greatest(F.lit(1), F.floor(F.floor((F.col("n") * percent + 99) / 100) * SPARE / 100))
    by_set = Window.partitionBy("rep", "n")
    rank = F.row_number().over(by_set.orderBy(F.col("df").desc()))
    left = (rows.withColumn("rank", rank)
            .withColumn("longest", F.max(F.when(F.col("rank") == skipped, F.col("df"))).over(by_set))
            .where("df <= longest").select("hash", "rep", "n"))
    left = materialise(left, "lists")
    order = ["hash", "n", "rep"]
    ordered = left.select("hash", "rep", "n").repartitionByRange(
        int(spark.conf.get("spark.sql.shuffle.partitions")), *order).sortWithinPartitions(*order)
    found = materialise(ordered.mapInArrow(_chains(percent), "a long, b long, kind long, task long, hash long, n long"), "chains")
    # two rows per task: tie the last row of one to the first row of the next
    ends = found.where("kind > 0")
    nxt = Window.orderBy("task", "kind")
    tied = (ends.select("*", *[F.lead(c).over(nxt).alias(f"next_{c}") for c in ("a", "hash", "n")])
            .where(f"kind = 2 and hash = next_hash and n * 100 >= next_n * {percent}")
            .select("a", F.col("next_a").alias("b")))
    return found.where("kind = 0").select("a", "b").unionByName(tied).where("a <> b").distinct()


def divide_skip(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """Label of the component of each set (sorted by size), links found by T-occurrence search."""
    count = len(sets)
    sizes = np.array([len(s) for s in sets], np.int64)
    label = np.arange(count)
    if count < 2:
        return label
    _, token, df = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(count), sizes)
    shared = df[token] > 1
    token, owner = token[shared], owner[shared]
    if not len(token):
        return label
    order = np.lexsort((owner, token))
    token, owner = token[order], owner[order]
    starts = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
    # lists with the same documents are one list with a weight
    mixed = (owner.astype(np.uint64) + np.uint64(1)) * MIX[0]
    mixed ^= mixed >> np.uint64(31)
    keys = np.empty(len(starts), [("x", "u8"), ("y", "u8"), ("n", "i8")])
    keys["x"] = np.add.reduceat(mixed * MIX[1], starts)
    keys["y"] = np.add.reduceat((mixed ^ (mixed >> np.uint64(27))) * MIX[0] * mixed, starts)
    keys["n"] = np.diff(np.append(starts, len(token)))
    _, first, kind, weight = np.unique(keys, return_index=True, return_inverse=True, return_counts=True)
    lengths = keys["n"][first]
    postings = [owner[starts[f]:starts[f] + n] for f, n in zip(first.tolist(), lengths.tolist())]
    members = np.concatenate(postings)
    kinds_of = np.repeat(np.arange(len(postings)), lengths)
    by_doc = np.lexsort((lengths[kinds_of], members))
    members, kinds_of = members[by_doc], kinds_of[by_doc]
    bounds = np.searchsorted(members, np.arange(count + 1))
    filled = np.zeros(len(postings), np.int64)  # entries of each list that lie before the query
    for q in range(1, count):
        filled[kinds_of[bounds[q - 1]:bounds[q]]] += 1
        low = int(np.searchsorted(sizes, least_partner(sizes[q], percent)))
        own = kinds_of[bounds[q]:bounds[q + 1]]  # shortest list first
        if low >= q or not len(own):
            continue
        for near in {q - 1, low}:  # in a group of near copies these join q to all the others
            both = len(np.intersect1d(sets[q], sets[near], assume_unique=True))
            if label[near] != label[q] and 100 * both >= percent * int(sizes[q] + sizes[near] - both):
                joined = sorted((label[near], label[q]))
                label[label == joined[1]] = joined[0]
        if (label[low:q] == label[q]).all():
            continue
        need = -(-percent * (int(sizes[q]) + int(sizes[low])) // (100 + percent))
        weights = weight[own]
        if int(weights.sum()) < need:
            continue
        aside = int(np.searchsorted(np.cumsum(weights[::-1]), max(0, int(need * ASIDE)), "right"))
        short, long = own[:len(own) - aside], own[len(own) - aside:]
        need_short = need - int(weight[long].sum())
        sizes_of = filled[short]
        if not sizes_of.any():
            continue
        merged = np.concatenate([postings[k][:n] for k, n in zip(short.tolist(), sizes_of.tolist())])
        # the merge of the sorted short lists, with the weights of equal entries added up
        seen = np.bincount(merged, np.repeat(weight[short], sizes_of), q)[low:].astype(np.int64)
        found = np.flatnonzero((seen >= need_short) & (seen > 0))
        overlap, found = seen[found], found + low
        while len(found):
            fresh = label[found] != label[q]
            found, overlap = found[fresh], overlap[fresh]
            if not len(found):
                break
            # one candidate of each component first; once joined, its others need no probe
            _, probe = np.unique(label[found], return_index=True)
            if len(probe) * 4 > len(found):
                probe = np.arange(len(found))
            docs, both = found[probe], overlap[probe].copy()
            for k in long.tolist():
                place = np.searchsorted(postings[k], docs)
                place[place == len(postings[k])] = 0
                both += weight[k] * (postings[k][place] == docs)
            linked = docs[100 * both >= percent * (sizes[q] + sizes[docs] - both)]
            joined = np.unique(np.append(label[linked], label[q]))
            if len(joined) > 1:
                label[np.isin(label, joined)] = joined[0]
            rest = np.ones(len(found), bool)
            rest[probe] = False
            found, overlap = found[rest], overlap[rest]
    return label


def verified_edges(docs: DataFrame, blocks: DataFrame, size: int, percent: int,
                   block_hashes: int = BLOCK_HASHES) -> DataFrame:
    """(a, b): a spanning forest of the exact links within the blocks (rep, block, n)."""
    volume = blocks.groupBy("block").agg(F.ceil(F.sum("n") / block_hashes).alias("subs"))
    info = blocks.join(volume, "block").select(F.col("rep").alias("doc_id"), "block", "subs")
    # documents are never small: the same join at every size
    wanted = docs.join(info.hint("merge"), "doc_id").select("doc_id", "block", "subs", "text")

    def whole_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        word_hash = per_worker(("shingles",), _hasher)
        for batch in batches:
            for part in slices(batch):
                sets = [shingle_hashes(t, size, word_hash).tobytes() for t in part.column(3).to_pylist()]
                yield pa.record_batch([*part.columns[:3], pa.array(sets, pa.binary())], ["rep", "block", "subs", "hashes"])

    sets = (wanted.mapInArrow(whole_sets, "rep long, block long, subs long, hashes binary")
            .withColumn("sub", F.pmod(F.xxhash64("rep"), F.col("subs")))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("subs") - 1)))
            .where("subs = 1 or sub <> other")
            .select("rep", "hashes", "block", F.least("sub", "other").alias("x"), F.greatest("sub", "other").alias("y")))

    def search(table: pa.Table) -> pa.Table:
        ids = table.column("rep").to_numpy()
        sets = [np.frombuffer(h, np.uint64) for h in table.column("hashes").to_pylist()]
        order = sorted(range(len(sets)), key=lambda i: len(sets[i]))
        ids, different = ids[order], {}
        row = [different.setdefault(sets[i].tobytes(), len(different)) for i in order]  # equal sets are searched once
        label = divide_skip([np.frombuffer(s, np.uint64) for s in different], percent)
        first = np.unique(label[row], return_index=True, return_inverse=True)
        return pa.table({"a": pa.array(ids), "b": pa.array(ids[first[1][first[2]]])})

    return sets.groupBy("block", "x", "y").applyInArrow(search, "a long, b long").where("a <> b")


def jaccard_components(docs: DataFrame, size: int = 5, percent: int = 75, id_col: str = "doc_id",
                       text_col: str = "text", block_hashes: int = BLOCK_HASHES) -> DataFrame:
    """doc_id, n_shingles, component_id (least id reachable by links, itself included) of every row."""
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    signed = materialise(signatures(slim, size, percent), "signatures")
    named = signed.where("doc_id is not null and n > 0")
    blocks = components(candidate_edges(signed, percent))
    sizes = named.groupBy(F.col("doc_id").alias("node")).agg(F.max("n").alias("n"))
    blocks = materialise(blocks.join(sizes, "node").select(F.col("node").alias("rep"), F.col("component").alias("block"), "n"), "blocks")
    links = verified_edges(slim, blocks, size, percent, block_hashes)
    # equal sets link with the least id among them, and so do the several texts of an id
    least = named.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("rows")).where("rows > 1")
    copies = named.select("doc_id", "digest").join(least, "digest").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    found = components(links.unionByName(copies))
    return (signed.join(found.select(F.col("node").alias("doc_id"), "component"), "doc_id", "left")
            .select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id")))


def keep_one_of_each(docs: DataFrame, size: int = 5, percent: int = 75) -> DataFrame:
    """One row of each component of similar texts stays: that of the least id, an id before none, then of the least hash.

    What is compared are the distinct (id, text), told apart by 64-bit hashes
    as n-grams are, so several texts of an id are judged each by itself and
    rows without an id like all others. Rows without id and words all stay.
    """
    words = F.coalesce(F.col("text").cast("string").rlike("[^ \\t-\\r]"), F.lit(False))
    compared = F.col("doc_id").isNotNull() | words
    marked = docs.withColumn("__node", F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string")))
    named = marked.where(compared)
    found = materialise(jaccard_components(named, size, percent, id_col="__node")
                        .groupBy(F.col("doc_id").alias("__node")).agg(F.min("component_id").alias("component")), "found")
    ids = named.groupBy("__node").agg(F.min(F.col("doc_id").cast("long")).alias("id"))
    kept = found.join(ids, "__node").groupBy("component").agg(
        F.min(F.struct(F.col("id").isNull(), "id", "__node")).alias("least")).select(F.col("least.__node").alias("__node"))
    first = named.join(kept, "__node", "left_semi").dropDuplicates(["__node"])
    return first.unionByName(marked.where(~compared)).drop("__node")
