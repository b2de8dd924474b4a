"""Operator 6: benchmark decontamination by Wu-Manber multi-pattern search.

Texts become their words joined by single spaces, as bytes. A window of
``window`` consecutive item words (or a whole shorter item) is a pattern.
The search looks at the block of B bytes that ends each search position: a
shift table says how far the position may jump because no pattern has that
block nearer to the end of its first m bytes (m: the shortest pattern). Where
the shift is 0, the bucket of the block's hash names the patterns to test,
and a direct comparison of bytes confirms each occurrence. All texts of an
Arrow batch are searched together, many positions at a time.

Patterns shorter than a full window have a table of their own, so that they do
not shorten the jumps of the others. The benchmark is taken in blocks of
bounded bytes: each block is collected, broadcast and searched in its own pass
over the rows, and the passes follow each other in the same tasks.

Defined cases: null text has no words and is clean; items without an id are left
out; null texts and texts of items
without words have no windows; the same window in several items counts for
each; repeated rows are judged row by row; an empty benchmark leaves all rows
clean; the columns added are named by the caller's ``prefix``, and all other
columns, whatever their names, pass through.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from .common import per_worker

#: Bytes of benchmark text in one block.
BLOCK_BYTES = 8 << 20
#: Bytes of text searched at a time, and positions looked at together.
SEARCH_BYTES, LANES = 8 << 20, 4096
TABLE_BITS = 20


def _byte_classes() -> bytes:
    """Lower-cases A-Z; every byte that is no part of a word becomes a space."""
    out = bytearray(range(256))
    for b in range(128):
        if 65 <= b <= 90:
            out[b] = b + 32
        elif not (48 <= b <= 57 or 97 <= b <= 122):
            out[b] = 32
    return bytes(out)


CLASSES = _byte_classes()


def words_of(text: str | None) -> list[bytes]:
    return text.encode().translate(CLASSES).split(b" ") if text else []


def normal_form(text: str | None) -> tuple[bytes, int]:
    """(the words between single spaces, with one at either end; their number)."""
    words = [w for w in words_of(text) if w]
    return (b" " + b" ".join(words) + b" ", len(words)) if words else (b"", 0)


class WuManber:
    """Search for a set of byte patterns, none empty."""

    def __init__(self, patterns: list[bytes]):
        self.patterns = patterns
        self.least = min(map(len, patterns))
        self.block = max(1, min(12, self.least // 2))
        size = self.least - self.block + 1
        heads = np.frombuffer(b"".join(p[:self.least] for p in patterns), np.uint8).reshape(len(patterns), self.least)
        self.shift = np.full(1 << TABLE_BITS, size, np.int32)
        for end in range(self.block - 1, self.least):  # the smallest jump of a block wins: write it last
            hashes = self._hash(heads, np.full(1, end))
            self.shift[hashes] = self.least - 1 - end
        self.buckets: dict[int, list[int]] = defaultdict(list)
        for number, h in enumerate(self._hash(heads, np.full(1, self.least - 1)).tolist()):
            self.buckets[h].append(number)

    def _hash(self, text: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Table places of the blocks that end at ``ends`` (of each row of a matrix, or of a buffer)."""
        h = np.zeros(1, np.uint64)
        for back in range(self.block):
            byte = (text[:, ends[0] - back] if text.ndim == 2 else text[ends - back]).astype(np.uint64)
            h = (h ^ byte) * np.uint64(0x100000001B3)
            h ^= h >> np.uint64(29)
        return ((h * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - TABLE_BITS)).astype(np.int64)

    def find(self, text: bytes) -> Iterator[tuple[int, int]]:
        """(place, pattern) of every occurrence."""
        if len(text) < self.least:
            return
        buffer = np.frombuffer(text, np.uint8)
        lanes = min(LANES, len(text) - self.least + 1)
        edges = np.linspace(self.least - 1, len(text), lanes + 1).astype(np.int64)
        at, stop = edges[:-1], edges[1:]
        while len(at):
            places = self._hash(buffer, at)
            jump = self.shift[places]
            zero = jump == 0
            if zero.any():
                for end, place in zip(at[zero].tolist(), places[zero].tolist()):
                    begin = end - self.least + 1
                    for number in self.buckets.get(place, ()):
                        if text.startswith(self.patterns[number], begin):
                            yield begin, number
            at = at + np.maximum(jump, 1)
            on = at < stop
            at, stop = at[on], stop[on]


def window_patterns(items: list[tuple[str, str | None]], window: int) -> dict[bytes, set[str]]:
    """Window bytes -> items that have it."""
    out: dict[bytes, set[str]] = defaultdict(set)
    for item, text in items:
        words = [w for w in words_of(text) if w]
        for at in range(max(1, len(words) - window + 1) if words else 0):
            out[b" " + b" ".join(words[at:at + window]) + b" "].add(item)
    return out


def build_searches(items: list[tuple[str, str | None]], window: int) -> list[tuple[WuManber, list[int], list[list[str]]]]:
    """Per class (full windows, shorter items): search, words of each pattern, items of each pattern."""
    found = window_patterns(items, window)
    out = []
    for full in (True, False):
        own = sorted(p for p in found if (p.count(b" ") - 1 == window) == full)
        if own:
            out.append((WuManber(own), [p.count(b" ") - 1 for p in own], [sorted(found[p]) for p in own]))
    return out


def search_texts(texts: list[str | None], searches) -> list[tuple[int, list[int], set[str]]]:
    """Per text: number of words, hit words' places, items with an occurring window."""
    forms = [normal_form(t) for t in texts]
    hits: list[set[int]] = [set() for _ in texts]
    items: list[set[str]] = [set() for _ in texts]
    starts = np.cumsum([0] + [len(f) + 1 for f, _ in forms])
    whole = b"\x00".join(f for f, _ in forms)
    for search, sizes, owners in searches:
        by_text: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for place, number in search.find(whole):
            by_text[int(np.searchsorted(starts, place, "right")) - 1].append((place, number))
        for text, found in by_text.items():
            form, base, counted, words = forms[text][0], int(starts[text]), 0, 0
            for place, number in sorted(found):
                words += form.count(b" ", counted, place - base)
                counted = place - base
                hits[text].update(range(words, words + sizes[number]))
                items[text].update(owners[number])
    return [(n, sorted(h), i) for (_, n), h, i in zip(forms, hits, items)]


def _pass(df: DataFrame, text_col: str, prefix: str, items: list, window: int) -> DataFrame:
    """One block's search; adds to the hit words and items found so far."""
    key = zlib.crc32(repr((items, window)).encode())
    held = df.sparkSession.sparkContext.broadcast((items, window))
    names = df.columns
    at, words_at, hits_at, items_at = (names.index(c) for c in (text_col, prefix + "words", prefix + "hits", prefix + "items"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searches = per_worker(("wu-manber", key), lambda: build_searches(*held.value))
        for batch in batches:
            begin = 0
            lengths = np.asarray(pc.fill_null(pc.binary_length(batch.column(at)), 0), np.int64)
            ends = np.cumsum(lengths)
            while begin < batch.num_rows:
                base = ends[begin - 1] if begin else 0
                end = max(begin + 1, int(np.searchsorted(ends, base + SEARCH_BYTES, "right")))
                part = batch.slice(begin, end - begin)
                found = search_texts(part.column(at).to_pylist(), searches)
                columns = list(part.columns)
                hits, own = part.column(hits_at).to_pylist(), part.column(items_at).to_pylist()
                columns[words_at] = pa.array([n for n, _, _ in found], pa.int64())
                columns[hits_at] = pa.array([h if not old else sorted({*old, *h}) for (_, h, _), old in zip(found, hits)],
                                            pa.list_(pa.int32()))
                columns[items_at] = pa.array([sorted({*(old or ()), *i}) for (_, _, i), old in zip(found, own)],
                                             pa.list_(pa.string()))
                yield pa.record_batch(columns, schema=pa.schema(
                    [pa.field(f.name, c.type) for f, c in zip(part.schema, columns)]))
                begin = end

    return df.mapInArrow(run, df.schema)


def mark_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = 10, text_col: str = "text",
                      item_col: str = "item_id", item_text: str = "text", prefix: str = "decon_",
                      block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` plus <prefix>words (count), <prefix>hits (places of hit words) and <prefix>items."""
    items = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(item_text).cast("string").alias("text"))
    items = items.where("item is not null and text is not null").distinct()
    total = items.agg(F.coalesce(F.sum(F.octet_length("text") + 64), F.lit(0))).first()[0]
    blocks = max(1, -(-2 * int(total) // block_bytes))
    block = F.pmod(F.xxhash64("item", "text"), F.lit(blocks))
    typed = [(prefix + "words", "bigint"), (prefix + "hits", "array<int>"), (prefix + "items", "array<string>")]
    out = docs.drop(*[n for n, _ in typed]).select("*", *[F.lit(None).cast(t).alias(n) for n, t in typed])
    out = out.withColumn(text_col, F.col(text_col).cast("string")) if dict(docs.dtypes)[text_col] != "string" else out
    for number in range(blocks):
        own = items if blocks == 1 else items.where(block == number)
        out = _pass(out, text_col, prefix, sorted(tuple(r) for r in own.collect()), window)
    return out


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated for every row."""
    marked = mark_contaminated(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")),
                               benchmark, window)
    return marked.select(
        "doc_id", F.col("decon_words").alias("n_words"), F.size("decon_hits").cast("long").alias("n_hit"),
        F.size("decon_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("decon_items", ","), 256).alias("items_sha256"),
        (F.size("decon_hits") > 0).alias("contaminated"))
