"""Operator 12: fill-in-the-middle transformation with content-defined chunk memoization.

A token is a run of other characters with the white space before it, or white
space at the end of the text. Two hashed token numbers cut a document into
prefix, middle and suffix; its form then orders the three parts between marks.

To find the cuts, a rolling hash over the last 16 characters splits a text
into chunks wherever the hash has a fixed pattern, so equal passages of
different texts give equal chunks. What the cuts need of a chunk is its
boundary summary: the number of its runs, and whether it starts and ends
inside one. The summary is kept in a cache under the whole content of the
chunk, which the look-up compares, so a shared chunk is read once and no hash
collision can pass. Summaries combine from left to right (a run that crosses a
boundary counts once); the running counts name the one chunk in which a token
ends, and only that chunk is searched.

Defined cases: null text counts as empty, an empty text is plain with 0
tokens, a text that holds a mark is plain, a null id hashes as the empty
string; repeated rows are transformed alike, row by row; an empty table gives
no rows; the input's columns pass through, and a ValueError names those that
clash with the added ones.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import LongType, StringType, StructType

from .common import Memo, per_worker, slices

#: Marks before the prefix, the suffix and the middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: White space of tokens: the ASCII characters at which bytes.split() splits.
SPACE = " \t\n\v\f\r"
RUN = re.compile(r"[^\x20\x09-\x0D]+")
#: A chunk ends where the top bits of the rolling hash are zero, within these lengths.
TOP_BITS, LEAST, MOST = 6, 32, 512
#: Characters hashed at a time, and those before a strip that its first hashes still see.
STRIP, WINDOW = 1 << 20, 16
#: Chunks kept by a worker.
CACHE_CHUNKS = 100_000

ADDED = ("n", "form", "prefix_chars", "middle_chars", "fim_text")


def rolling_hash(codes: np.ndarray) -> np.ndarray:
    """At each place, the sum of the last 16 characters' mixed codes, shifted by their distance, modulo 2^32."""
    h = codes * np.uint32(0x9E3779B1)
    h = (h ^ (h >> np.uint32(15))) * np.uint32(0x85EBCA77)
    for reach in (1, 2, 4, 8):  # doubles the characters that a hash covers
        wider = h.copy()
        wider[reach:] += h[:-reach] << np.uint32(reach)
        h = wider
    return h


def boundaries(text: str) -> list[int]:
    """Places after which the rolling hash allows a cut, ascending."""
    found = []
    for start in range(0, len(text), STRIP):
        back = min(start, WINDOW - 1)
        codes = np.frombuffer(text[start - back:start + STRIP].encode("utf-32-le"), np.uint32)
        hit = np.flatnonzero(rolling_hash(codes)[back:] >> np.uint32(32 - TOP_BITS) == 0)
        found += (hit + (start + 1)).tolist()
    return found


def chunks(text: str) -> list[str]:
    """Content-defined chunks of LEAST to MOST characters (the last one may be shorter)."""
    allowed, size = boundaries(text), len(text)
    edges, at, i = [0], 0, 0
    while size - at > LEAST:
        i = bisect_left(allowed, at + LEAST, i)
        at = min(allowed[i] if i < len(allowed) else size, at + MOST)
        if at >= size:
            break
        edges.append(at)
    return [text[a:b] for a, b in zip(edges, [*edges[1:], size])]


def summary(chunk: str) -> tuple[int, bool, bool]:
    """(runs, starts inside a run, ends inside a run)."""
    return len(chunk.encode().split()), chunk[0] not in SPACE, chunk[-1] not in SPACE


class TokenPlaces:
    """Token count of a text and the places where its tokens end."""

    def __init__(self, text: str, summaries: Memo):
        self.size, self.parts = len(text), chunks(text) if text else []
        read = [summaries[c] for c in self.parts]
        self.starts = [s[1] for s in read]
        #: whether the first run of a chunk began in an earlier one
        self.joined = [False, *[a[2] and b[1] for a, b in zip(read, read[1:])]]
        self.runs = list(accumulate([s[0] - j for s, j in zip(read, self.joined)]))
        self.total = self.runs[-1] + (not read[-1][2]) if read else 0

    def end(self, token: int) -> int:
        """Characters up to the end of the given token, counted from 1; 0 for 0."""
        if token == 0:
            return 0
        if token == self.total:
            return self.size
        part = bisect_left(self.runs, token)
        nth = token - (self.runs[part - 1] if part else 0) + self.joined[part]
        for found in RUN.finditer(self.parts[part]):
            nth -= 1
            if nth == 0:
                break
        place = found.end()
        at = sum(map(len, self.parts[:part]))
        # a run that reaches its chunk's end goes on in the chunks that start inside it
        while place == len(self.parts[part]) and part + 1 < len(self.parts) and self.starts[part + 1]:
            at += place
            part += 1
            place = RUN.match(self.parts[part]).end()
        return at + place


def transform(key: str, text: str, seed: int, rate: int, spm: int, summaries: Memo) -> tuple:
    """(n, form, prefix_chars, middle_chars, output) of one text."""
    digest = hashlib.sha256(f"{seed}:{key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i:i + 8], 16) for i in (0, 8, 16, 24))
    places = TokenPlaces(text, summaries)
    n = places.total
    if not text or h3 % 100 >= rate or PREFIX in text or SUFFIX in text or MIDDLE in text:
        return n, "plain", None, None, text
    first, second = sorted((h1 % (n + 1), h2 % (n + 1)))
    a, b = places.end(first), places.end(second)
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h4 % 100 < spm:
        return n, "spm", a, b - a, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return n, "psm", a, b - a, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def fill_in_middle(docs: DataFrame, seed: int = 42, rate: int = 50, spm: int = 80, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """``docs`` with its token count ``n``, ``form``, part lengths and the transformed text ``fim_text``.

    Of 100 documents about ``rate`` are transformed, and of these ``spm`` in suffix-prefix-middle order.
    """
    clash = [c for c in (*ADDED, "__key", "__text") if c.lower() in {d.lower() for d in docs.columns}]
    if clash:
        raise ValueError(f"columns {clash} exist already")
    own = docs.withColumns({"__key": F.coalesce(F.col(id_col).cast("string"), F.lit("")),
                            "__text": F.coalesce(F.col(text_col).cast("string"), F.lit(""))})
    schema = StructType([*docs.schema.fields])
    for name in ADDED:
        schema.add(name, StringType() if name in ("form", "fim_text") else LongType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        summaries = per_worker(("fim chunks",), lambda: Memo(summary, CACHE_CHUNKS, longest=MOST))
        for batch in batches:
            for part in slices(batch):
                *kept, keys, texts = part.columns
                made = [transform(k, t, seed, rate, spm, summaries)
                        for k, t in zip(keys.to_pylist(), texts.to_pylist())]
                kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string())
                new = [pa.array([row[i] for row in made], kind) for i, kind in enumerate(kinds)]
                yield pa.record_batch([*kept, *new], [*part.schema.names[:-2], *ADDED])

    return own.mapInArrow(run, schema)


def restored(output: Column, form: Column) -> Column:
    """The text before the transformation; marks occur once each in a transformed text, so they split it uniquely."""
    def between(mark: str, end: str | None) -> Column:
        rest = F.element_at(F.split(output, mark, -1), 2)
        return F.element_at(F.split(rest, end, -1), 1) if end else rest

    return (F.when(form == "psm", F.concat(between(PREFIX, SUFFIX), between(MIDDLE, None), between(SUFFIX, MIDDLE)))
            .when(form == "spm", F.concat(between(PREFIX, MIDDLE), between(MIDDLE, None), between(SUFFIX, PREFIX)))
            .otherwise(output))


def fim_digests(docs: DataFrame) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, digests of the output and of the text restored from it)."""
    made = fill_in_middle(docs.select("doc_id", "text")).drop("text")
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                       F.sha2("fim_text", 256).alias("output_sha256"),
                       F.sha2(restored(F.col("fim_text"), F.col("form")), 256).alias("restored_sha256"))
