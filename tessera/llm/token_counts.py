"""Operator 5: token counts by heap-and-linked-list byte-pair merging.

A pre-token starts as its byte symbols, the last one carrying the end-of-word
mark. Adjacent pairs with a merge rank wait in a heap by (rank, position); the
lowest is popped, its right symbol is unlinked from the list, and the two new
neighbours are pushed. A popped pair whose symbols have changed since is
stale and skipped. The count is the initial symbols minus the merges made; no
ids are emitted.

The tokenizer file gives the merges; the normaliser and split pattern of such
files (NFC, lower case by character, words without white space, special
strings matched in the raw text as one token each) are applied here.

Defined cases: null text counts as empty (0 bytes, 0 tokens); repeated rows
are counted row by row; an empty table gives no rows; only the id and text
columns are read, so further columns cannot clash; a tokenizer file with
another normaliser, splitter or model raises a ValueError.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Callable, Iterator
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import Memo, load_tokenizer, per_worker, slices, tokenizer_file
from .tokens import CACHE_RUNS, HEAD, WORD, byte_symbols, split_words

# Fixed value: the split pattern of the tokenizer files with word ends.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: What a file has to say of its normaliser and splitter to be counted here.
NORMALISERS = ["NFC", "Replace", "Lowercase"]


def check_spec(spec: dict, name: str) -> None:
    """Raise for files whose steps before merging are not those done here."""
    parts = (spec.get("normalizer") or {}).get("normalizers") or []
    split = ((spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}])
    patterns = [p.get("pattern", {}).get("Regex") for p in (parts[1:2] + split[:1])]
    flags = [spec["model"].get(f) for f in ("byte_fallback", "fuse_unk", "ignore_merges", "dropout", "continuing_subword_prefix")]
    plain = all(not (t.get("normalized") or t.get("lstrip") or t.get("rstrip") or t.get("single_word"))
                for t in spec.get("added_tokens") or ())
    if ([p.get("type") for p in parts] != NORMALISERS or patterns != [r"\s+", SPLIT] or [p.get("type") for p in split] !=
            ["Split", "ByteLevel"] or any(flags) or not plain or spec["model"].get("type") != "BPE"):
        raise ValueError(f"{name}: another normaliser, splitter or model than the one handled here")


class PairMerger:
    """Counts tokens of one pre-token."""

    def __init__(self, merges: list, end: str):
        symbols: dict[str, int] = {}
        number = lambda s: symbols.setdefault(s, len(symbols))
        bytewise = byte_symbols()
        self.inner = [number(c) for c in bytewise]
        self.last = [number(c + end) for c in bytewise]
        self.rank: dict[tuple[int, int], tuple[int, int]] = {}
        for n, pair in enumerate(merges):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.rank[number(left), number(right)] = (n, number(left + right))

    def count(self, word: bytes) -> int:
        size = len(word)
        if size < 2:
            return size
        rank = self.rank
        symbol = [self.inner[b] for b in word[:-1]]
        symbol.append(self.last[word[-1]])
        after, before = list(range(1, size + 1)), list(range(-1, size - 1))
        heap = []
        for at in range(size - 1):
            found = rank.get((symbol[at], symbol[at + 1]))
            if found:
                heap.append((found[0], at, found[1]))
        heapify(heap)
        merges = 0
        while heap:
            order, at, made = heappop(heap)
            right = after[at]
            if symbol[at] < 0 or right >= size or rank.get((symbol[at], symbol[right])) != (order, made):
                continue
            merges += 1
            symbol[at], symbol[right] = made, -1
            nxt = after[at] = after[right]
            if nxt < size:
                before[nxt] = at
                found = rank.get((made, symbol[nxt]))
                if found:
                    heappush(heap, (found[0], at, found[1]))
            prev = before[at]
            if prev >= 0:
                found = rank.get((symbol[prev], made))
                if found:
                    heappush(heap, (found[0], prev, found[1]))
        return size - merges


def other_lower(tokenizer) -> dict[int, str]:
    """Characters whose normal form in this tokenizer, whose Unicode tables may be newer, is not the one made here."""
    chars = [c for c in map(chr, [*range(0x80, 0xD800), *range(0xE000, 0x40000)]) if not c.isspace()]
    found = tokenizer.normalizer.normalize_str(" ".join(chars)).split(" ")
    mine = ["".join(map(str.lower, unicodedata.normalize("NFC", c))) for c in chars]
    return {ord(c): theirs for c, theirs, own in zip(chars, found, mine) if theirs != own} if len(found) == len(chars) else {}


def make_counter(name_or_path: str) -> Callable[[str], int]:
    """``text -> number of tokens`` for a byte-pair file with word ends."""
    import regex

    with open(tokenizer_file(name_or_path), encoding="utf-8") as f:
        spec = json.load(f)
    check_spec(spec, name_or_path)
    merger = PairMerger(spec["model"]["merges"], spec["model"].get("end_of_word_suffix") or "")
    special = sorted((t["content"] for t in spec.get("added_tokens", ())), key=len, reverse=True)
    cut = re.compile("(" + "|".join(map(re.escape, special)) + ")") if special else None
    find = regex.compile(SPLIT).findall
    newer = other_lower(load_tokenizer(name_or_path))
    word = Memo(lambda w: merger.count(w.encode()), CACHE_RUNS)

    def plain(part: str) -> int:
        lower = "".join(map(str.lower, unicodedata.normalize("NFC", part).translate(newer)))
        return sum([word[w] for w in find(lower)])

    def whole(run: str) -> int:
        if cut is None:
            return plain(run)
        parts = cut.split(run)
        return len(parts) // 2 + sum(map(plain, parts[::2]))

    other = Memo(whole, CACHE_RUNS // 4)

    def compound(run: str) -> int:
        """Latin letters before an ASCII mark are a pre-token by themselves."""
        head = HEAD.fullmatch(run)
        if head:
            return word[head[1].lower()] + other[head[2]]
        return word[run.lower()] if WORD.fullmatch(run) else other[run]

    get = word.get
    return lambda text: sum([get(r) or compound(r) for r in split_words(text)])


def count_tokens(docs: DataFrame, tokenizer: str, limit: int, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) for every row."""
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = per_worker(("counter", tokenizer), lambda: make_counter(tokenizer))
        for batch in batches:
            for part in slices(batch):
                texts = [t or "" for t in part.column(1).to_pylist()]
                counts = [count(t) for t in texts]
                yield pa.record_batch([part.column(0), pa.array([len(t.encode()) for t in texts], pa.int64()),
                                       pa.array(counts, pa.int64()),
                                       pa.array([c > limit for c in counts], pa.bool_())],
                                      ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return slim.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
