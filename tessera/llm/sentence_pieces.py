"""Operator 13: SentencePiece encoding and decoding in vectorised merge rounds.

A byte-pair ``.model`` merges, again and again, the adjacent symbols of a text
whose joint piece has the best score, the leftmost first. No merge can cross
two characters that stand side by side in no piece, so a text falls into
segments there. Distinct words that are not in the worker's cache are encoded
together: their symbols lie in one flat numpy array, and a round

1. looks up the rank of every adjacent pair,
2. takes the least rank of each segment (a segmented minimum),
3. merges, in all segments at once, the leftmost pairs of that rank, and
4. compacts the array; segments without a pair leave it,

until no pair remains. The order of merging is the library's own. Where the
merged piece is only part of pieces of worse score, nothing made by the merge
can come before the other pairs of that rank, so all of them that do not
overlap merge in one round. Otherwise (scores shared by several pieces, or a
part scored worse than its whole) one pair per segment merges in a round; in a
long segment one pass from left to right does the rank's merges with all that
they make possible, in the library's order.

Characters without a piece become byte pieces. Decoding joins the bytes of the
pieces, turns the space mark into spaces and drops the first one.

Defined cases: null text counts as empty and has no ids; an empty array
decodes to an empty text, a null array or null ids in it to those left;
repeated rows are encoded row by row; an empty table gives no rows; other
columns pass through, and a ValueError names one that clashes with the added
column; a ValueError also says when a model is not of the kind handled here.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructType

from .common import per_worker, slices, tokenizer_file

MODEL = "piece_bpe_32k.model"
#: The visible mark of a space in pieces.
MARK = "▁"
#: Words kept by a worker, and the longest one kept.
CACHE_WORDS, CACHE_LENGTH = 400_000, 48
#: Segments of more symbols do ranks that merge one by one in a pass of their own.
LONG = 64
NO_RANK = np.iinfo(np.int32).max


def load_processor(name_or_path: str):
    from sentencepiece import SentencePieceProcessor

    return SentencePieceProcessor(model_file=tokenizer_file(name_or_path))


class PieceEncoder:
    """Words to ids of a byte-pair model with byte fallback, identity normalisation and a dummy space in front."""

    def __init__(self, name_or_path: str):
        model = load_processor(name_or_path)
        size = model.get_piece_size()
        special = [i for i in range(size) if model.is_control(i) or model.is_unknown(i) or model.is_byte(i)]
        self.byte_ids = np.array([model.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.int32)
        pieces = {model.id_to_piece(i): i for i in range(size)}
        for i in special:
            pieces.pop(model.id_to_piece(i))
        # symbols are pieces and, after them, single characters that occur in pieces only
        symbols = dict(pieces)
        for piece in pieces:
            for c in piece:
                symbols.setdefault(c, len(symbols) + len(special))
        self.width = len(symbols) + len(special)
        scores = sorted({model.get_score(i) for i in pieces.values()}, reverse=True)
        place = {s: n for n, s in enumerate(scores)}
        rank = {p: place[model.get_score(i)] for p, i in pieces.items()}
        shared = np.bincount(np.fromiter(rank.values(), np.int64), minlength=len(scores)) > 1

        self.of_char = np.full(0x110000, -1, np.int32)
        self.is_piece = np.zeros(self.width, bool)
        self.is_piece[list(pieces.values())] = True
        for symbol, i in symbols.items():
            if len(symbol) == 1:
                self.of_char[ord(symbol)] = i
        self.of_char[ord(" ")] = self.of_char[ord(MARK)]
        lone = np.zeros(self.width, bool)
        keys, made, ranks = [], [], []
        for piece, i in pieces.items():
            for k in range(1, len(piece)):
                left, right = symbols.get(piece[:k]), symbols.get(piece[k:])
                if left is None or right is None:
                    continue
                keys.append(left * self.width + right)
                made.append(i)
                ranks.append(rank[piece])
                for part in (piece[:k], piece[k:]):
                    if len(part) > 1 and rank[part] >= rank[piece]:
                        lone[symbols[part]] = True
        order = np.argsort(keys)
        self.keys, self.made, self.ranks = np.array(keys)[order], np.array(made, np.int32)[order], np.array(ranks, np.int32)[order]
        #: ranks that merge one by one: shared by pieces, or of a piece that may be merged on at once
        self.one_by_one = shared.copy()
        self.one_by_one[[rank[p] for p, i in pieces.items() if lone[i]]] = True
        self.beside = np.unique([symbols[a] * self.width + symbols[b] for p in pieces for a, b in zip(p, p[1:])])
        self.pair = dict(zip(self.keys.tolist(), zip(self.ranks.tolist(), self.made.tolist())))
        self.longest = max(map(len, pieces))
        stop = "" if self.of_char[10] >= 0 else "\n"
        #: words: a run of spaces and the other characters after it; a line end that no piece holds stands alone
        self.words = re.compile(f"[ {MARK}]*[^ {MARK}{stop}]+|[ {MARK}]+" + ("|\n" if stop else "")).findall
        self.cache: dict[str, bytes] = {}
        inside = [p for p in pieces if re.search(f"[^{MARK}]{MARK}", p)]
        probe = "  Ab  c\t\n1 ﬁÅ " + " ".join(p for n, p in enumerate(pieces) if n % 16 == 0)
        if inside or min(self.byte_ids) < 0 or np.frombuffer(self.encode([probe])[0], np.int32).tolist() != model.encode(probe):
            raise ValueError(f"{name_or_path}: not a byte-pair model with byte fallback, identity normalisation and a dummy space")

    def lookup(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank, place in the pair table) of pairs of symbols; NO_RANK where no piece joins them."""
        key = left.astype(np.int64) * self.width + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NO_RANK), at

    def one_pass(self, symbols: list[int], starts: list[int], rank: int) -> tuple[list[int], list[int]]:
        """All merges of ``rank``, the best of a segment, from left to right, each followed by the better ones it allows.

        Left of the current symbol no pair of this rank or a better one is left; right of it none is better. So the
        next merge of the whole segment is always one beside the current symbol.
        """
        pair, width, none = self.pair, self.width, (NO_RANK, -1)
        done, places, i, n = [], [], 0, len(symbols)
        current, place = symbols[0], starts[0]
        while True:
            back = pair.get(done[-1] * width + current, none) if done else none
            ahead = pair.get(current * width + symbols[i + 1], none) if i + 1 < n else none
            if min(back, ahead)[0] <= rank:
                if back[0] <= ahead[0]:  # the left one first where both are as good
                    done.pop()
                    current, place = back[1], places.pop()
                else:
                    current, i = ahead[1], i + 1
                continue
            done.append(current)
            places.append(place)
            i += 1
            if i >= n:
                return done, places
            current, place = symbols[i], starts[i]

    def spans(self, hits: np.ndarray, heads: np.ndarray, sizes: np.ndarray, least: np.ndarray,
              chosen: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(from, to, rank) around the hits of the chosen segments, as far as pieces that hold a hit can reach."""
        for s in np.flatnonzero(chosen):
            a, b = heads[s], heads[s] + sizes[s]
            own = hits[np.searchsorted(hits, a):np.searchsorted(hits, b)]
            low, high = np.maximum(own - self.longest, a), np.minimum(own + 2 + self.longest, b)
            gap = np.flatnonzero(low[1:] > high[:-1])
            yield from zip(low[np.append(0, gap + 1)].tolist(), high[np.append(gap, -1)].tolist(), [least[s]] * (len(gap) + 1))

    def merge(self, symbol: np.ndarray, segment: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(symbols, where each starts) after all merges; ``segment`` numbers never fall along the array."""
        start = np.arange(len(symbol))
        rank, at = np.full(len(symbol), NO_RANK, np.int32), np.zeros(len(symbol), np.int64)
        stale = start  # symbols whose pair with the next one has to be looked up
        over_symbols, over_starts = [], []
        while len(symbol):
            stale = stale[stale < len(symbol) - 1]
            stale = stale[segment[stale] == segment[stale + 1]]
            rank[stale], at[stale] = self.lookup(symbol[stale], symbol[stale + 1])
            heads = np.flatnonzero(np.concatenate([[True], segment[1:] != segment[:-1]]))
            sizes = np.diff(np.append(heads, len(symbol)))
            least = np.minimum.reduceat(rank, heads)
            over = np.repeat(least == NO_RANK, sizes)
            alone = (least != NO_RANK) & self.one_by_one[np.minimum(least, len(self.one_by_one) - 1)]
            hit = every = np.flatnonzero((rank == np.repeat(least, sizes)) & ~over)
            # of a run of overlapping pairs every other one merges; where one merge goes at a time, the segment's first
            fresh = np.flatnonzero(np.diff(hit, prepend=-2) != 1)
            even = (np.arange(len(hit)) - np.repeat(fresh, np.diff(np.append(fresh, len(hit))))) % 2 == 0
            owner = np.searchsorted(heads, hit, side="right") - 1
            leading = np.diff(owner, prepend=-1) != 0
            hit = hit[np.where(alone[owner], leading & (sizes[owner] <= LONG), even)]
            symbol[hit] = self.made[at[hit]]
            keep = np.ones(len(symbol), bool)
            keep[hit + 1] = False
            touched = [hit]
            for a, b, best in self.spans(every, heads, sizes, least, alone & (sizes > LONG)):
                merged, places = self.one_pass(symbol[a:b].tolist(), list(range(a, b)), best)
                keep[a:b] = False
                keep[places] = True
                symbol[places] = merged
                touched.append(np.array(places))
            over_symbols.append(symbol[over])
            over_starts.append(start[over])
            keep &= ~over
            touched = np.concatenate(touched)
            stale = (np.cumsum(keep) - 1)[touched]
            stale = np.concatenate([stale, stale[stale > 0] - 1])
            symbol, segment, start, rank, at = (x[keep] for x in (symbol, segment, start, rank, at))
            rank[stale] = NO_RANK
        symbols, starts = (np.concatenate([*x, np.zeros(0, np.int64)]).astype(np.int64) for x in (over_symbols, over_starts))
        order = np.argsort(starts, kind="stable")
        return symbols[order], starts[order]

    def encode_words(self, words: list[str]) -> list[bytes]:
        """Ids of each word as native 32-bit integers."""
        if not words:
            return []
        codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        symbol = self.of_char[codes]
        ends = np.cumsum([len(w) for w in words])
        new = np.ones(len(symbol), bool)
        key = symbol[:-1].astype(np.int64) * self.width + symbol[1:]
        place = np.minimum(np.searchsorted(self.beside, key), len(self.beside) - 1)
        new[1:] = (self.beside[place] != key) | (symbol[:-1] < 0) | (symbol[1:] < 0)
        new[ends[:-1]] = True
        symbol, start = self.merge(symbol, np.cumsum(new))
        spelled = ~((symbol >= 0) & self.is_piece[symbol])
        raw = [chr(c).encode() for c in codes[start[spelled]]]
        count = np.ones(len(symbol), np.int64)
        count[spelled] = [len(b) for b in raw]
        ids = np.repeat(symbol.astype(np.int32), count)
        ids[np.repeat(spelled, count)] = self.byte_ids[np.frombuffer(b"".join(raw), np.uint8)]
        stop = np.concatenate([[0], np.cumsum(count)])[np.searchsorted(start, ends)]
        flat = ids.tobytes()
        return [flat[4 * a:4 * b] for a, b in zip([0, *stop.tolist()], stop.tolist())]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as native 32-bit integers."""
        split = [self.words(" " + t) if t else [] for t in texts]
        cache = self.cache
        fresh = list({w for words in split for w in words if w not in cache})
        found = dict(zip(fresh, self.encode_words(fresh)))
        if len(cache) + len(found) > CACHE_WORDS:
            # of the words kept, those of these texts are needed again
            found |= {w: cache[w] for words in split for w in words if w in cache}
            cache.clear()
        cache |= {w: ids for w, ids in found.items() if len(w) <= CACHE_LENGTH}
        long = {w: ids for w, ids in found.items() if w not in cache}
        if not long:
            return [b"".join([cache[w] for w in words]) for words in split]
        return [b"".join([cache[w] if w in cache else long[w] for w in words]) for words in split]


class PieceDecoder:
    """Ids to texts."""

    def __init__(self, name_or_path: str):
        model = load_processor(name_or_path)
        size = model.get_piece_size()
        self.is_byte = np.array([model.is_byte(i) for i in range(size)])
        self.byte = np.array([int(model.id_to_piece(i)[3:5], 16) if self.is_byte[i] else 0 for i in range(size)], np.uint8)
        self.silent = np.array([model.is_control(i) for i in range(size)])
        self.is_text = ~self.is_byte & ~np.array([model.is_unknown(i) for i in range(size)])
        self.texts = [bytes([self.byte[i]]) if self.is_byte[i] else model.decode([i]).encode() if model.is_unknown(i) else b""
                      if self.silent[i] else model.id_to_piece(i).replace(MARK, " ").encode() for i in range(size)]

    def decode(self, ids: np.ndarray) -> str:
        silent = self.silent[ids]
        if silent.any():  # no character reaches over a control id
            runs = [r[~self.silent[r]] for r in np.split(ids, np.flatnonzero(silent))]
        else:
            runs = [ids]
        parts = [b"".join([self.texts[i] for i in r.tolist()]) for r in runs if len(r)]
        first = next((r[0] for r in runs if len(r)), None)
        if first is not None and self.is_text[first] and parts[0][:1] == b" ":
            parts[0] = parts[0][1:]  # the space that encoding puts in front
        return "".join(map(_characters, parts))


def _characters(part: bytes) -> str:
    """UTF-8 to text, with a replacement for each byte that belongs to no character."""
    out = []
    while True:
        try:
            return "".join([*out, part.decode()])
        except UnicodeDecodeError as e:
            out += [part[:e.start].decode(), "\ufffd"]
            part = part[e.start + 1:]


def _added(schema: StructType, name: str, kind) -> StructType:
    if name.lower() in {c.lower() for c in schema.names}:
        raise ValueError(f"column {name} exists already")
    return StructType([*schema.fields]).add(name, kind)


def encode_pieces(docs: DataFrame, model: str = MODEL, text_col: str = "text", out: str = "ids") -> DataFrame:
    """``docs`` with the ids of ``text_col``, as the sentencepiece library gives them without begin or end ids."""
    schema = _added(docs.schema, out, ArrayType(IntegerType()))
    own = docs.withColumn(text_col, F.col(text_col).cast("string"))
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = per_worker(("pieces", model), lambda: PieceEncoder(model))
        for batch in batches:
            for part in slices(batch):
                ids = encoder.encode([t or "" for t in part.column(at).to_pylist()])
                offsets = np.cumsum([0, *[len(i) // 4 for i in ids]], dtype=np.int32)
                flat = pa.array(np.frombuffer(b"".join(ids), np.int32))
                yield pa.record_batch([*part.columns, pa.ListArray.from_arrays(pa.array(offsets), flat)],
                                      [*part.schema.names, out])

    return own.mapInArrow(run, schema)


def decode_pieces(docs: DataFrame, model: str = MODEL, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """``docs`` with the text of the ids in ``ids_col``, as the sentencepiece library's decode(ids) gives it."""
    schema = _added(docs.schema, out, StringType())
    own = docs.withColumn(ids_col, F.col(ids_col).cast("array<int>"))
    at = docs.columns.index(ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = per_worker(("piece texts", model), lambda: PieceDecoder(model))
        for batch in batches:
            for part in slices(batch):
                texts = []
                for ids in part.column(at):
                    texts.append(decoder.decode(ids.values.drop_null().to_numpy(zero_copy_only=False))
                                 if ids.is_valid else "")
                yield pa.record_batch([*part.columns, pa.array(texts, pa.string())], [*part.schema.names, out])

    return own.mapInArrow(run, schema)


def piece_digests(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """(doc_id, n_tokens, digests of the ids and of the text decoded from them)."""
    coded = encode_pieces(docs.select("doc_id", "text"), model).drop("text")
    return decode_pieces(coded, model).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
