"""Operators 2, 4 and 5 against the tokenizers library and round trips."""

import collections
import random
import zlib

import numpy as np
import pytest

from pyspark.sql import functions as F
from tessera.llm import packing, token_counts, token_files
from tessera.llm.common import load_tokenizer
from tessera.llm.tokens import KEEPS_SPACE, make_encoder

ALPHABET = list("abcdeTHE's'll  \t\n\r\x1c\x1f\x85\xa0 　.,!?0123456789İΣßéÉñ漢字☃😀́‍") + [
    "<|endoftext|>", "<|startoftext|>", "the ", "tion", "\x00", "ﬁ", "Å", "½", "Ⅷ", "ẞ", "﻿"]


def random_texts(count=1500):
    rng = random.Random(1)
    return ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 60))) for _ in range(count)]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_runs_give_the_ids_of_the_text(name):
    whole, by_run = load_tokenizer(name), make_encoder(name)
    for text in random_texts():
        assert np.frombuffer(by_run(text), np.uint32).tolist() == whole.encode(text, add_special_tokens=False).ids, repr(text)


def test_letters_before_a_mark_are_runs_by_themselves():
    text = "Abé, cd.\nEf x1, a\x1cb; \n gh'll  ij! İk,"
    runs = ["Abé", ",", " cd", ".", "\n", "Ef", " x1,", " a\x1cb;", " \n gh'll", "  ij!", " İk,"]
    assert KEEPS_SPACE.findall(text) == runs
    # the ids are the library's
    whole, by_run = load_tokenizer("byte_bpe_50k.json"), make_encoder("byte_bpe_50k.json")
    rng = random.Random(2)
    words = ["the", "Été", "don't", "x1", "naïve", "ſ", "re", "\n", " ", "", "\xa0", "漢字"]
    for _ in range(2000):
        text = "".join(rng.choice(words) + rng.choice(list(",.!'’-_`{~ \n  ")) for _ in range(rng.randint(1, 12)))
        assert np.frombuffer(by_run(text), np.uint32).tolist() == whole.encode(text, add_special_tokens=False).ids, repr(text)


def test_merging_counts_like_the_library():
    whole, count = load_tokenizer("word_bpe_49k.json"), token_counts.make_counter("word_bpe_49k.json")
    for text in random_texts():
        assert count(text) == len(whole.encode(text, add_special_tokens=False).ids), repr(text)


def test_letters_are_those_of_the_library():
    whole, count = load_tokenizer("word_bpe_49k.json"), token_counts.make_counter("word_bpe_49k.json")
    codes = [c for c in range(0x80, 0x20000) if not 0xD800 <= c < 0xE000]
    texts = [f"b{chr(c)}b" for c in codes]
    for text, coded in zip(texts, whole.encode_batch(texts, add_special_tokens=False)):
        assert count(text) == len(coded.ids), ascii(text)


def test_other_files_are_refused():
    with pytest.raises(ValueError, match="byte_bpe_50k"):
        token_counts.make_counter("byte_bpe_50k.json")


def test_token_counts_of_odd_documents(odd_docs, no_docs):
    whole = load_tokenizer("word_bpe_49k.json")
    expected = collections.Counter()
    for r in odd_docs.collect():
        n = len(whole.encode(r.text or "", add_special_tokens=False).ids)
        expected[r.doc_id, len((r.text or "").encode()), n, n > 50] += 1
    got = collections.Counter(tuple(r) for r in token_counts.count_tokens(odd_docs, "word_bpe_49k.json", 50).collect())
    assert got == expected
    assert token_counts.count_tokens(no_docs, "word_bpe_49k.json", 50).collect() == []


def brute_pieces(rows, capacity=1024):
    whole, out = load_tokenizer("byte_bpe_50k.json"), collections.Counter()
    for r in rows:
        ids = whole.encode(r.text or "", add_special_tokens=False).ids + [2]
        cuts = [0, *range(len(ids) % capacity or capacity, len(ids) + 1, capacity)]
        for piece, (a, b) in enumerate(zip(cuts, cuts[1:])):
            out[r.doc_id, piece, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())] += 1
    return out


def check_packing(packed, rows, capacity=1024):
    assert collections.Counter(tuple(r)[:5] for r in packed) == brute_pieces(rows, capacity)
    sequences = collections.defaultdict(list)
    for r in packed:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def test_packing_is_whole_and_gapless(documents, odd_docs, no_docs):
    for docs in (documents, odd_docs):
        check_packing(packing.pack_documents(docs).collect(), docs.collect())
    assert packing.pack_documents(no_docs).collect() == []


def test_partitions_exchange_until_the_bound(spark, documents):
    rng = random.Random(2)
    lengths = [rng.choice([rng.randint(1, 300), rng.randint(200, 1024)]) for _ in range(3000)]
    pieces = spark.createDataFrame([(i, n) for i, n in enumerate(lengths)], "doc_id long, length long")
    values, counts = np.unique(lengths, return_counts=True)
    bound = packing.lower_bound(values, counts, 1024)
    alone = len(packing.best_fit_decreasing(np.array(lengths), 1024)[2])
    apart = packing.pack(pieces, 1024, group_items=200).select("sequence_id").distinct().count()
    assert bound <= alone <= apart <= bound + max(2, bound // 100)


def test_a_worse_round_is_dropped(spark, monkeypatch):
    """The second round gives each item a bin of its own; the first round's packing stays, whole."""
    right, rounds = packing._pack_round, []

    def spoilt(pool, groups, number, capacity):
        rounds.append(number)
        packed = right(pool, groups, number, capacity)
        if number:
            packed = packed.withColumns({"sequence_id": F.col("doc_id") + (1 << 60), "offset": F.lit(0).cast("long"),
                                         "opens": F.lit(1).cast("long")})
        return packed

    rng = random.Random(8)
    lengths = [rng.randint(200, 700) for _ in range(400)]
    pieces = spark.createDataFrame([(i, n) for i, n in enumerate(lengths)], "doc_id long, length long")
    monkeypatch.setattr(packing, "_pack_round", spoilt)
    got = packing.pack(pieces, 1024, group_items=50).collect()
    assert rounds == [0, 1] and sorted(r.doc_id for r in got) == list(range(400))
    assert max(r.sequence_id for r in got) < 1 << 60
    fill = collections.Counter()
    for r in got:
        fill[r.sequence_id] += r.length
    assert max(fill.values()) <= 1024


def test_dual_feasible_bound():
    rng = np.random.default_rng(3)
    for _ in range(60):
        lengths = rng.integers(1, 100, rng.integers(1, 40))
        values, counts = np.unique(lengths, return_counts=True)
        bound = packing.lower_bound(values, counts, 100)
        assert -(-int(lengths.sum()) // 100) <= bound <= len(packing.best_fit_decreasing(lengths, 100)[2])
    assert packing.lower_bound(np.array([51, 60]), np.array([5, 2]), 100) == 7
    assert packing.lower_bound(np.array([34]), np.array([9]), 100) == 5
    assert packing.lower_bound(np.array([], int), np.array([], int), 100) == 0


def test_sequences_hold_the_ids(documents):
    docs = documents.limit(20)
    packed = packing.pack_documents(docs, with_ids=True)
    pieces = {(r.sequence_id, r.offset): r for r in packed.collect()}
    for s in packing.sequences(packed).collect():
        for (sequence, offset), r in pieces.items():
            if sequence == s.sequence_id:
                assert zlib.crc32(bytes(s.ids[4 * offset:4 * (offset + r.length)])) == r.ids_crc32


def test_codes_round_trip_and_random_access():
    rng = np.random.default_rng(4)
    for ids in (rng.integers(0, 49408, 5000), rng.integers(0, 200, 700), rng.integers(0, 1 << 31, 3000), np.array([], int), np.array([255, 256])):
        codes = token_files.Codes(token_files.encode_ids(ids.astype(np.uint32)))
        assert codes.ids(0, len(ids)).tolist() == ids.tolist()
        for at in rng.integers(0, max(1, len(ids)), 200 if len(ids) else 0):
            assert codes[int(at)] == ids[at]
            assert codes.ids(int(at), min(len(ids), int(at) + 600)).tolist() == ids[at:at + 600].tolist()


def test_token_files_read_back(spark, odd_docs, no_docs, documents, tmp_path):
    whole = load_tokenizer("word_bpe_49k.json")
    ids = lambda t: whole.encode(t or "", add_special_tokens=False).ids + [2]
    rows = sorted(documents.collect(), key=lambda r: r.doc_id)
    expected, start, flat = {}, 0, []
    for r in rows:
        own = ids(r.text)
        expected[r.doc_id] = (start, len(own), zlib.crc32(np.array(own, "<u4").tobytes()))
        start, flat = start + len(own), flat + own
    path = str(tmp_path / "files")
    token_files.write_token_files(documents, path, partitions=5, segment_ids=3000)
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in token_files.read_documents(spark, path).collect()}
    assert got == expected
    places = list(range(0, len(flat), 97)) + [len(flat) - 1, len(flat), -1]
    found = token_files.read_tokens(spark, path, spark.createDataFrame([(p,) for p in places], "position long"))
    assert {r.position: r.token_id for r in found.collect()} == {p: flat[p] for p in places if 0 <= p < len(flat)}
    odd = token_files.token_files(odd_docs).collect()
    assert collections.Counter((r.doc_id, r.n_tokens) for r in odd) == collections.Counter(
        (r.doc_id, len(ids(r.text))) for r in odd_docs.collect())
    assert sorted(r.start for r in odd)[0] == 0 and len({r.start for r in odd}) == len(odd)
    assert token_files.token_files(no_docs).collect() == []
