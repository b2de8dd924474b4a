"""Operators 11, 12 and 13 against brute force, the sentencepiece library and exact round trips."""

import collections
import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from tessera.llm import fill_middle, sentence_pieces, source_audit

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def brute_audit(rows, least, smooth, top):
    counts, docs = collections.defaultdict(collections.Counter), collections.defaultdict(collections.Counter)
    for text, lang, source in rows:
        words = TERM.findall((text or "").translate(LOWER))
        counts[lang or "", source or ""].update(words)
        docs[lang or ""].update(set(words))
    kept = {lang: [t for t in seen if seen[t] >= least] for lang, seen in docs.items()}
    total = {g: sum(c[t] for t in kept[g[0]]) for g, c in counts.items()}

    def shares(lang, count, n):
        return {t: 1 + 10**9 * (count[t] + smooth) // (n + smooth * len(kept[lang])) for t in kept[lang]}

    p = {g: shares(g[0], counts[g], total[g]) for g in counts}
    out = set()
    for g in counts:
        lang = g[0]
        whole = sum((counts[h] for h in counts if h[0] == lang), collections.Counter())
        q = shares(lang, whole, sum(whole[t] for t in kept[lang]))
        far = [(sum(abs(p[g][t] - p[h][t]) for t in kept[lang]), h[1]) for h in counts if h[0] == lang and h != g]
        over = [(p[g][t] - q[t], t) for t in kept[lang] if counts[g][t] and p[g][t] > q[t]]
        for part, found, limit in (("pair", far, len(far)), ("term", over, top)):
            found.sort(key=lambda x: (-x[0], x[1].encode()))
            out |= {(*g, part, item, value, n + 1) for n, (value, item) in enumerate(found[:limit])}
    return out


def audit_rows(spark, rows):
    return spark.createDataFrame([(t, lang, s, 1, "x") for t, lang, s in rows],
                                 "text string, lang string, source string, value int, rank string")


@pytest.fixture(scope="module")
def mixed():
    rng = random.Random(7)
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60)] + ["Ünï", "ÉT", "漢字", "MiXed"]
    rows = [(" ".join(rng.choice(words[:rng.randint(5, 64)]) for _ in range(rng.randint(0, 40))), rng.choice(["a", "b", None]),
             f"s{rng.randint(0, 9)}") for _ in range(400)]
    rows += [(None, "a", "silent"), ("", "b", ""), ("!!! 123", "b", None), (None, None, None), ("lone words here", "c", "x"),
             (None, "c", "y"), ("wa " * 4000, "a", "s1")]
    return rows + rows[:40]


@pytest.mark.parametrize("block, entries", [(256, 200_000), (3, 40)])
def test_audit_like_brute_force(spark, mixed, monkeypatch, block, entries):
    monkeypatch.setattr(source_audit, "BLOCK", block)
    monkeypatch.setattr(source_audit, "SLICE", entries)
    monkeypatch.setattr(source_audit, "HELD", 50)
    got = [tuple(r) for r in source_audit.audit_sources(audit_rows(spark, mixed), 12, 5, 7).collect()]
    assert len(got) == len(set(got))
    assert set(got) == brute_audit(mixed, 12, 5, 7)


def test_slices_name_a_pair_alike():
    # rows reach a cell in the order in which its blocks are fetched
    heads = [("s1", None, 0, 5, 2), ("s2", None, 0, 7, 2), ("Ü", None, 0, 9, 2)]
    body = [("s2", "x", 0, 20, 0), ("s1", "x", 0, 30, 0), ("Ü", "y", 0, 40, 0)]

    def pairs(rows):
        names = ["source", "term", "block", "p", "kept"]
        kinds = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
        cell = pa.table([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
        key = (pa.scalar("en"), pa.scalar(0), pa.scalar(0), pa.scalar(0))
        return sorted(tuple(r.values()) for r in source_audit._cell_rows(key, cell).to_pylist())

    # x: 30, 20, 9; y: 5, 7, 40
    assert pairs(heads + body) == [("en", "s1", "s2", 12), ("en", "s1", "Ü", 56), ("en", "s2", "Ü", 44)]
    for rows in (body + heads, heads[::-1] + body, body[::-1] + heads[::-1]):
        assert pairs(rows) == pairs(heads + body)


def test_audit_of_little(spark):
    empty = audit_rows(spark, [("a", "b", "c")]).limit(0)
    assert source_audit.audit_sources(empty).collect() == []
    few = [("one two", "a", "x"), (None, "a", "y"), ("three", "a", "y")]
    assert {tuple(r) for r in source_audit.audit_sources(audit_rows(spark, few)).collect()} == brute_audit(few, 30, 5, 50)


def test_shares_beyond_a_long_product(spark):
    n, total = 4 * 10**12, 9 * 10**12 + 7
    got = spark.range(1).select(source_audit.share(*(source_audit.F.lit(x) for x in (n, total)), 5)).first()[0]
    assert got == 1 + 10**9 * (n + 5) // total


def brute_fim(doc_id, text):
    text = text or ""
    key = "" if doc_id is None else str(doc_id)
    digest = hashlib.sha256(f"42:{key}".encode()).hexdigest()
    h = [int(digest[i:i + 8], 16) for i in (0, 8, 16, 24)]
    w = TOKEN.findall(text)
    assert "".join(w) == text
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return len(w), "plain", None, None, text
    a, b = sorted(x % (len(w) + 1) for x in h[:2])
    p, m, s = "".join(w[:a]), "".join(w[a:b]), "".join(w[b:])
    if h[3] % 100 < 80:
        return len(w), "spm", len(p), len(m), "<S>" + s + "<P>" + p + "<M>" + m
    return len(w), "psm", len(p), len(m), "<P>" + p + "<S>" + s + "<M>" + m


def odd_texts(count=400):
    rng = random.Random(11)
    alphabet = list("ab.  \t\n\r\x0b\x0c\x1c\x85\xa0é漢😀") + ["word ", "<P", ">", "long" * 30, "   " * 40, "<M>"]
    texts = ["".join(rng.choice(alphabet[:-1] if i % 9 else alphabet) for _ in range(rng.randint(0, 80))) for i in range(count)]
    return texts + ["x" * 5000, " " * 5000, "ab " * 3000, "x" * 600 + " ", "\n", "x"]


def test_fill_in_middle_like_brute_force(spark, odd_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()] + [(i + 50, t) for i, t in enumerate(odd_texts())]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    made = fill_middle.fill_in_middle(docs)
    made = made.withColumn("back", fill_middle.restored(made.fim_text, made.form))
    got = collections.Counter()
    for r in made.collect():
        assert r.back == (r.text or "")
        got[r.doc_id, r.text, r.n, r.form, r.prefix_chars, r.middle_chars, r.fim_text] += 1
    assert got == collections.Counter((i, t, *brute_fim(i, t)) for i, t in rows)
    assert {g[3] for g in got} == {"plain", "psm", "spm"}
    assert fill_middle.fill_in_middle(no_docs).collect() == []
    with pytest.raises(ValueError, match="form"):
        fill_middle.fill_in_middle(docs.withColumn("Form", docs.text))


def test_chunks_follow_the_content(monkeypatch):
    rng = random.Random(3)
    text = "".join(rng.choice("abcdefghij  ") for _ in range(20_000))
    parts = fill_middle.chunks(text)
    assert "".join(parts) == text
    assert all(fill_middle.LEAST <= len(c) <= fill_middle.MOST for c in parts[:-1])
    # text put in front changes the first chunks only
    moved = set(fill_middle.chunks("something else " * 5 + text))
    assert sum(c in moved for c in parts) > 0.9 * len(parts)
    monkeypatch.setattr(fill_middle, "STRIP", 97)
    assert fill_middle.chunks(text) == parts


def test_every_token_end():
    summaries = fill_middle.Memo(fill_middle.summary, 100, longest=fill_middle.MOST)
    for text in odd_texts(80):
        places, at = fill_middle.TokenPlaces(text, summaries), 0
        tokens = TOKEN.findall(text)
        assert places.total == len(tokens)
        for n, token in enumerate(tokens):
            assert places.end(n) == at
            at += len(token)


@pytest.fixture(scope="module")
def library():
    return sentence_pieces.load_processor(sentence_pieces.MODEL)


def piece_texts(library):
    rng = random.Random(5)
    alphabet = list("abcdeTHE's'll  \t\n\r\x1c\x85\xa0 .,!?0123456789İΣßéÉñ漢字☃😀▁") + [
        "<s>", "</s>", "<unk>", "<0x0A>", "the ", "tion", "\x00", "ﬁ", "    ", "==", "aaaa"]
    pieces = [library.id_to_piece(i).replace("▁", " ") for i in range(259, library.get_piece_size())]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(1000)]
    texts += ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 30))) for _ in range(3000)]
    texts += ["".join(rng.choice("aeinorst") for _ in range(rng.randint(60, 900))) for _ in range(60)]
    return texts + [c * n for c in (" ", "a", "=", "ab", "the") for n in (1, 2, 31, 63, 64, 65, 66, 129, 700)] + [
        " " * 30_000, "x" * 30_000, "ne" * 9000]


def test_merge_rounds_give_the_ids_of_the_library(library, monkeypatch):
    encoder, decoder = sentence_pieces.PieceEncoder(sentence_pieces.MODEL), sentence_pieces.PieceDecoder(sentence_pieces.MODEL)
    texts = piece_texts(library)
    monkeypatch.setattr(sentence_pieces, "CACHE_WORDS", 3000)
    for a in range(0, len(texts), 300):
        for text, ids in zip(texts[a:a + 300], encoder.encode(texts[a:a + 300])):
            ids = np.frombuffer(ids, np.int32)
            assert ids.tolist() == library.encode(text), repr(text[:200])
            assert decoder.decode(ids) == library.decode(ids.tolist()), repr(text[:200])
    # single merges and whole passes give the same
    for limit in (2, 10**9):
        monkeypatch.setattr(sentence_pieces, "LONG", limit)
        some = [t for t in texts if len(t) < 300]
        fresh = sentence_pieces.PieceEncoder(sentence_pieces.MODEL)
        assert fresh.encode(some) == encoder.encode(some)


def test_decoding_any_ids_like_the_library(library):
    rng, decoder = random.Random(6), sentence_pieces.PieceDecoder(sentence_pieces.MODEL)
    for _ in range(3000):
        ids = [rng.choice([rng.randrange(3), rng.randrange(3, 259), rng.randrange(259, 32000), library.piece_to_id("▁")])
               for _ in range(rng.randint(0, 8))]
        assert decoder.decode(np.array(ids, np.int32)) == library.decode(ids), ids


def test_pieces_of_odd_documents(spark, odd_docs, no_docs, library):
    made = sentence_pieces.decode_pieces(sentence_pieces.encode_pieces(odd_docs))
    assert made.columns == [*odd_docs.columns, "ids", "decoded"]
    for r in made.collect():
        assert r.ids == library.encode(r.text or "")
        assert r.decoded == library.decode(r.ids)
    assert sentence_pieces.encode_pieces(no_docs).collect() == []
    with pytest.raises(ValueError, match="Text"):
        sentence_pieces.encode_pieces(odd_docs, out="Text")
    ids = spark.createDataFrame([([],), (None,), ([None, 300, None],)], "ids array<int>")
    assert [r.decoded for r in sentence_pieces.decode_pieces(ids).collect()] == ["", "", library.decode([300])]


def test_other_kinds_of_models_are_refused(library, monkeypatch):
    class Bent:
        def __getattr__(self, name):
            return getattr(library, name)

        def encode(self, text):
            return library.encode(text.strip())

    monkeypatch.setattr(sentence_pieces, "load_processor", lambda name: Bent())
    with pytest.raises(ValueError, match="not a byte-pair model"):
        sentence_pieces.PieceEncoder("bent")
