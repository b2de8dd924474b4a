"""Operators 6, 7 and 8 against brute force."""

import collections
import hashlib
import random
import re

import numpy as np
from pyspark.sql import functions as F

from tessera.llm import decontaminate, grid_join, jaccard_join
from tessera.llm.components import components, local_labels

ITEM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SHINGLE_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def union_find(nodes, links):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def brute_windows(texts, items, size):
    patterns = collections.defaultdict(set)
    for item, text in items:
        words = ITEM_WORD.findall(lower(text))
        for at in range(max(1, len(words) - size + 1) if words else 0):
            patterns[tuple(words[at:at + size])].add(item)
    out = []
    for text in texts:
        words, hit, found = ITEM_WORD.findall(lower(text)), set(), set()
        for n in {len(p) for p in patterns}:
            for at in range(len(words) - n + 1):
                owners = patterns.get(tuple(words[at:at + n]))
                if owners:
                    hit.update(range(at, at + n))
                    found |= owners
        out.append((len(words), sorted(hit), found))
    return out


def test_wu_manber_against_brute_force():
    rng = random.Random(3)
    some = ["a", "b", "A", "é", "1", "ab"]
    texts = [" ".join(rng.choice(some) + rng.choice(["", "", "!", "\n"]) for _ in range(rng.randint(0, 60))) for _ in range(300)]
    texts += [None, "", "  ", "a"]
    for size, count, most in ((10, 30, 14), (3, 400, 12), (1, 5, 3)):
        items = [(str(i), " ".join(rng.choice(some) for _ in range(rng.randint(0, most)))) for i in range(count)] + [("n", None)]
        searches = decontaminate.build_searches(items, size)
        assert decontaminate.search_texts(texts, searches) == brute_windows(texts, items, size)


def test_contamination_in_blocks(spark, documents, odd_docs, no_docs):
    benchmark = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").select("item_id", "text")
    items = [(str(r.item_id), r.text) for r in benchmark.collect()]
    passage = items[0][1]
    more = spark.createDataFrame([(10_000, f"x {passage.upper()} y"), (10_001, " ".join(passage.split()[:9]))], "doc_id long, text string")
    docs = documents.select("doc_id", "text").unionByName(more).unionByName(odd_docs.select("doc_id", "text"))
    rows = docs.collect()
    expected = collections.Counter(
        (r.doc_id, n, len(h), len(i), hashlib.sha256(",".join(sorted(i)).encode()).hexdigest(), bool(h))
        for r, (n, h, i) in zip(rows, brute_windows([r.text for r in rows], items, 10)))
    assert collections.Counter(tuple(r) for r in decontaminate.contamination(docs, benchmark).collect()) == expected
    marked = decontaminate.mark_contaminated(odd_docs.unionByName(odd_docs), benchmark, block_bytes=3000)
    assert marked.columns == [*odd_docs.columns, "decon_words", "decon_hits", "decon_items"]
    blocks = decontaminate.mark_contaminated(docs, benchmark, block_bytes=3000).collect()
    assert sum(len(r.decon_hits) for r in blocks) == sum(k[2] * v for k, v in expected.items())
    assert decontaminate.contamination(no_docs, benchmark).collect() == []
    clean = decontaminate.contamination(odd_docs, benchmark.limit(0)).collect()
    assert len(clean) == odd_docs.count() and not any(r.contaminated for r in clean)


def test_components(spark):
    rng = random.Random(6)
    pairs = [(rng.randrange(3000), rng.randrange(3000)) for _ in range(1800)] + [(5, i) for i in range(4000, 4400)]
    pairs += [(i, i + 1) for i in range(5000, 5600)]
    expected = union_find({x for p in pairs for x in p}, pairs)
    from tessera.llm import components as module

    edges = spark.createDataFrame(pairs, "a long, b long")
    for chunk in (1_000_000, 300):
        module.CHUNK_EDGES, held = chunk, module.CHUNK_EDGES
        try:
            got = {r.node: r.component for r in components(edges).collect()}
        finally:
            module.CHUNK_EDGES = held
        assert all(got[n] == c for n, c in expected.items() if n in got)
        assert {n for n, c in expected.items() if sum(1 for a, b in pairs if a != b and n in (a, b))} == set(got)
    assert components(edges.limit(0)).collect() == []


def brute_jaccard(rows, size=5, percent=75):
    sets = {}
    for doc, text in rows:
        words = SHINGLE_WORD.findall(lower(text))
        sets.setdefault(doc, []).append(frozenset(tuple(words[i:i + size]) for i in range(max(1, len(words) - size + 1))) if words else frozenset())
    owners = collections.defaultdict(list)
    flat = [(d, s) for d, own in sets.items() for s in own]
    for n, (_, s) in enumerate(flat):
        for x in s:
            owners[x].append(n)
    links = []
    for n, (d, s) in enumerate(flat):
        for m, both in collections.Counter(m for x in s for m in owners[x] if m < n).items():
            if 100 * both >= percent * (len(s) + len(flat[m][1]) - both):
                links.append((d, flat[m][0]))
    return union_find(sets, links), sets


def mutated(rng, words, times):
    words = list(words)
    for _ in range(times):
        at, kind = rng.randrange(len(words)), rng.random()
        if kind < 0.4:
            words[at] = f"m{rng.randrange(10 ** 6)}"
        elif kind < 0.7:
            words.insert(at, f"z{rng.randrange(10 ** 6)}")
        elif len(words) > 1:
            del words[at]
    return words


def test_jaccard_join_against_brute_force(spark):
    rng = random.Random(7)
    rows, passage = [], [f"p{i}" for i in range(60)]
    for _ in range(45):
        base = [f"w{rng.randrange(5000)}" for _ in range(rng.choice([3, 5, 6, 8, 12, 20, 40, 80, 150, 300]))]
        if rng.random() < 0.5:
            base = base[:len(base) // 2] + passage + base[len(base) // 2:]
        for _ in range(rng.choice([1, 2, 3, 8, 25])):
            rows.append(mutated(rng, base, rng.choice([0, 0, 1, 2, 3, len(base) // 30, len(base) // 15])))
    rows = [(i, " ".join(w) if rng.random() < 0.9 else "\n".join(w).upper()) for i, w in enumerate(rows)]
    rows += [(100_000, None), (100_001, ""), (100_002, "  \n"), (100_003, "a"), (100_004, "A"), (3, rows[40][1])]
    expected, sets = brute_jaccard(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    for hashes in (jaccard_join.BLOCK_HASHES, 3000):  # the second splits blocks into sub-blocks
        got = jaccard_join.jaccard_components(docs, block_hashes=hashes).collect()
        assert {r.doc_id: r.component_id for r in got} == expected
        assert collections.Counter((r.doc_id, r.n_shingles) for r in got) == collections.Counter(
            (d, len(s)) for d, own in sets.items() for s in own)


def test_jaccard_join_of_odd_documents(odd_docs, no_docs):
    got = jaccard_join.jaccard_components(odd_docs).collect()
    assert len(got) == odd_docs.count()
    named = [(r.doc_id, r.text) for r in odd_docs.collect() if r.doc_id is not None]
    expected, _ = brute_jaccard(named)
    assert {r.doc_id: r.component_id for r in got if r.doc_id is not None} == expected
    assert [(r.n_shingles, r.component_id) for r in got if r.doc_id is None] == [(2, None)]
    kept = jaccard_join.keep_one_of_each(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(r.doc_id for r in kept.where("doc_id is not null").collect()) == sorted(set(expected.values()))
    assert jaccard_join.jaccard_components(no_docs).collect() == []


def test_join_keeps_each_text_of_an_id(spark):
    texts = {k: " ".join(f"{k}{i}" for i in range(40)) for k in "abcd"}
    rows = [(1, texts["a"]), (1, texts["b"]), (2, texts["a"] + " more"), (3, texts["b"]), (4, texts["c"]), (4, texts["c"]), (None, texts["c"]),
            (None, texts["d"]), (None, texts["d"]), (5, None), (5, ""), (5, ""), (None, " \n"), (None, " \n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    kept = collections.Counter((r.doc_id, r.text) for r in jaccard_join.keep_one_of_each(docs).collect())
    assert kept == collections.Counter([(1, texts["a"]), (1, texts["b"]), (4, texts["c"]), (None, texts["d"]), (5, None), (5, ""), *rows[-2:]])


def brute_vectors(rows, cosine=0.9):
    good = [v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v) for _, v in rows]
    units = [np.array(v, float) / np.linalg.norm(np.array(v, float) / np.abs(v).max()) / np.abs(v).max() if g else None for (_, v), g in zip(rows, good)]
    links, pairs = [0] * len(rows), []
    for i in range(len(rows)):
        for j in range(i):
            if good[i] and good[j] and len(units[i]) == len(units[j]) and units[i] @ units[j] >= cosine:
                links[i] += 1
                links[j] += 1
                pairs.append((rows[i][0], rows[j][0]))
    roots = union_find([r[0] for r in rows], pairs)
    return {r[0]: (n, roots[r[0]], roots[r[0]] == r[0]) for r, n in zip(rows, links)}


def test_grid_join_against_brute_force(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(5, 8))
    rows = [(i, (centres[i % 5] + rng.normal(size=8) * 0.25).tolist()) for i in range(300)]
    rows += [(1000 + i, rows[0][1]) for i in range(40)]
    rows += [(2000, None), (2001, []), (2002, [0.0] * 8), (2003, [None] + [1.0] * 7), (2004, [float("nan")] * 8), (2005, [1.0, 2.0]),
             (2006, [2.0, 4.0]), (2007, (np.array(rows[0][1]) * 3).tolist()), (2008, [float("inf")] * 8), (2009, [1e-30] * 8), (2010, [1e30] * 8)]
    exact = [(i, v and [x if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    expected = brute_vectors(exact)
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    for block in (grid_join.BLOCK, 16):
        got = grid_join.near_duplicates(vectors.selectExpr("*", "'x' node", "1 links"), block=block).collect()
        assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got} == expected
    assert grid_join.near_duplicates(vectors.limit(0)).collect() == []


def test_grid_join_of_repeated_ids(spark):
    rows = [(1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 1.0]), (1, [0.0, 1.0]), (3, [1.0, 0.01]), (None, [0.0, 2.0])]
    got = grid_join.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
    assert len(got) == len(rows)
    assert all(r.component_id == 1 for r in got)


def test_block_pairs_return_few_edges():
    """Near copies are joined by at most two edges a vector, and the components stay those of all links."""
    rng = np.random.default_rng(3)
    for shape in ((500, 500), (700, 40), (1, 300)):
        base = rng.normal(size=(6, 64))
        sides = []
        for n in shape:
            v = base[rng.integers(0, 6, n)] + rng.normal(size=(n, 64)) * 0.05
            sides.append(v / np.linalg.norm(v, axis=1, keepdims=True))
        a, b = sides
        ids_a, ids_b = np.arange(len(a)), np.arange(len(a), len(a) + len(b))
        ones = [np.ones(len(x), np.int64) for x in sides]
        near = a @ b.T >= 0.9
        la, lb, left, right = grid_join.compare(ids_a, a, ones[0], ids_b, b, ones[1], 0.9, False)
        assert (la == near.sum(1)).all() and (lb == near.sum(0)).all()
        assert len(left) <= 2 * (len(a) + len(b)) and near[left, right - len(a)].all()
        want, got = (dict(zip(*(x.tolist() for x in local_labels(*e)))) for e in (
            tuple(x + [0, len(a)][i] for i, x in enumerate(np.nonzero(near))), (left, right)))
        assert want == got
        own = a @ a.T >= 0.9
        la, _, left, right = grid_join.compare(ids_a, a, ones[0], ids_a, a, ones[0], 0.9, True)
        assert (la == own.sum(1) - 1).all() and len(left) <= 2 * len(a)


def test_a_task_holds_one_list_partition(spark):
    rng, parts = np.random.default_rng(8), 40
    rows = [(i, 30, jaccard_join.pack48(rng.integers(0, 2 ** 64, 30, np.uint64))) for i in range(500)]
    indexed = spark.createDataFrame([(i, n, bytearray(p)) for i, n, p in rows], "rep long, n long, prefix binary").repartition(3)
    dealt = jaccard_join.list_partitions(indexed, parts)
    tasks = dealt.groupBy(F.spark_partition_id().alias("task")).agg(F.collect_set("part").alias("own")).collect()
    assert len(tasks) == parts and all(len(t.own) == 1 for t in tasks)
    held = [jaccard_join.from_planes(bytes(r.hashes), "<i8") for r in dealt.collect()]
    wanted = np.concatenate([jaccard_join.unpack48(p) for _, _, p in rows])
    assert (np.sort(np.concatenate(held)) == np.sort(wanted)).all()


def test_rows_of_the_lists_grow_with_the_input(spark):
    """A group of k similar sets gives at most k rows a hash: five times the group, five times the rows."""
    words = " ".join(f"w{i}" for i in range(120))
    made = []
    for copies in (20, 100):
        docs = spark.createDataFrame([(i, f"{words} end{i}") for i in range(copies)], "doc_id long, text string")
        indexed = jaccard_join.signatures(docs, 5, 75).withColumnRenamed("doc_id", "rep")
        made.append(jaccard_join.list_partitions(indexed, 8).mapInArrow(
            jaccard_join._lists, "hash long, rep long, n long, df long").count())
    assert 0 < made[0] and abs(made[1] - 5 * made[0]) <= made[0] // 2
