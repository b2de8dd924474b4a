"""Operator 11: source divergence audit by Gustavson row accumulation.

Terms are counted per (language, source) group on the map side. A language
keeps the terms that are in enough of its documents. The kept counts form a
sparse matrix of groups by terms, and the distance of two groups is a sum over
all kept terms of |p - q|, with smoothed shares p and q.

Every pair of groups needs every term, but most counts are zero, and a zero
count has the same share b (the baseline) for all terms of a group. So the sum
is split: the terms of one group against the other's baseline come from sorted
prefix sums, and only terms that both groups have need correcting. For that
each group walks over its terms and scatters the correction of every peer in
the term's row of the term-major index into one dense accumulator of its
peers (Gustavson's order of a sparse product): no pair of postings is ever
emitted or shuffled. The matrix is dealt into cells of (block of groups, block
of peers, slice of terms), whose sums are added.

All arithmetic is in whole numbers: shares are floors of a fixed scale, found
in three steps of a thousand so that sums up to 9e15 words stay in a long.

Defined cases: null text, language and source count as ''; a group without
terms is a group whose counts are all zero; a language without kept terms has
distances of 0 and no term rows; repeated rows count as often as they occur;
equal values rank by the item's UTF-8 bytes; an empty table gives no rows;
only the three named columns are read, so further columns cannot clash.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import materialise, slices

#: ASCII letters in lower case and all bytes of other characters stay; anything else ends a term.
TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
#: (group, term) entries that a task holds before it hands them on.
HELD = 300_000
#: Groups of a block, matrix entries of a slice of terms.
BLOCK, SLICE = 256, 200_000
#: The scale of shares is 1000 to this power.
STEPS = 3

COUNTS = "lang string, source string, term string, n long, docs long"


def terms_of(text: bytes) -> list[bytes]:
    """The terms of a UTF-8 text, in order."""
    return text.translate(TERM_BYTES).split()


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial (group, term, occurrences, documents) rows; a row without a term names its group."""
    counts: dict = defaultdict(Counter)
    docs: dict = defaultdict(Counter)
    held = 0

    def flush() -> Iterator[pa.RecordBatch]:
        for (lang, source), own in counts.items():
            terms = [*own, None]
            k = len(terms)
            seen = docs[lang, source]
            yield pa.record_batch(
                [pa.array([lang] * k, pa.string()), pa.array([source] * k, pa.string()), pa.array(terms, pa.string()),
                 pa.array([*own.values(), 0], pa.int64()), pa.array([*[seen[t] for t in own], 0], pa.int64())],
                ["lang", "source", "term", "n", "docs"])

    for batch in batches:
        for part in slices(batch):
            for lang, source, text in zip(*(c.to_pylist() for c in part.columns)):
                words = terms_of(text)
                own = counts[lang, source]
                before = len(own)
                own.update(words)
                docs[lang, source].update(set(words))
                held += len(own) - before + (before == 0)
                if held >= HELD:
                    yield from flush()
                    counts.clear()
                    docs.clear()
                    held = 0
    yield from flush()


def term_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """(lang, source, term, n occurrences, docs with it), and a row with a null term for every group."""
    def text(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(""))

    slim = docs.select(text(lang_col).alias("lang"), text(source_col).alias("source"),
                       text(text_col).cast("binary").alias("text"))
    return (slim.mapInArrow(_count_terms, COUNTS).groupBy("lang", "source", "term")
            .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")))


def share(count: Column, total: Column, smooth: int) -> Column:
    """1 + floor(10^9 * (count + smooth) / total), exact; 0 where there is no total."""
    whole, rest = F.lit(0).cast("long"), count + F.lit(smooth)
    for _ in range(STEPS):
        whole = whole * 1000 + F.call_function("div", rest * 1000, total)
        rest = (rest * 1000) % total
    return F.when(total > 0, whole + 1).otherwise(F.lit(0).cast("long"))


def _distances(p: np.ndarray, baselines: np.ndarray) -> np.ndarray:
    """Sum of |p - b| over ``p``, for each baseline."""
    p = np.sort(p)
    before = np.concatenate([[0], np.cumsum(p)])
    below = np.searchsorted(p, baselines)
    return baselines * (2 * below - len(p)) + before[-1] - 2 * before[below]


def accumulate_cell(sources: np.ndarray, terms: np.ndarray, p: np.ndarray, base: np.ndarray, own: np.ndarray,
                    peers: np.ndarray, kept: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(group, its peers, distances) over the terms of one cell.

    ``sources``, ``terms`` and ``p`` are the cell's matrix entries, ``base`` and ``kept`` hold a baseline and a number
    of kept terms for every source, ``own`` and ``peers`` list the sources of the two sides.
    """
    n_sources, n_terms = len(base), int(terms.max()) + 1 if len(terms) else 0
    by_source = np.argsort(sources, kind="stable")
    starts = np.searchsorted(sources[by_source], np.arange(n_sources + 1))
    rows = [by_source[a:b] for a, b in zip(starts, starts[1:])]
    sizes = np.diff(starts)
    to_baseline = np.array([_distances(p[r], base) for r in rows])
    # the term-major index of the peers
    listed = np.flatnonzero(np.isin(sources, peers))
    listed = listed[np.argsort(terms[listed], kind="stable")]
    first = np.searchsorted(terms[listed], np.arange(n_terms + 1))
    peer, peer_p = sources[listed], p[listed]
    for g in own.tolist():
        t = terms[rows[g]]
        lengths = first[t + 1] - first[t]
        at = np.repeat(first[t] - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())
        h, q, mine = peer[at], peer_p[at], np.repeat(p[rows[g]], lengths)
        row = np.zeros(n_sources, np.int64)
        np.add.at(row, h, np.abs(mine - q) - np.abs(mine - base[h]) - np.abs(base[g] - q) + np.abs(base[g] - base[h]))
        row += to_baseline[g] + to_baseline[:, g] + (kept - sizes - sizes[g]) * np.abs(base - base[g])
        yield g, peers, row[peers]


def _cell_rows(key: tuple, cell: pa.Table) -> pa.Table:
    """(lang, a, b, value) of a cell's pairs of groups; each pair once, also where both blocks are the same.

    Sources are numbered by name: the rows of a cell come in any order, and every slice has to name a pair alike.
    """
    listed = cell["source"].combine_chunks()
    names = listed.unique().sort()
    code = pc.index_in(listed, names).to_numpy(zero_copy_only=False)
    block, p = cell["block"].to_numpy(), cell["p"].to_numpy()
    head = np.asarray(cell["term"].combine_chunks().is_null())
    term = cell["term"].combine_chunks().filter(pa.array(~head)).dictionary_encode().indices.to_numpy(zero_copy_only=False)
    base, kept, side = (np.zeros(len(names), np.int64) for _ in range(3))
    base[code[head]], kept[code[head]], side[code[head]] = p[head], cell["kept"].to_numpy()[head], block[head]
    lang, x, y = key[0].as_py(), key[1].as_py(), key[2].as_py()
    a, b, values = [], [], []
    for g, peers, row in accumulate_cell(code[~head].astype(np.int64), term.astype(np.int64), p[~head], base,
                                         np.flatnonzero(side == x), np.flatnonzero(side == y), kept):
        if x == y:
            peers, row = peers[peers > g], row[peers > g]
        a.append(np.full(len(peers), g))
        b.append(peers)
        values.append(row)
    a, b, values = (np.concatenate([*v, np.zeros(0, np.int64)]).astype(np.int64) for v in (a, b, values))
    return pa.table({"lang": pa.array([lang] * len(a), pa.string()), "a": names.take(pa.array(a)),
                     "b": names.take(pa.array(b)), "value": pa.array(values, pa.int64())})


def pair_distances(entries: DataFrame, groups: DataFrame, languages: DataFrame) -> DataFrame:
    """(lang, a, b, value) of each unordered pair of a language's sources.

    ``entries`` (lang, source, term, p), ``groups`` (lang, source, base), ``languages`` (lang, sources, kept, entries).
    """
    shape = languages.select(
        "lang", "kept", F.ceil(F.col("sources") / BLOCK).alias("blocks"),
        F.greatest(F.lit(1), F.ceil(F.col("entries") / SLICE)).alias("parts"))
    block = F.pmod(F.xxhash64("source"), F.col("blocks"))
    others = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    heads = (groups.join(shape, "lang").withColumn("block", block).withColumn("other", others)
             .withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
             .select("lang", "block", "other", "part", "source", F.lit(None).cast("string").alias("term"),
                     F.col("base").alias("p"),
                     # the first slice counts the kept terms that neither side has
                     F.when(F.col("part") == 0, F.col("kept")).otherwise(F.lit(0).cast("long")).alias("kept")))
    body = (entries.join(shape, "lang").withColumn("block", block).withColumn("other", others)
            .select("lang", "block", "other", F.pmod(F.xxhash64("term"), F.col("parts")).alias("part"), "source", "term",
                    "p", F.lit(0).cast("long").alias("kept")))
    cells = heads.unionByName(body).select(
        "lang", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"), "part", "block", "source",
        "term", "p", "kept")
    sums = cells.groupBy("lang", "x", "y", "part").applyInArrow(_cell_rows, "lang string, a string, b string, value long")
    return sums.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def audit_sources(docs: DataFrame, least_docs: int = 30, smooth: int = 5, top: int = 50, text_col: str = "text",
                  lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """(lang, source, part, item, value, rank).

    Part ``pair``: the distance of a source to every other source of its language, the farthest first. Part ``term``:
    the ``top`` terms whose share in the source exceeds that in its language the most.
    """
    counts = materialise(term_counts(docs, text_col, lang_col, source_col), "audit-counts")
    terms = counts.where("term IS NOT NULL")
    kept = (terms.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs"))
            .where(F.col("docs") >= least_docs).drop("docs"))
    entries = materialise(terms.drop("docs").join(kept, ["lang", "term"]), "audit-entries")

    in_lang = (entries.groupBy("lang", "term").agg(F.first("lang_n").alias("lang_n"), F.count("*").alias("entries"))
               .groupBy("lang").agg(F.count("*").alias("kept"), F.sum("lang_n").alias("lang_total"),
                                    F.sum("entries").alias("entries")))
    own_total = entries.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = materialise(
        counts.where("term IS NULL").select("lang", "source").join(own_total, ["lang", "source"], "left")
        .join(in_lang, "lang", "left").na.fill(0, ["total", "kept", "lang_total", "entries"])
        .withColumn("total", F.col("total") + smooth * F.col("kept"))
        .withColumn("lang_total", F.col("lang_total") + smooth * F.col("kept"))
        .withColumn("base", share(F.lit(0).cast("long"), F.col("total"), smooth)), "audit-groups")
    languages = groups.groupBy("lang").agg(F.count("*").alias("sources"), F.first("kept").alias("kept"),
                                           F.first("entries").alias("entries"))
    shares = (entries.join(groups.select("lang", "source", "total", "lang_total"), ["lang", "source"])
              .withColumn("p", share(F.col("n"), F.col("total"), smooth)))

    pairs = pair_distances(shares.select("lang", "source", "term", "p"), groups.select("lang", "source", "base"), languages)
    both = pairs.select("lang", "value", F.explode(F.array(
        F.struct(F.col("a").alias("source"), F.col("b").alias("item")),
        F.struct(F.col("b").alias("source"), F.col("a").alias("item")))).alias("pair"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    far = both.select("lang", "pair.source", F.lit("pair").alias("part"), "pair.item", "value").withColumn(
        "rank", F.row_number().over(order))
    over = (shares.withColumn("value", F.col("p") - share(F.col("lang_n"), F.col("lang_total"), smooth))
            .where((F.col("value") > 0) & (F.col("n") > 0))
            .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value")
            .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top))
    return far.unionByName(over)
