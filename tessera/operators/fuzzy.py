"""Best close match (Ratcliff/Obershelp ratio >= cutoff) without a cross join.

Exact candidate generation by prefix filtering (a set-similarity join):
the ratio 2M/(|a|+|b|) is bounded by the multiset character overlap, so a
ratio >= c needs overlap >= c*L/(2-c) for a string of length L whatever its
partner. Ordering character tokens (char, occurrence) rarest-first, any two
strings with that overlap share a token within their first
``L - ceil(c*L/(2-c)) + 1`` tokens. Candidates are the pairs sharing such a
prefix token (equi join on the token) whose multiset overlap allows the cutoff;
only they are scored, by an Arrow-batched pandas UDF. No pair is dropped that
could reach the cutoff.

The ratio is computed for many pairs at once: every pair's open spans are
compared in one array of run lengths, the first longest common block of each
is taken out, and what lies left and right of it is compared in the next
round, until no span has a common character.
"""

from __future__ import annotations

import math
from difflib import SequenceMatcher

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


#: Cells of the arrays of one round, which bounds a task's memory.
CELLS = 4_000_000
#: From this length of the second text on, difflib leaves its frequent characters out of the search.
POPULAR_FROM = 200


def _codes(texts: list[str], width: int, pad: int) -> np.ndarray:
    """Code points of the texts, a row each, filled up with ``pad``."""
    out = np.full((len(texts), width), pad, np.int64)
    flat = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    sizes = np.array([len(t) for t in texts])
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def matched(a: list[str], b: list[str]) -> np.ndarray:
    """Characters in the common blocks of each pair (Ratcliff/Obershelp)."""
    wide, high = max(map(len, a), default=0), max(map(len, b), default=0)
    total = np.zeros(len(a), np.int64)
    if not wide or not high:
        return total
    x, y = _codes(a, wide, -1), _codes(b, high, -2)
    # open spans: the pair, and where they begin and end in both texts
    spans = np.array([(i, 0, len(s), 0, len(t)) for i, (s, t) in enumerate(zip(a, b))], np.int64)
    column, step = np.arange(high), max(1, CELLS // (wide * high))
    while len(spans):
        left = []
        for at in range(0, len(spans), step):
            pair, x0, x1, y0, y1 = spans[at:at + step].T
            open_y = (column >= y0[:, None]) & (column < y1[:, None])
            run = np.zeros((len(pair), high), np.int64)
            size, end_x, end_y = (np.zeros(len(pair), np.int64) for _ in range(3))
            for i in range(int(x0.min()), int(x1.max())):
                same = (x[pair, i][:, None] == y[pair]) & open_y & ((i >= x0) & (i < x1))[:, None]
                run = np.where(same, np.pad(run[:, :-1], ((0, 0), (1, 0))) + 1, 0)
                best = run.argmax(1)
                longest = run[np.arange(len(pair)), best]
                better = longest > size  # so the first in x, then in y, of the longest
                size, end_x, end_y = np.where(better, longest, size), np.where(better, i + 1, end_x), np.where(better, best + 1, end_y)
            np.add.at(total, pair, size)
            found = size > 0
            pair, x0, x1, y0, y1, size, end_x, end_y = (c[found] for c in (pair, x0, x1, y0, y1, size, end_x, end_y))
            left += [np.stack([pair, x0, end_x - size, y0, end_y - size], 1), np.stack([pair, end_x, x1, end_y, y1], 1)]
        spans = np.concatenate(left)
        spans = spans[(spans[:, 1] < spans[:, 2]) & (spans[:, 3] < spans[:, 4])]
    return total


def ratios(a: list[str], b: list[str]) -> np.ndarray:
    """``difflib.SequenceMatcher(None, a, b).ratio()`` of each pair, pairs of like length together."""
    out = np.ones(len(a))
    order = sorted(range(len(a)), key=lambda i: (len(a[i]), len(b[i])))
    short = [i for i in order if len(b[i]) < POPULAR_FROM]
    for at in range(0, len(short), 1024):
        own = short[at:at + 1024]
        m = matched([a[i] for i in own], [b[i] for i in own])
        lengths = np.array([len(a[i]) + len(b[i]) for i in own])
        out[own] = np.where(lengths > 0, 2.0 * m / np.maximum(lengths, 1), 1.0)
    for i in order:
        if len(b[i]) >= POPULAR_FROM:
            out[i] = SequenceMatcher(None, a[i], b[i]).ratio()
    return out


@F.pandas_udf(DoubleType())
def sequence_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series(ratios(a.tolist(), b.tolist()), dtype="float64")


def _tokens(df: DataFrame, sid: str, text: str) -> DataFrame:
    """(sid, token) where token = char + '#' + occurrence number."""
    ch = df.select(sid, F.posexplode(F.split(F.col(text), "")).alias("pos", "ch")).where(F.col("ch") != "")
    occ = F.row_number().over(Window.partitionBy(sid, "ch").orderBy("pos"))
    return ch.select(sid, F.concat(F.col("ch"), F.lit("#"), occ.cast("string")).alias("tok"))


def _prefix(tokens: DataFrame, lengths: DataFrame, freq: DataFrame, sid: str, cutoff: float) -> DataFrame:
    t = tokens.join(freq, "tok", "left").withColumn("f", F.coalesce("f", F.lit(0)))
    t = t.join(lengths, sid)
    need = F.ceil(F.col("len") * F.lit(cutoff / (2 - cutoff)) - F.lit(1e-9))
    plen = F.col("len") - F.greatest(need, F.lit(1)) + 1
    rn = F.row_number().over(Window.partitionBy(sid).orderBy("f", "tok"))
    return t.withColumn("_rn", rn).where(F.col("_rn") <= plen).select(sid, "tok")


def best_close_match(queries: DataFrame, qcol: str, words: DataFrame, wcol: str,
                     cutoff: float = 0.6) -> DataFrame:
    """For each query (compared lower-cased), the dictionary word with the
    highest ratio >= cutoff; ties go to the larger word. Columns: query,
    match, score. Queries with no match are absent."""
    # strings are their own ids (no hash collisions can merge two of them)
    q = queries.select(F.col(qcol).alias("query")).distinct() \
               .withColumn("qs", F.lower("query")).withColumn("qid", F.col("query"))
    w = words.select(F.col(wcol).alias("word")).distinct().withColumn("wid", F.col("word"))
    q_len = q.select("qid", F.length("qs").alias("len"))
    w_len = w.select("wid", F.length("word").alias("len"))
    w_tok = _tokens(w, "wid", "word")
    freq = w_tok.groupBy("tok").agg(F.count(F.lit(1)).alias("f"))
    q_tok = _tokens(q, "qid", "qs")
    qp = _prefix(q_tok, q_len, freq, "qid", cutoff)
    wp = _prefix(w_tok, w_len, freq, "wid", cutoff)
    cand = qp.join(wp, "tok").select("qid", "wid").distinct()
    # the ratio is at most 2 * shared tokens / total length: checked before any string is scored
    q_all = q_tok.groupBy("qid").agg(F.collect_list("tok").alias("tq"))
    w_all = w_tok.groupBy("wid").agg(F.collect_list("tok").alias("tw"))
    shared = F.size(F.array_intersect("tq", "tw"))
    cand = cand.join(q_all, "qid").join(w_all, "wid").where(
        2 * shared >= F.lit(cutoff) * (F.size("tq") + F.size("tw")) - F.lit(1e-9)).select("qid", "wid")
    scored = cand.join(q, "qid").join(w, "wid").withColumn("score", sequence_ratio(F.col("word"), F.col("qs")))
    hits = scored.where(F.col("score") >= cutoff)
    best = hits.groupBy("query").agg(F.max(F.struct("score", "word")).alias("b"))
    return best.select("query", F.col("b.word").alias("match"), F.col("b.score").alias("score"))


def required_overlap(length: int, cutoff: float) -> int:
    """Smallest multiset overlap any partner must share (for tests/docs)."""
    return max(1, math.ceil(length * cutoff / (2 - cutoff) - 1e-9))
