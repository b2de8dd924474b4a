"""Operator 9: quality classifier with hierarchical empirical Bayes priors.

Evidence of a document: a logistic regression over statistics of its whole
text (shape of its characters, repetition, words that a lexicon of
log-odds marks). It is learned from at most ``SAMPLE_DOCS`` labelled
documents: a lexicon of half of them gives the regression over the other half
its statistics, and the lexicon of all of them is used from then on. A document is
good when its quality label is 1 and its toxic label is 0.

Priors: the expected number of good documents is summed by path and by host
over all documents. The spread between hosts (and between paths of a host)
beyond chance gives the weight of the prior by the method of moments; a
host's rate is shrunk toward the global rate with that weight, and a path's
toward its host's, so sparse sites fall back on what is above them. A
document's posterior is its evidence (as a likelihood ratio against the rate
it was learned at) combined with its path's rate.

Defined cases: null and empty texts have the statistics of an empty text and
are scored like any other; a null host or path is a site of its own; a
document whose labels are null is not learned from; without labels of both
kinds everything is kept with the prior 0.5; rows are scored one by one,
repeated rows included; an empty table gives no rows; ``judge`` adds one
struct column of the caller's name and passes all others through.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import ArrowUDFType

from .common import SLICE_ROWS, materialise, per_worker, slices

#: Labelled documents learned from at most; a kind of label gives half of them at most.
SAMPLE_DOCS = 6000
#: A lexicon word is in so many bad documents of the sample at least, and has at least these log-odds; most entries.
LEAST_DOCS, LEAST_ODDS, LEXICON_WORDS = 4, 2.5, 4000
#: Posterior under which a document is rejected.
KEEP = 0.5
STEPS, RATE, DECAY = 600, 0.5, 1e-4
#: Evidence beyond these probabilities counts as them.
SURE = 1e-4
WORD = re.compile(r"[^\W\d_]+")
CACHE_RUNS = 200_000


def letters_of(run: str) -> str:
    return run.lower() if run.isalpha() else "".join(WORD.findall(run.lower()))


def entries(word: str) -> list[str]:
    """Lexicon entries of a word: itself and its longer beginnings, since marked stems take many endings."""
    return [word] + [word[:n] + "*" for n in range(5, min(9, len(word)))]


#: What is added up over the runs of a text: letters, capitals, digits, marks, marks at the end, runs without letters.
SUMS = 6


def run_sums(run: str) -> tuple:
    if run.isalpha():
        return len(run), 0 if run.islower() else sum(map(str.isupper, run)), 0, 0, 0, False
    letters = sum(map(str.isalpha, run))
    capitals = sum(map(str.isupper, run))
    digits = sum(map(str.isdigit, run))
    tail = len(run) - len(run.rstrip("!?*#%&$@~^+=|<>\\/_-"))
    return letters, capitals, digits, len(run) - letters - digits, tail, not letters


class Statistics:
    """Statistics of a whole text, given the lexicon (word -> log-odds)."""

    names = ("words", "capitals", "digits", "marks", "tails", "bare", "length", "repeats", "distinct",
             "worst word", "marked words", "empty")

    def __init__(self, lexicon: dict[str, float]):
        self.lexicon = lexicon
        self.rows = np.zeros((CACHE_RUNS, SUMS + 1))
        self.place: dict[str, int] = {}

    def _row(self, run: str) -> int:
        at = self.place[run] = len(self.place)
        self.rows[at] = (*run_sums(run), max(self.lexicon.get(e, 0.0) for e in entries(letters_of(run))))
        return at

    def __call__(self, text: str | None) -> list[float]:
        runs = (text or "").split()
        if not runs:
            return [0.0] * (len(self.names) - 1) + [1.0]
        sums, worst, marked, repeats, at = np.zeros(SUMS), 0.0, 0, 0, 0
        while at < len(runs):  # in parts that fit the room
            part = runs[at:at + CACHE_RUNS // 4]
            at += len(part)
            if len(self.place) + len(part) > CACHE_RUNS:
                self.place.clear()
            get, new = self.place.get, self._row
            places = np.array([p if (p := get(r)) is not None else new(r) for r in part])
            rows = self.rows[places]
            sums += rows[:, :SUMS].sum(0)
            worst, marked = max(worst, float(rows[:, SUMS].max())), marked + int((rows[:, SUMS] > 0).sum())
            repeats += int((places[1:] == places[:-1]).sum())
        n, (letters, capitals, digits, marks, tails, bare) = len(runs), sums
        signs = max(1.0, letters + digits + marks)
        return [math.log(n), capitals / max(1.0, letters), digits / signs, marks / signs, tails / n, bare / n,
                signs / n, repeats / n, len(set(runs)) / n ** 0.9, worst, math.log1p(marked), 0.0]


def expand(x: np.ndarray, centre: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Standardised statistics, their squares, and how far each lies beyond one and two deviations."""
    z = np.clip((x - centre) / scale, -8, 8)
    return np.concatenate([np.ones((len(z), 1)), z, z * z / 4, np.maximum(z - 1, 0), np.maximum(z - 2, 0)], 1)


@dataclass
class Model:
    lexicon: dict[str, float]
    centre: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    base: float  # share of good documents it was learned at


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(entry, good) once for each distinct lexicon entry of a text."""
    for batch in batches:
        for part in slices(batch, 64):
            out: list[list] = [[], []]
            for text, good in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                own = {e for w in {letters_of(r) for r in set((text or "").split())} - {""} for e in entries(w)}
                out[0] += own
                out[1] += [good] * len(own)
            yield pa.record_batch([pa.array(out[0], pa.string()), pa.array(out[1], pa.bool_())], ["word", "good"])


def fit_lexicon(sample: DataFrame) -> dict[str, float]:
    """Log-odds of the words that mark bad documents, from (text, good)."""
    good, bad = sample.agg(F.count(F.when(F.col("good"), 1)), F.count(F.when(~F.col("good"), 1))).first()
    words = sample.mapInArrow(_words, "word string, good boolean").groupBy("word").agg(
        F.count(F.when(F.col("good"), 1)).alias("g"), F.count(F.when(~F.col("good"), 1)).alias("b"))
    odds = F.log((F.col("b") + 0.5) / F.lit(bad + 1.0)) - F.log((F.col("g") + 0.5) / F.lit(good + 1.0))
    marked = (words.where(F.col("b") >= LEAST_DOCS).select("word", odds.alias("odds")).where(F.col("odds") >= LEAST_ODDS)
              .orderBy(F.desc("odds"), "word").limit(LEXICON_WORDS))
    return {r["word"]: r["odds"] for r in marked.collect()}


def train(x: np.ndarray, good: np.ndarray, lexicon: dict[str, float]) -> Model:
    """Logistic regression by full-gradient steps."""
    centre, scale = x.mean(0), np.maximum(x.std(0), 1e-3)
    z, w = expand(x, centre, scale), None
    w = np.zeros(z.shape[1])
    moment = np.zeros_like(w)
    for _ in range(STEPS):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        moment = 0.9 * moment + z.T @ (p - good) / len(z) + DECAY * w
        w -= RATE * moment / 10
    return Model(lexicon, centre, scale, w, float(np.clip(good.mean(), 0.01, 0.99)))


def fit(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS) -> Model | None:
    """``docs`` (doc_id, text) and ``labels`` (doc_id, quality, toxic); conflicting labels of a document count as bad."""
    known = (labels.where("doc_id is not null and quality is not null and toxic is not null")
             .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
             .agg(((F.min("quality") == 1) & (F.max("toxic") == 0)).alias("good")))
    # labels of other documents take no place of the sample
    present = docs.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id is not null").distinct()
    known = materialise(known.join(present, "doc_id", "left_semi"), "known-labels")
    order = F.xxhash64("doc_id", F.lit("quality"))
    chosen = None
    for good in (True, False):
        own = known.where(F.col("good") == good).orderBy(order, "doc_id").limit(sample_docs // 2)
        chosen = own if chosen is None else chosen.unionByName(own)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # at most sample_docs rows of ids
    sample = materialise(texts.join(F.broadcast(chosen), "doc_id").limit(2 * sample_docs), "quality-sample")
    half = F.pmod(F.xxhash64("doc_id", F.lit("half")), F.lit(2))
    lexicon = fit_lexicon(sample.where(half == 0).select("text", "good"))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        statistics = Statistics(lexicon)
        for batch in batches:
            for part in slices(batch, 64):
                rows = [statistics(t) for t in part.column(1).to_pylist()]
                yield pa.record_batch([part.column(0), part.column(2), pa.array(rows, pa.list_(pa.float64()))],
                                      ["doc_id", "good", "x"])

    rows = sample.where(half == 1).select("doc_id", "text", "good").mapInArrow(measure, "doc_id long, good boolean, x array<double>")
    rows = sorted(rows.collect())
    good = np.array([r["good"] for r in rows], float)
    if not len(rows) or good.min() == good.max():
        return None
    return train(np.array([r["x"] for r in rows]), good, fit_lexicon(sample.select("text", "good")))


def evidence(docs: DataFrame, model: Model, out: str, text_col: str = "text") -> DataFrame:
    """``docs`` plus ``out``: the classifier's probability of a good document."""
    values = (model.lexicon, model.centre, model.scale, model.weights, model.base)
    key = zlib.crc32(model.weights.tobytes() + repr(sorted(model.lexicon.items())).encode())
    held = docs.sparkSession.sparkContext.broadcast(values)  # LEXICON_WORDS words and a few numbers

    def run(texts):
        statistics, m = per_worker(("quality", key), lambda: (Statistics(held.value[0]), Model(*held.value)))
        # a slice of the texts as Python strings at a time
        rows = [statistics(t) for at in range(0, len(texts), SLICE_ROWS) for t in texts.slice(at, SLICE_ROWS).to_pylist()]
        x = np.array(rows).reshape(-1, len(m.centre))
        p = 1 / (1 + np.exp(-np.clip(expand(x, m.centre, m.scale) @ m.weights, -30, 30)))
        return pa.array(np.clip(p, SURE, 1 - SURE))

    # deterministic, a filter that follows would be pushed below it in part and score each text a second time, in a second
    # Python worker of the same task
    score = F.arrow_udf(run, "double", ArrowUDFType.SCALAR).asNondeterministic()
    return docs.withColumn(out, score(F.col(text_col).cast("string")))


def site_priors(scored: DataFrame) -> DataFrame:
    """(host, path, host_prior, path_prior) from (host, path, p) of all documents.

    Probabilities are summed as whole millionths, so the sums do not depend on
    their order. A map-side sum precedes every shuffle, whatever the host.
    """
    paths = scored.groupBy("host", "path").agg(F.sum(F.round(F.col("p") * 1_000_000).cast("long")).alias("good"),
                                               F.count(F.lit(1)).alias("n"))
    paths = materialise(paths.withColumn("good", F.col("good") / 1_000_000), "paths")
    hosts = materialise(paths.groupBy("host").agg(F.sum("good").alias("h_good"), F.sum("n").alias("h_n")), "hosts")

    def weight(groups: DataFrame, good: str, n: str, rate: Column) -> float:
        """Prior weight s of a beta-binomial: the spread of the groups' rates beyond chance, by moments."""
        r = F.col(good) / F.col(n)
        between, chance, size, groups_n = groups.agg(
            F.sum(F.col(n) * (r - rate) ** 2), F.sum(rate * (1 - rate)), F.sum(n), F.count(F.lit(1))).first()
        if not size or not chance or groups_n < 2:
            return 100.0
        spread = max(0.0, (between - chance) / size)
        mean = chance / groups_n
        return float(np.clip(mean / spread - 1 if spread > 0 else 1e6, 1.0, 1e6))

    total = hosts.agg(F.sum("h_good"), F.sum("h_n")).first()
    overall = float(np.clip((total[0] or 0.5) / (total[1] or 1), SURE, 1 - SURE))
    s_host = weight(hosts, "h_good", "h_n", F.lit(overall))
    hosts = hosts.withColumn("host_prior", (F.col("h_good") + s_host * overall) / (F.col("h_n") + s_host))
    hosts = materialise(hosts.select("host", "host_prior"), "host-priors")
    joined = materialise(paths.join(hosts, paths["host"].eqNullSafe(hosts["host"])).drop(hosts["host"]), "path-rates")
    s_path = weight(joined, "good", "n", F.col("host_prior"))
    return joined.select("host", "path", "host_prior",
                         ((F.col("good") + s_path * F.col("host_prior")) / (F.col("n") + s_path)).alias("path_prior"))


def judge(docs: DataFrame, labels: DataFrame, host_col: str = "source", path_col: str = "lang", text_col: str = "text",
          out: str = "judged") -> DataFrame:
    """``docs`` plus a struct ``out``: evidence, host_prior, path_prior, score (posterior), kept."""
    model = fit(docs.select("doc_id", F.col(text_col).alias("text")), labels)
    fields = ("evidence", "host_prior", "path_prior", "score")
    if model is None:
        return docs.withColumn(out, F.struct(*[F.lit(0.5).alias(f) for f in fields], F.lit(True).alias("kept")))
    host, path = F.col(host_col).cast("string"), F.col(path_col).cast("string")
    slim = docs.select(F.struct(host.alias("host"), path.alias("path")).alias("s"), F.col(text_col).alias("text"))
    priors = materialise(site_priors(evidence(slim, model, "p").select("s.host", "s.path", "p")), "priors")
    # the priors are read from a table, so the planner broadcasts them only if their bytes allow it
    priors = priors.select(F.struct(*[F.col(c) for c in priors.columns]).alias("__site"))
    scored = evidence(docs, model, "__p", text_col)
    logit = lambda c: F.log(c / (1 - c))
    rate = F.greatest(F.lit(SURE), F.least(F.lit(1 - SURE), F.col("__site.path_prior")))
    score = 1 / (1 + F.exp(-(logit(F.col("__p")) - math.log(model.base / (1 - model.base)) + logit(rate))))
    found = scored.join(priors, host.eqNullSafe(F.col("__site.host")) & path.eqNullSafe(F.col("__site.path")), "left")
    return found.withColumn(out, F.struct(
        F.col("__p").alias("evidence"), F.col("__site.host_prior").alias("host_prior"),
        F.col("__site.path_prior").alias("path_prior"), score.alias("score"), (score >= KEEP).alias("kept"),
    )).drop("__p", "__site")


def judge_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, evidence, host_prior, path_prior, score, kept of every row."""
    judged = judge(docs.select("doc_id", "text", "source", "lang"), labels)
    return judged.select(F.col("doc_id").cast("long").alias("doc_id"), "judged.*")
