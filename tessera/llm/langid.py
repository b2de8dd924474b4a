"""Operator 3: language ID by averaged hashed subword embeddings and a linear softmax.

A word gives its character n-grams and itself, hashed to ``BUCKETS`` rows of an
embedding table; a text is the average over all of them. The table and the
softmax are trained together by stochastic gradient descent in numpy, on at
most ``SAMPLE_DOCS`` labelled documents, each seen whole and as short
snippets. A held-back fifth of the sample sets the temperature that calibrates the
probabilities, and the scores under which a text is rejected: one from the
correctly named whole texts, with a margin, and one from the snippets for
texts no longer than these.

Every text is scored whole, in Arrow batches on the executors; only the
bounded sample's hashed counts reach the driver.

Defined cases: null texts and texts without a letter are ``und`` with score 0
and rejected; a label that is null is not learned from; without any labelled
document every text is ``und``; repeated rows are scored row by row; an empty
table gives no rows. Predictions read only the text.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.functions import ArrowUDFType

from .common import SLICE_ROWS, per_worker, slices

#: Labelled documents learned from at most, and at most so many of one language (if there are few).
SAMPLE_DOCS = 1600
BUCKETS, DIM = 1 << 13, 16
#: Words of the snippets that are learned from beside the whole text.
SNIPPETS = (2, 5, 12)
EPOCHS, BATCH, RATE = 10, 48, 0.5
#: A whole text is rejected when the odds of its language are under a share of those that all but ``REJECT_RATE`` of
#: the held-back whole texts reach; one no longer than a snippet, under the score that all but so many snippets reach.
REJECT_RATE, REJECT_SHARE, REJECT_SNIPPETS = 0.05, 1 / 20, 0.002
UNKNOWN = "und"
WORDS = re.compile(r"[^\W\d_]+")
#: Runs kept by a worker; texts looked at together, and runs of each at a time.
CACHE_RUNS, TEXTS, PART_RUNS = 120_000, 32, 3000


def run_words(run: str) -> list[str]:
    if run.isalpha():
        return [run.lower()]
    parts = WORDS.findall(run.lower())
    return [w for w in (p if p.isalpha() else "".join(filter(str.isalpha, p)) for p in parts) if w]


MIX = np.uint64(0x9E3779B97F4A7C15)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * MIX
    return h ^ (h >> np.uint64(29))


def subwords(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, word of each) of the words themselves and their n-grams of 1 to 4 characters.

    The words, with marks at their ends, are hashed together as one array of
    code points.
    """
    codes = np.frombuffer("".join([f"<{w}>" for w in words]).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    sizes = np.array([len(w) + 2 for w in words], np.int64)
    stops = np.cumsum(sizes)
    owner = np.repeat(np.arange(len(words)), sizes)
    place = np.arange(len(codes))
    left = np.repeat(stops, sizes) - place  # characters from here to the word's end
    first = place == np.repeat(stops - sizes, sizes)
    hashes = [np.add.reduceat(_mixed(codes + (left.astype(np.uint64) << np.uint64(32))), stops - sizes)]
    owners = [np.arange(len(words))]
    h = np.zeros(len(codes), np.uint64)
    for n in range(1, 5):
        h[:len(codes) - n + 1] = _mixed((h[:len(codes) - n + 1] << np.uint64(1)) + codes[n - 1:] * MIX + np.uint64(n))
        inside = left >= n if n > 1 else ~first & (left > 1)
        hashes.append(h[inside])
        owners.append(owner[inside])
    buckets = (_mixed(np.concatenate(hashes)) >> np.uint64(40)) % np.uint64(BUCKETS)
    return buckets.astype(np.int64), np.concatenate(owners)


def counts(words: list[str]) -> np.ndarray:
    return np.bincount(subwords(words)[0], minlength=BUCKETS)


@dataclass
class Model:
    languages: list[str]
    logits: np.ndarray  # BUCKETS x languages: the embedding times the softmax weights, over the temperature
    bias: np.ndarray
    threshold: float
    short: float  # texts of at most so many subwords are held to ``short_threshold``
    short_threshold: float


def train(rows: list[tuple[str, np.ndarray, np.ndarray, bool, bool]], seed: int = 7) -> Model | None:
    """rows: (language, buckets, counts, whether it calibrates, whether it is a whole text)."""
    languages = sorted({r[0] for r in rows})
    if not languages:
        return None
    rng, k = np.random.default_rng(seed), len(languages)
    number = {name: i for i, name in enumerate(languages)}

    def dense(own: list) -> np.ndarray:
        x = np.zeros((len(own), BUCKETS), np.float32)
        for i, (_, at, n, *_) in enumerate(own):
            x[i, at] = n
        return x / np.maximum(x.sum(1, keepdims=True), 1)

    learn = [r for r in rows if not r[3]] or rows
    check = [r for r in rows if r[3]] or rows
    table = rng.normal(0, 0.1, (BUCKETS, DIM)).astype(np.float32)
    weights, bias = rng.normal(0, 0.1, (DIM, k)).astype(np.float32), np.zeros(k, np.float32)
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        order = rng.permutation(len(learn))
        for at in range(0, len(order), BATCH):
            own = [learn[i] for i in order[at:at + BATCH]]
            x = dense(own)
            hidden = x @ table
            z = hidden @ weights + bias
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(own)), [number[r[0]] for r in own]] -= 1
            back = p @ weights.T
            weights -= rate * hidden.T @ p / len(own) * 4
            bias -= rate * p.mean(0)
            table -= rate * 40 * (x.T @ back) / len(own)
    z = np.concatenate([dense(check[at:at + BATCH]) @ table @ weights + bias for at in range(0, len(check), BATCH)])
    truth = np.array([number[r[0]] for r in check])

    def probabilities(heat: float) -> np.ndarray:
        e = np.exp((z - z.max(1, keepdims=True)) / heat)
        return e / e.sum(1, keepdims=True)

    heats = np.geomspace(0.1, 10, 41)
    losses = [-np.log(np.maximum(probabilities(h)[np.arange(len(truth)), truth], 1e-9)).mean() for h in heats]
    heat = float(heats[int(np.argmin(losses))])
    p = probabilities(heat)
    right, whole = p.argmax(1) == truth, np.array([r[4] for r in check])
    size = np.array([r[2].sum() for r in check])

    def reached(own: np.ndarray, rate: float) -> float:
        scores = np.sort(p.max(1)[own & right])
        return float(scores[int(len(scores) * rate)]) if len(scores) else 0.0

    least = reached(whole, REJECT_RATE)
    odds = least / max(1 - least, 1e-9) * REJECT_SHARE
    return Model(languages, (table @ weights / heat).astype(np.float64), (bias / heat).astype(np.float64), odds / (1 + odds),
                 float(size[~whole].max(initial=0)), reached(~whole, REJECT_SNIPPETS))


class Scorer:
    """Probabilities of whole texts; the summed logits of a run of characters are kept while there is room."""

    def __init__(self, model: Model):
        self.model = model
        self.rows = np.zeros((CACHE_RUNS, len(model.languages) + 1))  # logits, number of subwords
        self.place: dict[str, int] = {}

    def _learn(self, runs: list[str]) -> None:
        """Give each new run its row: the sum over its words."""
        if len(self.place) + len(runs) > CACHE_RUNS:
            raise ValueError("no room")
        owner, words = [], {}
        at_word = []
        for n, run in enumerate(runs):
            for word in run_words(run):
                owner.append(n)
                at_word.append(words.setdefault(word, len(words)))
        begin = len(self.place)
        self.place.update(zip(runs, range(begin, begin + len(runs))))
        own = self.rows[begin:begin + len(runs)]
        own[:] = 0
        if words:
            buckets, of = subwords(list(words))
            order = np.argsort(of, kind="stable")
            starts = np.searchsorted(of[order], np.arange(len(words)))
            found = np.empty((len(words), self.rows.shape[1]))
            found[:, :-1] = np.add.reduceat(self.model.logits[buckets[order]], starts)
            found[:, -1] = np.bincount(of, minlength=len(words))
            np.add.at(own, owner, found[at_word])

    def totals(self, texts: list[list[str]]) -> np.ndarray:
        """Summed rows of each list of runs; all their different runs fit the room."""
        new = set().union(*texts).difference(self.place)
        if len(self.place) + len(new) > CACHE_RUNS:
            self.place.clear()
            new = set().union(*texts)
        self._learn(sorted(new))
        look = self.place.__getitem__
        return np.array([self.rows[list(map(look, runs))].sum(0) if runs else np.zeros(self.rows.shape[1]) for runs in texts])

    def __call__(self, texts: list[str | None]) -> list[tuple[str, float, bool]]:
        out = []
        for at in range(0, len(texts), TEXTS):
            runs = [(t or "").split() for t in texts[at:at + TEXTS]]
            total = np.zeros((len(runs), self.rows.shape[1]))
            while any(runs):  # a part of each text at a time, so that memory is bounded for any text
                total += self.totals([r[:PART_RUNS] for r in runs])
                runs = [r[PART_RUNS:] for r in runs]
            out += map(self._named, total)
        return out

    def _named(self, total: np.ndarray) -> tuple[str, float, bool]:
        if not total[-1]:
            return UNKNOWN, 0.0, True
        z = total[:-1] / total[-1] + self.model.bias
        p = np.exp(z - z.max())
        p /= p.sum()
        best = int(p.argmax())
        model = self.model
        threshold = model.short_threshold if total[-1] <= model.short else model.threshold
        return model.languages[best], float(p[best]), bool(p[best] < threshold)


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, key, buckets, counts) of each whole text and of its snippets."""
    for batch in batches:
        for part in slices(batch, 64):
            out: list[list] = [[], [], [], []]
            for doc_id, text, lang in zip(*(c.to_pylist() for c in part.columns)):
                words = [w for run in (text or "").split() for w in run_words(run)]
                if not words:
                    continue
                key = zlib.crc32(f"sample {doc_id}".encode())
                spans = [words] + [words[key % max(1, len(words) - n + 1):][:n] for n in SNIPPETS]
                for n, span in enumerate(spans):
                    found = counts(span)
                    at = np.flatnonzero(found)
                    for column, value in zip(out, (lang, key * 8 + n, at.astype("<u2").tobytes(), found[at].astype("<f4").tobytes())):
                        column.append(value)
            yield pa.record_batch([pa.array(c, t) for c, t in zip(out, (pa.string(), pa.int64(), pa.binary(), pa.binary()))],
                                  ["lang", "key", "buckets", "counts"])


def fit(docs: DataFrame, learn_from: Column, label_col: str = "lang", id_col: str = "doc_id", text_col: str = "text",
        sample_docs: int = SAMPLE_DOCS) -> Model | None:
    """Train on a bounded sample, spread evenly over the languages, of the rows where ``learn_from`` holds."""
    own = docs.where(learn_from & F.col(label_col).isNotNull() & F.col(text_col).isNotNull())
    slim = own.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("string").alias("lang"))
    languages = slim.agg(F.count_distinct("lang")).first()[0]
    if not languages:
        return None
    share = max(1, sample_docs // languages)
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = (slim.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= share)
              .select("doc_id").limit(sample_docs))
    texts = own.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                       F.col(label_col).cast("string").alias("lang"))
    sample = (texts.join(F.broadcast(chosen.distinct()), "doc_id", "left_semi")  # at most sample_docs ids
              .mapInArrow(_features, "lang string, key long, buckets binary, counts binary")
              .limit(sample_docs * (1 + len(SNIPPETS))).collect())
    rows = sorted(sample, key=lambda r: (r["key"], r["lang"], r["counts"]))
    return train([(r["lang"], np.frombuffer(r["buckets"], "<u2"), np.frombuffer(r["counts"], "<f4"), r["key"] // 8 % 5 == 0,
                   r["key"] % 8 == 0)
                  for r in rows])


def identify(docs: DataFrame, model: Model | None, text_col: str = "text", out: str = "language") -> DataFrame:
    """``docs`` plus a struct column ``out``: lang, score, rejected."""
    kind = "lang string, score double, rejected boolean"
    if model is None:
        unknown = F.struct(F.lit(UNKNOWN).alias("lang"), F.lit(0.0).alias("score"), F.lit(True).alias("rejected"))
        return docs.withColumn(out, unknown)
    key = hashlib.sha256(repr((model.languages, model.threshold, model.short, model.short_threshold)).encode()
                         + model.logits.tobytes() + model.bias.tobytes()).digest()
    # BUCKETS x languages numbers; plain values, since workers need not have this package
    held = docs.sparkSession.sparkContext.broadcast(tuple(vars(model).values()))

    def run(texts):
        score = per_worker(("language", key), lambda: Scorer(Model(*held.value)))
        # a slice of the texts as Python strings at a time
        found = [row for at in range(0, len(texts), SLICE_ROWS) for row in score(texts.slice(at, SLICE_ROWS).to_pylist())]
        columns = zip(*found) if found else [()] * 3
        return pa.StructArray.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.float64(), pa.bool_()))],
                                          ["lang", "score", "rejected"])

    return docs.withColumn(out, F.arrow_udf(run, kind, ArrowUDFType.SCALAR)(F.col(text_col).cast("string")))


def held_out(id_col: str = "doc_id") -> Column:
    """Whether crc32 of the id as text leaves 1 when divided by 3 (a null id is not held out)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def predict_languages(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected; learned from the documents that are not held out."""
    model = fit(docs, ~held_out() & F.col("doc_id").isNotNull())
    named = identify(docs.select("doc_id", "text"), model)
    return named.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"),
                        F.col("language.lang").alias("lang_pred"), F.col("language.score").alias("score"),
                        F.col("language.rejected").alias("rejected"))
