"""Toxicity by multiple-instance learning with a noisy-or over sentences.

A document is a bag of sentences; a sentence has a probability from a
logistic model over its words, as far as it is above that of a sentence without
any telling word, and the document is toxic when any sentence is:
score = 1 - (1 - calm) * prod(1 - p).  What calm text there is beside adds
nothing, however long it is.  Only document labels are needed to train, by the
gradient of the bag's log-likelihood through the noisy-or; afterwards the
sentence probabilities say where the offence is.

Training uses at most ``SAMPLE`` labelled rows of each class (chosen by a hash
of the id; none that is held out) and runs in one task, whose input that
bounds.  Scoring covers every sentence of every text.

A null or empty text has no sentence and scores 0.  Rows with a null doc_id are
scored, never learnt from.  Repeated rows score alike.  With no labelled rows
of either class every score is the smoothed share of toxic labels.
Extra columns are ignored.
"""

from __future__ import annotations

import re
import uuid
import zlib
from array import array
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import give_back, held

SAMPLE = 6000  # labelled rows of a class that are learnt from
STEMS = (4, 5, 6)  # letters of a word's beginnings that are features
MIN_DOCS = 4  # toxic documents of the sample that have a feature, at least
LEAST_Z = 4.5
MAX_FEATURES = 20_000
EPOCHS = 300
RIDGE = 1e-4
CALM = 0.005
THRESHOLD = 0.3
CELLS = 1 << 22  # of the first count of features
CACHE = 200_000  # words whose weights a task keeps

_SENTENCE = re.compile(r"[^.!?\n]+")
_WORD = re.compile(r"[^\W\d_]+")


def sentences(text: str) -> Iterator[tuple[int, int, set[str]]]:
    """(start, end, distinct lower-case words) of each sentence that has a word."""
    for m in _SENTENCE.finditer(text):
        words = set(_WORD.findall(m[0].lower()))
        if words:
            yield m.start(), m.end(), words


def held_out(doc_id: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def features(word: str) -> list[str]:
    """The word and its beginnings: a stem is the same whatever ending it takes."""
    return [word, *(f"{word[:n]}-" for n in STEMS if len(word) > n)]


def _found(text: str) -> set[str]:
    words = set().union(*(w for _, _, w in sentences(text)))
    return set().union(*map(features, words))


def choose(texts: list[str], labels: list[int]) -> list[str]:
    """Features that are in toxic documents more often than chance has it, most telling first.

    The measure is the number of standard deviations from what the feature's
    frequency lets expect; a rare word that only happens to be in a few toxic
    documents stays out.  A first pass counts by hash, in a table of fixed
    size; the second counts the features of the telling cells one by one.
    """
    share = sum(labels) / max(1, len(labels))

    def telling(n, toxic):
        return (toxic >= MIN_DOCS) & ((toxic - n * share) / (n * share * (1 - share) + 0.25) ** 0.5 >= LEAST_Z)

    cell = lambda f: zlib.crc32(f.encode()) % CELLS
    cells = np.zeros((2, CELLS), dtype=np.int32)
    for text, label in zip(texts, labels):
        at = np.unique(np.fromiter(map(cell, _found(text)), np.int64))
        cells[0, at] += 1
        if label:
            cells[1, at] += 1
    # a cell can hold other features besides a telling one: half the measure is enough here
    likely = (cells[1] >= MIN_DOCS) & (cells[1] - cells[0] * share >= LEAST_Z / 2 * np.sqrt(cells[0] * share * (1 - share) + 0.25))
    seen, toxic = Counter(), Counter()
    for text, label in zip(texts, labels):
        some = [f for f in _found(text) if likely[cell(f)]]
        seen.update(some)
        if label:
            toxic.update(some)
    z = {f: (toxic[f] - n * share) / (n * share * (1 - share) + 0.25) ** 0.5
         for f, n in seen.items() if telling(n, toxic[f])}
    return [f for f, _ in sorted(z.items(), key=lambda x: (-x[1], x[0]))][:MAX_FEATURES]


def fit(texts: list[str], labels: list[int]) -> tuple[float, dict[str, float]]:
    """(bias, weight of each feature) of the sentence model."""
    names, n_docs = choose(texts, labels), len(texts)
    index, n = {f: i for i, f in enumerate(names)}, len(names)
    doc_of, cells, rows = array("q"), array("q"), array("q")
    for d, text in enumerate(texts):
        for _, _, words in sentences(text):
            at = [index[f] for w in words for f in features(w) if f in index]
            if at:  # others add nothing
                cells.extend(at)
                rows.extend([len(doc_of)] * len(at))
                doc_of.append(d)
    y = np.array(labels, dtype=float)
    doc, cell, row = np.array(doc_of, int), np.array(cells, int), np.array(rows, int)
    if not len(doc) or y.min() == y.max():
        share = (y.sum() + 0.5) / (len(y) + 1)
        return float(np.log(share / (1 - share))), {}
    w = np.zeros(n + 1)
    w[n] = most = np.log(CALM)  # words explain the labels: a document without any scores CALM at most
    first, second = np.zeros(n + 1), np.zeros(n + 1)
    pull = np.full(n + 1, RIDGE)
    pull[n] = 0
    for t in range(1, EPOCHS + 1):
        z = np.bincount(row, w[cell], len(doc)) + w[n]
        calm = np.logaddexp(0, w[n])
        mass = np.bincount(doc, np.maximum(np.logaddexp(0, z) - calm, 0), n_docs) + calm  # -log P(nothing offends)
        quiet = np.exp(-mass)
        per_doc = np.where(y > 0, -quiet / np.maximum(1 - quiet, 1e-9), 1.0)
        level = 1 / (1 + np.exp(-w[n]))
        up = np.where(z >= w[n], per_doc[doc], 0.0)  # the weights start at 0: there too
        dz = up / (1 + np.exp(-z))
        grad = np.append(np.bincount(cell, dz[row], n), (dz - up * level).sum() + per_doc.sum() * level) / n_docs + pull * w
        first += 0.1 * (grad - first)
        second += 0.01 * (grad * grad - second)
        w -= 0.15 * (first / (1 - 0.9 ** t)) / (np.sqrt(second / (1 - 0.99 ** t)) + 1e-8)
        w[n] = min(w[n], most)
    return float(w[n]), {x: float(v) for x, v in zip(names, w)}


class Scorer:
    """-log of the chance that nothing offends: ``calm`` for a document, and what each sentence adds to it."""

    def __init__(self, model: tuple[float, dict[str, float]]):
        self.bias, self.weights = model
        self.calm = float(np.logaddexp(0, self.bias))
        self.known: dict[str, float] = {}

    def word(self, word: str) -> float:
        value = self.known.get(word)
        if value is None:
            if len(self.known) > CACHE:
                self.known.clear()
            value = self.known[word] = sum(self.weights.get(f, 0.0) for f in features(word))
        return value

    def sentence(self, words: set[str]) -> float:
        parts = [v for v in map(self.word, words) if v]
        return max(0.0, float(np.logaddexp(0, self.bias + sum(sorted(parts)))) - self.calm) if parts else 0.0

    def document(self, text: str) -> float:
        found = [self.sentence(words) for _, _, words in sentences(text)]
        return float(-np.expm1(-self.calm - sum(found))) if found else 0.0


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[float, dict[str, float]]:
    """Fit on a bounded sample of the labelled rows that are not held out."""
    rows = labels.where("toxic in (0, 1) and doc_id is not null").where(~held_out()).select(
        F.col("doc_id").alias("l_id"), F.col("toxic").cast("int").alias("toxic")).distinct()
    picked = None
    for c in (0, 1):
        part = rows.where(F.col("toxic") == c).orderBy(F.xxhash64(F.lit(11), "l_id"), "l_id").limit(sample)
        picked = part if picked is None else picked.unionByName(part)
    # at most 2 * sample rows of (id, label): a proven bound for the broadcast
    known = docs.join(F.broadcast(picked), F.col("doc_id") == F.col("l_id")).groupBy("l_id", "toxic").agg(
        F.max(F.coalesce(F.col("text"), F.lit(""))).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = sorted((i, t, x) for b in batches
                     for i, t, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()))
        if not got:
            return
        bias, weights = fit([x for _, _, x in got], [t for _, t, _ in got])
        del got
        give_back()
        yield pa.RecordBatch.from_pydict({"word": pa.array(["", *weights], pa.string()),
                                          "weight": pa.array([bias, *weights.values()], pa.float64())})

    model = {r.word: r.weight for r in known.select("l_id", "toxic", "text").repartition(1).mapInArrow(
        run, "word string, weight double").collect()}  # at most MAX_FEATURES + 1 rows
    return model.pop("", -4.0), model


def score(docs: DataFrame, model: tuple[float, dict[str, float]], locate: bool = False) -> DataFrame:
    """doc_id, score and, with ``locate``, offences: array of (start, end, probability).

    An offence is a sentence whose own probability reaches ``THRESHOLD``;
    start and end count characters of the whole text.
    """
    name = uuid.uuid4().hex
    kind = "doc_id long, score double" + ", offences array<struct<start:int,end:int,probability:double>>" * locate

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = held(("toxicity", name), lambda: Scorer(model))
        for b in batches:
            scores, found = [], []
            for x in b.column(1):
                mass, here = 0.0, []
                some = False
                for start, end, words in sentences(x.as_py() or ""):
                    z = scorer.sentence(words)
                    mass += z if some else z + scorer.calm
                    some = True
                    if locate and -np.expm1(-z) >= THRESHOLD:
                        here.append({"start": start, "end": end, "probability": float(-np.expm1(-z))})
                scores.append(float(-np.expm1(-mass)))
                found.append(here)
            columns = [b.column(0), pa.array(scores, pa.float64())]
            if locate:
                columns.append(pa.array(found, pa.list_(pa.struct(
                    [("start", pa.int32()), ("end", pa.int32()), ("probability", pa.float64())]))))
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "score", "offences"][:len(columns)])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, kind)


def toxicity(docs: DataFrame, labels: DataFrame, locate: bool = True) -> DataFrame:
    """doc_id, held_out, score, predicted and the offending sentences of every document."""
    out = score(docs, train(docs, labels), locate)
    return out.withColumns({"held_out": held_out(), "predicted": (F.col("score") >= THRESHOLD).cast("int")})


def clean_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, with all their columns.

    The score depends on the text alone, so the texts are scored where they
    lie, without a join.
    """
    model, name = train(docs, labels), uuid.uuid4().hex

    @F.arrow_udf("double")
    def rate(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scorer = held(("toxicity", name), lambda: Scorer(model))
        for some in texts:
            yield pa.array([scorer.document(x.as_py() or "") for x in some], pa.float64())
        some = None
        give_back()

    return docs.where(rate(F.col("text").cast("string")) < THRESHOLD)
