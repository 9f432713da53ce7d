"""Toxicity by multiple-instance learning: a document is a bag of sentences.

A sentence's probability is a logistic function of its words and their beginnings; a
document's is the noisy-or of its sentences: 1 - product of (1 - p).  Only documents carry
labels, yet training through the noisy-or teaches which sentences, and which words, make a
document toxic; so the fitted model also points at the offending sentences.

A long text is not toxic by its length: a sentence without a word of the model has
probability 0, in training as in scoring, and sentences below QUIET count together as the
likeliest of them, so no number of them adds up.

The model is fitted on the driver to a sample of labelled documents: those of the
TRAIN_DOCS labels first in hash order, without texts of more than TRAIN_CHARS code points.
Both are bounds of what is collected, and parameters.  Documents with
crc32(doc_id) mod 5 = 0 are held out and never trained on.  Every document is scored, over
its whole text, where it lies: one pass, no shuffle.

Defined results: a null or empty text has no sentence, so its score is 0; several labels
of one document count as toxic if one of them says so, null labels say nothing; without
any usable label all scores are 0; repeated
rows are scored alike; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from gaugemill.llm.common import arrow_slices

TRAIN_DOCS = 8_000
TRAIN_CHARS = 60_000
HOLD_OUT = 5
MIN_DOCS = 4
# Features that training looks at: those most over-represented in toxic documents.
FEATURES = 4096
# Beginnings of longer words are features too: inflected forms share them.
STEMS = (5, 4)
QUIET = 0.5

SENTENCE = re.compile(r"[^.!?\n]+")
WORD = re.compile(r"[^\W\d_]+")


def features(text: str) -> set[str]:
    """Lower-case words, and the beginnings of longer ones marked by a star."""
    words = set(WORD.findall(text.lower()))
    return words.union(*({w[:n] + "*" for w in words if len(w) > n} for n in STEMS))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % HOLD_OUT == 0, F.lit(False))


@dataclass
class Model:
    bias: float = -7.0
    weights: dict[str, float] = field(default_factory=dict)

    def sentences(self, text: str) -> list[tuple[int, int, float]]:
        """(start, end, probability) of each sentence that has words of the model."""
        out = []
        for m in SENTENCE.finditer(text):
            known = self.weights.keys() & features(m[0])
            if known:
                z = self.bias + sum(self.weights[w] for w in known)
                out.append((m.start(), m.end(), 1 / (1 + math.exp(-max(-60.0, min(60.0, z))))))
        return out

    def score(self, text: str | None) -> tuple[float, list[tuple[int, int, float]]]:
        """Noisy-or of all sentences, and the sentences with words of the model."""
        if not text:
            return 0.0, []
        seen = self.weights.keys() & features(text)
        known = self.sentences(text) if seen else []
        quiet = max((p for _, _, p in known if p < QUIET), default=0.0)
        clean = math.log1p(-quiet)
        clean += sum(math.log1p(-min(p, 1 - 1e-12)) for _, _, p in known if p >= QUIET)
        return 1 - math.exp(clean), known


def _telling(texts: list[str], labels: np.ndarray, min_docs: int) -> set[str]:
    """The FEATURES that occur in toxic documents more often than chance has it, by z-score."""
    everywhere: Counter[str] = Counter()
    toxic: Counter[str] = Counter()
    for text, label in zip(texts, labels):
        found = features(text)
        everywhere.update(found)
        if label:
            toxic.update(found)
    share = labels.mean()
    spread = math.sqrt(share * (1 - share))
    rated = [
        ((n_toxic - everywhere[w] * share) / (spread * math.sqrt(everywhere[w])), w)
        for w, n_toxic in toxic.items() if everywhere[w] >= min_docs
    ]
    return {w for z, w in sorted(rated, reverse=True)[:FEATURES] if z > 1}


def train(bags: list[tuple[str, int]], min_docs: int = MIN_DOCS, rounds: int = 250,
          rate: float = 0.15, shrink: float = 5e-5) -> Model:
    """Fit to (text, label) by Adam on the log-likelihood of the noisy-or."""
    labels = np.array([y for _, y in bags], float)
    if not bags or labels.min() == labels.max():
        return Model()
    chosen = _telling([t for t, _ in bags], labels, min_docs)
    vocabulary = sorted(chosen)
    number = {w: i for i, w in enumerate(vocabulary)}
    words, sentence_of, doc_of = [], [], []
    for d, (text, _) in enumerate(bags):
        for s in SENTENCE.findall(text):
            ids = sorted(number[w] for w in features(s) & chosen)
            if not ids:
                continue
            words.extend(ids)
            sentence_of.extend([len(doc_of)] * len(ids))
            doc_of.append(d)
    words, sentence_of, doc_of = (np.array(x, np.int32) for x in (words, sentence_of, doc_of))
    weight, bias = np.zeros(len(vocabulary)), -5.0
    m, v = np.zeros(len(vocabulary) + 1), np.zeros(len(vocabulary) + 1)
    for step in range(1, rounds + 1):
        z = bias + np.bincount(sentence_of, weight[words], len(doc_of))
        z = np.clip(z, -30, 30)
        p = 1 / (1 + np.exp(-z))
        clean = np.exp(-np.bincount(doc_of, np.logaddexp(0, z), len(bags)))
        pull = np.where(labels > 0, -clean / np.maximum(1 - clean, 1e-6), 1.0)
        dz = pull[doc_of] * p
        grad = np.append(np.bincount(words, dz[sentence_of], len(vocabulary)), dz.sum()) / len(bags)
        grad[:-1] += shrink * np.sign(weight)
        m = 0.9 * m + 0.1 * grad
        v = 0.999 * v + 0.001 * grad**2
        move = rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        weight -= move[:-1]
        bias -= move[-1]
    kept = np.nonzero(np.abs(weight) > 0.75)[0]
    return Model(float(bias), {vocabulary[i]: float(weight[i]) for i in kept})


def training_bags(docs: DataFrame, labels: DataFrame, limit: int = TRAIN_DOCS,
                  max_chars: int = TRAIN_CHARS) -> list[tuple[str, int]]:
    """The bounded sample of labelled documents, in a fixed order."""
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), "toxic")
        .filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    )
    rows = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        .filter(F.length("text").between(1, max_chars))
        .join(F.broadcast(known), "doc_id")
        .groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
        .collect()
    )
    return [(r["text"], r["toxic"]) for r in sorted(rows, key=lambda r: r["doc_id"])]


def scores(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score, and the offending sentences (start, end, score; code points) of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    spans = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = shared.value
        for batch in batches:
            for part in arrow_slices(batch, "text"):
                found = [fitted.score(t.as_py()) for t in part.column("text")]
                bad = [
                    [{"start": a, "end": b, "score": p} for a, b, p in known if p >= 0.5]
                    for _, known in found
                ]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array([s for s, _ in found], pa.float64()),
                     pa.array(bad, spans)],
                    names=["doc_id", "score", "offending"],
                )

    narrow = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    schema = "doc_id long, score double, offending array<struct<start: long, end: long, score: double>>"
    return narrow.mapInArrow(run, schema)


def toxicity(docs: DataFrame, labels: DataFrame, limit: int = TRAIN_DOCS) -> DataFrame:
    """doc_id, held_out, score, predicted and offending sentences of every document."""
    model = train(training_bags(docs, labels, limit))
    return scores(docs, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"), "offending",
    )
