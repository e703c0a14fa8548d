"""Quality scores by Naive Bayes support vectors.

A document is a set of n-gram indicators: words and word pairs, and runs of up to four token shapes. A shape is a token's letter
case, length class and punctuation; a token that repeats its predecessor has a shape of its own. So the n-grams tell shouting,
symbols, separators and repetition from running text in any language. Every indicator is scaled by the log-ratio of its smoothed counts in
good and in bad training documents, and a linear model with hinge loss is fitted on the scaled indicators by dual coordinate descent.

Defined results: NULL and empty text have no features and get the score of the bias alone. A label other than 0 or 1 is ignored; of several labels of a document the least counts.
Without training rows of both labels the score is the smoothed share of good ones. Repeated rows are scored
each. A NULL id is not held out. Extra columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import string

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statforge.llm.linear import Model, bucket_counts, fit, in_shards
from statforge.llm.shared import PRIME, checkpointed, held_out, labelled_sample, map_columns, mixed

BITS = 18
THRESHOLD = 0.3
_MOST_KEPT = 300_000
_AGAIN = np.uint64(0xA5A5A5A5A5A5A5A5)
_MARKS = string.punctuation + "¿¡…–—„“”«»"


class _Hashes(dict):
    def __missing__(self, token: str) -> int:
        if len(self) >= _MOST_KEPT:
            self.clear()
        value = self[token] = xxhash.xxh3_64_intdigest(token)
        return value


class _Shapes(dict):
    def __missing__(self, token: str) -> int:
        if len(self) >= _MOST_KEPT:
            self.clear()
        bare = token.strip(_MARKS)
        before, after = token[: len(token) - len(token.lstrip(_MARKS))], token[len(token.rstrip(_MARKS)) :]
        case = "d" if bare.isdigit() else "U" if bare.isupper() and len(bare) > 1 else "l" if bare.islower() else "T" if bare[:1].isupper() else "m" if bare else ""
        value = self[token] = xxhash.xxh3_64_intdigest(f"{before[:3]}|{case}{min(len(bare) // 4, 4)}|{after[:3]}")
        return value


class Indicators:
    """The n-grams of a text, as buckets."""

    def __init__(self, bits: int = BITS):
        self.hashes, self.shapes, self.shift = _Hashes(), _Shapes(), np.uint64(64 - bits)

    def of(self, text: str | None) -> np.ndarray:
        tokens = (text or "").split()
        if not tokens:
            return np.zeros(0, "int32")
        words = np.fromiter(map(self.hashes.__getitem__, map(str.lower, tokens)), "uint64", len(tokens))
        shapes = np.fromiter(map(self.shapes.__getitem__, tokens), "uint64", len(tokens))
        shapes[1:][words[1:] == words[:-1]] = _AGAIN
        grams = [words, words[:-1] * PRIME + words[1:]]
        run = shapes
        for n in range(1, 5):
            grams.append(run + np.uint64(n))
            if len(shapes) <= n:
                break
            run = run[:-1] * PRIME + shapes[n:]
        return np.unique((mixed(np.concatenate(grams)) >> self.shift).astype("int32"))


def log_ratios(good: np.ndarray, bad: np.ndarray, smoothing: float = 1.0, least: int = 3) -> np.ndarray:
    """Log-ratio of each indicator's share of all counts, good against bad; 0 where it is seen in fewer than ``least`` documents."""
    p, q = good + smoothing, bad + smoothing
    ratio = np.log((p / p.sum()) / (q / q.sum()))
    ratio[good + bad < least] = 0
    return ratio


def train(docs: DataFrame, labels: DataFrame, fit_rows: int, seed: int) -> Model | float:
    """A model from at most ``fit_rows`` labelled documents outside the held-out fold, or a constant score."""

    def work(ids, texts, targets):
        grams = Indicators()
        return {"doc_id": ids, "target": [float(y) for y in targets], "features": [grams.of(text) for text in texts]}

    sample = labelled_sample(docs, labels, "quality", fit_rows, seed)
    rows = checkpointed(in_shards(map_columns(sample, "doc_id bigint, target double, features array<int>", work), seed), "quality")
    number, good = rows.agg(F.count("*"), F.coalesce(F.sum("target"), F.lit(0.0))).first()
    if not 0 < good < number:
        return (good + 1) / (number + 2)
    return fit(rows, log_ratios(*bucket_counts(rows.where("target >= 0"), 1 << BITS)))


def score_quality(docs: DataFrame, labels: DataFrame, fit_rows: int = 12_000, threshold: float = THRESHOLD, seed: int = 11) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``.

    ``fit_rows`` bounds the labelled sample that the classifier is fitted on; every document is scored over its whole text.
    """
    model = train(docs, labels, fit_rows, seed)
    return scored(docs, model, Indicators, threshold)


def scored(docs: DataFrame, model: Model | float, indicators: type, threshold: float) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(model)  # two numbers a bucket

    def work(ids, texts, aside):
        grams, own = indicators(), shared.value
        scores = [own.probability(grams.of(text)) if isinstance(own, Model) else own for text in texts]
        return {"doc_id": ids, "held_out": aside, "score": scores, "predicted": [int(s >= threshold) for s in scores]}

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", held_out(F.col("doc_id")).alias("held_out"))
    return map_columns(rows, "doc_id bigint, held_out boolean, score double, predicted int", work)
