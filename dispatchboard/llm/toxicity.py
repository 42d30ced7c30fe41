"""Toxicity by non-negative positive-unlabelled learning.

A linear classifier over how densely a text holds certain words and word
beginnings is trained from confirmed toxic documents and unlabelled ones. The risk of calling an unlabelled text toxic
is corrected by the class prior, since some of them are toxic, and the
corrected part is kept from falling below zero (Kiryo et al., 2017), so the
model can't profit from learning the unlabelled sample by heart.

Training is bounded: at most about ``POSITIVES`` labelled toxic documents,
``UNLABELLED`` others, drawn by seeded hashes from the whole table, and
``VOCABULARY`` features, chosen by a grouped aggregate over the sample.
Scoring reads every whole text in its own task.

Labels are used only outside the held-out fold (``crc32(doc_id as text) mod 5
= 0``), and only the positive ones train; the prior is their share among the
labels outside it. Labels, language, source and doc_id are never features.

Cases: null and empty texts score what the bias alone says; a null doc_id
counts as held out; several labels of a document count as toxic if one does;
without a positive label every score is 0; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dispatchboard.llm.shared import located, saved

POSITIVES = 2000
UNLABELLED = 6000
VOCABULARY = 1 << 13
# Sampled texts a feature must occur in.
LEAST_TEXTS = 5
# A feature is a whole word or its first 4 to 8 letters.
BEGINNINGS = range(4, 9)
# Density: occurrences per so many words; a text counts as that much longer,
# so one word doesn't decide a text of a few words.
PER_WORDS, SMOOTHING = 50, 40
FOLDS = 5
SEED = 8
STEPS = 300
RATE = 0.05
RIDGE = 1e-3
# Words whose weight a worker remembers.
CACHED_WORDS = 1 << 20

# Everything in ASCII but letters and digits separates words.
_SEPARATORS = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def _words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").lower().translate(_SEPARATORS).split()


def _features(word: bytes) -> set[str]:
    letters = word.decode("utf-8", "replace").lower()
    return {letters[:n] + "-" for n in BEGINNINGS if len(letters) >= n} | {letters}


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


class _WordWeights(dict):
    """word -> sum of its features' weights, worked out when first asked for."""

    def __init__(self, weights: dict[str, float]):
        super().__init__()
        self.weights = weights

    def __missing__(self, word: bytes) -> float:
        if len(self) >= CACHED_WORDS:
            self.clear()
        self[word] = found = sum(self.weights.get(f, 0.0) for f in sorted(_features(word)))
        return found


@dataclass
class Model:
    """Weight of each feature's density and the bias, in log odds. Without
    weights (no positive label to learn from) every score is 0."""
    weights: dict[str, float]
    bias: float

    def score(self, text: Column) -> Column:
        weights, bias = self.weights, self.bias

        @F.pandas_udf("double")
        def of(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
            weight = _WordWeights(weights).__getitem__
            for batch in texts:
                odds = []
                for text in batch:
                    words = _words(text)
                    odds.append(bias + PER_WORDS * sum(map(weight, words)) / (len(words) + SMOOTHING))
                yield pd.Series(1 / (1 + np.exp(-np.clip(np.array(odds, float), -60, 60))))
        return of(text) if weights else F.lit(0.0)


def _chance(*of: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(F.lit(SEED), *of), 11) / F.lit(float(1 << 53))


def _sample(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, float]:
    """``draw, positive, text`` of the bounded sample, and the class prior."""
    known = (labels.where(~held_out(F.col("doc_id")) & F.col("toxic").isNotNull())
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    n, toxic = known.agg(F.count(F.lit(1)), F.sum((F.col("toxic") == 1).cast("long"))).first()
    rows, at = located(docs)
    open_rows = rows.where(~held_out(F.col("doc_id")))
    others = open_rows.count()
    texts = open_rows.select(
        "doc_id", F.col("text").cast("string").alias("text"),
        _chance(F.col("doc_id"), rows[at]["row"]).alias("draw"))
    drawn = known.where((F.col("toxic") == 1)
                        & (_chance(F.col("doc_id")) * (toxic or 0) < POSITIVES)).select("doc_id")
    # Bounded by the draw: about POSITIVES ids.
    positive = (texts.join(F.broadcast(drawn), "doc_id")
                .groupBy("doc_id").agg(F.min(F.struct("draw", "text")).alias("one"))
                .select("one.draw", F.lit(True).alias("positive"), "one.text"))
    unlabelled = (texts.where(F.col("draw") * others < UNLABELLED)
                  .select("draw", F.lit(False).alias("positive"), "text"))
    return saved(positive.union(unlabelled), "sample"), (toxic or 0) / n if n else 0.0


def _vocabulary(sample: DataFrame) -> list[str]:
    """Features whose share of texts differs most between the two samples."""
    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            of = {True: Counter(), False: Counter()}
            for positive, text in zip(b["positive"], b["text"]):
                of[bool(positive)].update(set().union(*map(_features, set(_words(text)))))
            rows = [(f, of[True][f], of[False][f]) for f in {*of[True], *of[False]}]
            yield pd.DataFrame(rows, columns=["feature", "p", "u"]).astype({"p": "int64", "u": "int64"})

    n = {r["positive"]: r["count"] for r in sample.groupBy("positive").count().collect()}
    p, u = F.col("p") / max(1, n.get(True, 0)), F.col("u") / max(1, n.get(False, 0))
    share = (F.col("p") + F.col("u")) / max(1, sum(n.values()))
    counts = (sample.mapInPandas(counted, "feature string, p long, u long").groupBy("feature")
              .agg(F.sum("p").alias("p"), F.sum("u").alias("u"))
              .where(F.col("p") + F.col("u") >= LEAST_TEXTS))
    best = counts.orderBy(F.desc(F.abs(p - u) / F.sqrt(share * (1 - share) + 1e-9)), "feature")
    return [r["feature"] for r in best.select("feature").limit(VOCABULARY).collect()]


def non_negative_pu(rows: np.ndarray, features: np.ndarray, values: np.ndarray,
                    positive: np.ndarray, width: int, prior: float) -> tuple[np.ndarray, float]:
    """Weights and bias of the log odds. ``(rows, features, values)`` are the
    entries of the sparse matrix; ``positive`` marks its confirmed rows.

    With logistic losses L+ (called clean) and L- (called toxic) the risk is
    prior * E_p[L+] + max(0, E_u[L-] - prior * E_p[L-]); where the second part
    is negative its gradient is followed upwards instead."""
    n = len(positive)
    p, u = positive / max(1, positive.sum()), ~positive / max(1, (~positive).sum())
    weights = np.zeros(width + 1)
    mean, square = np.zeros(width + 1), np.zeros(width + 1)
    for step in range(1, STEPS + 1):
        odds = np.bincount(rows, values * weights[features], n) + weights[width]
        chance = 1 / (1 + np.exp(-np.clip(odds, -60, 60)))
        soft = np.logaddexp(0, odds)
        corrected = (u * soft).sum() - prior * (p * soft).sum()
        away = u * chance - prior * p * chance
        slope = -away if corrected < 0 else -prior * p * (1 - chance) + away
        grad = np.append(np.bincount(features, values * slope[rows], width)
                         + RIDGE * prior * weights[:width], slope.sum())
        mean = 0.9 * mean + 0.1 * grad
        square = 0.999 * square + 0.001 * grad ** 2
        weights -= RATE * (mean / (1 - 0.9 ** step)) / (np.sqrt(square / (1 - 0.999 ** step)) + 1e-9)
    return weights[:width], float(weights[width])


def train(docs: DataFrame, labels: DataFrame) -> Model:
    sample, prior = _sample(docs, labels)
    vocabulary = _vocabulary(sample) if prior else []
    if not vocabulary:
        return Model({}, 0.0)
    number = {f: i for i, f in enumerate(vocabulary)}

    def numbered(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            ids, densities = [], []
            for text in b["text"]:
                words = _words(text)
                of = Counter(number[f] for w in words for f in _features(w) if f in number)
                ids.append(sorted(of))
                densities.append([PER_WORDS * of[i] / (len(words) + SMOOTHING) for i in sorted(of)])
            yield b.assign(ids=ids, densities=densities).drop(columns="text")

    bounded = (sample.mapInPandas(numbered, "draw double, positive boolean, ids array<int>, "
                                            "densities array<double>")
               .toPandas().sort_values(["positive", "draw"], kind="stable"))
    rows = np.repeat(np.arange(len(bounded)), bounded["ids"].map(len).to_numpy())
    features = np.concatenate([np.asarray(x, np.int64) for x in bounded["ids"]])
    values = np.concatenate([np.asarray(x, float) for x in bounded["densities"]])
    weights, bias = non_negative_pu(rows, features, values, bounded["positive"].to_numpy(bool),
                                    len(vocabulary), prior)
    return Model({f: float(x) for f, x in zip(vocabulary, weights)}, bias)


def scored(docs: DataFrame, labels: DataFrame, model: Model | None = None) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document."""
    model = model or train(docs, labels)
    return (docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"),
                        model.score(F.col("text").cast("string")).alias("score"))
            .withColumn("predicted", (F.col("score") >= 0.5).cast("int")))


def drop_toxic(docs: DataFrame, labels: DataFrame, model: Model | None = None) -> DataFrame:
    """``docs`` without those predicted toxic, columns unchanged."""
    model = model or train(docs, labels)
    return docs.where(model.score(F.col("text").cast("string")) < 0.5)
