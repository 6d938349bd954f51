"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

A text's features are the buckets of its character n-grams, present or absent. Each is scaled by the log of how much
more often toxic than other texts have it, smoothed by the share of toxic texts so that rare buckets tell
nothing; on these a logistic regression is fitted. Weights below CUT of the largest are set to zero, and
the rest is fitted again. One weight per bucket is broadcast: 1 MB, whatever the data.

The model learns from at most SAMPLE texts of each class (the smallest hashes of their ids) of at most SAMPLE_CHARS
code points each, so what the driver gathers is bounded: SAMPLE x 2 x SAMPLE_CHARS numbers of four bytes, and a few
per cent of that in practice. Every whole text is scored.

Null texts count as empty. Labels other than 0 and 1 and null ids teach nothing. Without texts of both classes every
score is the share of toxic texts, 0 if there are none.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from variantry.llm.arrow_text import bound_batches
from variantry.llm.ngrams import grams, sums

WIDTHS = (4,)
BITS = 18
BUCKETS = 1 << BITS
SAMPLE = 2_500
SAMPLE_CHARS = 16_000
ROUNDS = 80
RATE = 0.03
PENALTY = 1e-3
CUT = 0.03


@dataclass(frozen=True)
class ToxicityModel:
    weights: np.ndarray
    bias: float


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct buckets of each text as 32-bit numbers."""
    for batch in batches:
        for at, texts, found in grams(batch.column("text"), WIDTHS, BITS):
            keys = np.unique(np.concatenate([(owner << BITS) | buckets for buckets, owner in found]))
            cuts = np.searchsorted(keys >> BITS, np.arange(texts + 1))
            data = (keys & (BUCKETS - 1)).astype(np.int32)
            values = [data[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
            yield pa.record_batch({"toxic": batch.column("toxic").slice(at, texts), "features": pa.array(values, pa.binary())})


def _logistic(x: np.ndarray, starts: np.ndarray, y: np.ndarray, ratio: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights for the ratio of each bucket, and a bias; both classes weigh the same."""
    owner = np.repeat(np.arange(len(y)), np.diff(starts))
    value, share = ratio[x], y.mean()
    importance = np.where(y == 1, 0.5 / share, 0.5 / (1 - share)) / len(y)
    state = np.zeros(BUCKETS + 1)
    mean, square = np.zeros_like(state), np.zeros_like(state)
    for step in range(1, ROUNDS + 1):
        z = sums(state[x] * value, owner, len(y)) + state[-1]
        error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) * importance
        slope = np.append(np.bincount(x, weights=error[owner] * value, minlength=BUCKETS) + PENALTY * state[:-1], error.sum())
        mean, square = 0.9 * mean + 0.1 * slope, 0.999 * square + 0.001 * slope * slope
        state -= RATE * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    return state[:-1] * ratio, float(state[-1])


def fit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
    sample: int = SAMPLE, sample_chars: int = SAMPLE_CHARS,
) -> ToxicityModel:
    """Learns from the texts of `docs` whose ids `labels` marks 0 or 1."""
    bound_batches()
    marks = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("toxic")).where("id is not null").distinct()
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.coalesce(F.length(text_col), F.lit(0)).alias("n"))
    short = texts.where(F.col("n") <= sample_chars)
    known = marks.join(short.select("id").distinct(), "id")
    chosen = [known.where(F.col("toxic") == toxic).orderBy(F.xxhash64("id"), "id").limit(sample) for toxic in (0, 1)]
    picked = short.join(F.broadcast(chosen[0].union(chosen[1])), "id").groupBy("id", "toxic").agg(F.min("text").alias("text"))
    rows = picked.select("toxic", "text").mapInArrow(_features, "toxic int, features binary").toArrow()
    y = rows["toxic"].to_numpy().astype(np.float64)
    if not len(y) or y.min() == y.max():
        share = np.clip(y.mean() if len(y) else 0.0, 1e-9, 1 - 1e-9)
        return ToxicityModel(np.zeros(BUCKETS, np.float32), float(np.log(share / (1 - share))))
    parts = [np.frombuffer(value, np.int32) for value in rows["features"].to_pylist()]
    x, starts = np.concatenate(parts), np.concatenate(([0], np.cumsum([len(part) for part in parts])))
    owner = np.repeat(np.arange(len(y)), np.diff(starts))
    share = y.mean()
    inside, outside = (np.bincount(x[y[owner] == toxic], minlength=BUCKETS) for toxic in (1, 0))
    ratio = np.log((inside + share) / y.sum()) - np.log((outside + 1 - share) / (1 - y).sum())
    weights, _ = _logistic(x, starts, y, ratio)
    ratio = np.where(np.abs(weights) >= CUT * np.abs(weights).max(), ratio, 0.0)
    kept = ratio[x] != 0
    starts = np.concatenate(([0], np.cumsum(kept)))[starts]
    weights, bias = _logistic(x[kept], starts, y, ratio)
    return ToxicityModel(weights.astype(np.float32), bias)


def score(docs: DataFrame, model: ToxicityModel, text: Column) -> Column:
    """The probability that a text of `docs` is toxic."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def compute(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        weights, bias = shared.value.weights, shared.value.bias
        counts = weights != 0
        for batch in batches:
            z = np.full(len(batch), bias)
            for at, texts, found in grams(batch, WIDTHS, BITS):
                hits = [((owner.astype(np.int64) << BITS) | buckets)[counts[buckets]] for buckets, owner in found]
                keys = np.unique(np.concatenate(hits))
                z[at : at + texts] += sums(weights[keys & (BUCKETS - 1)], keys >> BITS, texts)
            yield pa.array(1 / (1 + np.exp(-np.clip(z, -30, 30))))

    return F.arrow_udf(compute, "double")(text)


def classify(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of `docs`: its id, score, and predicted: 1 if the score is at least 0.5."""
    scored = docs.select(F.col(id_col), score(docs, model, F.col(text_col)).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
