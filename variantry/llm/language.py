"""Language identification: multinomial naive Bayes over hashed character n-grams.

Every task counts the n-grams of its labelled texts per language and bucket, Spark adds the counts up, and the
matrix of log-probabilities is broadcast: BUCKETS x languages single-precision numbers, at most 64 MB as more than
MAX_LANGUAGES languages are refused. A batch of texts is a sparse matrix (a row per text, a column per bucket) whose
product with the matrix gives the scores.

A language learns from at most about SAMPLE texts, taken by a hash of id and length; what is scored is every whole text.
Texts that are null or without a letter are `und` with score 0, as are all texts if there was nothing to learn from.
The score is the posterior probability of the language. Of equal ones the first in order of code points wins.
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

WIDTHS = (1, 2, 3)
BITS = 15
BUCKETS = 1 << BITS
MAX_LANGUAGES = 512
SAMPLE = 20_000
SMOOTHING = 0.5
UNKNOWN = "und"


@dataclass(frozen=True)
class LanguageModel:
    languages: list[str]
    #: Log-probability of each bucket (rows) in each language, and of each language.
    log_probabilities: np.ndarray
    log_priors: np.ndarray


def _sampled(labelled: DataFrame, sample: int) -> tuple[DataFrame, dict[str, int]]:
    """About `sample` rows of each language of `labelled` (id, text, lang), and how many rows each has."""
    counts = labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).limit(MAX_LANGUAGES + 1).collect()
    if len(counts) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    rows = {r["lang"]: r["n"] for r in sorted(counts, key=lambda r: r["lang"].encode())}
    if not rows:
        return labelled, rows
    parts = [F.lit(x) for lang, n in rows.items() for x in (lang, min(1.0, sample / n))]
    place = F.pmod(F.xxhash64("id", F.length("text")), F.lit(1 << 30)) / float(1 << 30)
    return labelled.where(place < F.element_at(F.create_map(*parts), F.col("lang"))), rows


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE) -> LanguageModel:
    """Learns from the rows of `docs` with a text and a language."""
    bound_batches()
    labelled = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    chosen, rows = _sampled(labelled.where("text is not null and lang is not null"), sample)
    languages = list(rows)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((len(languages), BUCKETS), np.int64)
        number = {lang: i for i, lang in enumerate(languages)}
        for batch in batches:
            lang = np.array([number[x] for x in batch.column("lang").to_pylist()], np.int64)
            for at, texts, found in grams(batch.column("text"), WIDTHS, BITS):
                row = lang[at : at + texts] * BUCKETS
                for buckets, owner in found:
                    totals += np.bincount(row[owner] + buckets, minlength=totals.size).reshape(totals.shape)
        which, bucket = np.nonzero(totals)
        yield pa.record_batch({"lang": pa.array(which, pa.int32()), "bucket": pa.array(bucket, pa.int32()), "n": pa.array(totals[which, bucket])})

    counts = np.zeros((BUCKETS, max(len(languages), 1)))
    if languages:
        counted = chosen.select("text", "lang").mapInArrow(count, "lang int, bucket int, n long")
        added = counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
        counts[added["bucket"].to_numpy(), added["lang"].to_numpy()] = added["n"].to_numpy()
    logs = np.log((counts + SMOOTHING) / (counts.sum(axis=0) + SMOOTHING * BUCKETS)).astype(np.float32)
    priors = np.log(np.array(list(rows.values()), float) / max(sum(rows.values()), 1))
    return LanguageModel(languages, logs, priors)


def predict(docs: DataFrame, model: LanguageModel, text: Column) -> Column:
    """A struct (lang, score) for each text of `docs`."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = pa.struct([("lang", pa.string()), ("score", pa.float64())])

    def compute(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        logs, priors = shared.value.log_probabilities, shared.value.log_priors
        names = pa.array(shared.value.languages, pa.string())
        for batch in batches:
            scores = np.tile(priors, (len(batch), 1))
            for at, texts, found in grams(batch, WIDTHS, BITS):
                for buckets, owner in found:
                    scores[at : at + texts] += sums(logs[buckets], owner, texts)
            best = scores.argmax(axis=1) if len(batch) else np.zeros(0, np.int64)
            chance = 1 / np.exp(scores - scores.max(axis=1, keepdims=True)).sum(axis=1) if len(batch) else np.zeros(0)
            yield pa.StructArray.from_arrays([names.take(pa.array(best)), pa.array(chance)], fields=list(kind))

    nothing = F.struct(F.lit(UNKNOWN).alias("lang"), F.lit(0.0).alias("score"))
    if not model.languages:
        return nothing
    known = F.arrow_udf(compute, "lang string, score double")(text)
    return F.when(F.coalesce(text.rlike(r"\p{L}"), F.lit(False)), known).otherwise(nothing)


def identify(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of `docs`: its id, lang_pred and score."""
    made = docs.select(F.col(id_col), predict(docs, model, F.col(text_col)).alias("made"))
    return made.select(id_col, F.col("made.lang").alias("lang_pred"), F.col("made.score").alias("score"))


def keep_identified(docs: DataFrame, model: LanguageModel, least: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows of `docs` whose language is known with a score of at least `least`, with all their columns."""
    whole = docs.select(F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("doc"))
    made = whole.select("doc", predict(docs, model, F.col(f"doc.`{text_col}`")).alias("made"))
    return made.where((F.col("made.lang") != UNKNOWN) & (F.col("made.score") >= least)).select("doc.*")
