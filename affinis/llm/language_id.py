"""Language identification as inference of a mixture of languages.

A model is a table of character trigram frequencies per language, counted over
all labelled documents with built-in aggregation (trigrams go to ``BUCKETS``
hash buckets, so a language has a fixed size). The trigrams of a document are
taken as drawn from a mixture of languages; expectation-maximisation estimates
the proportions. Languages enter the set in order of proportion as long as the
penalised likelihood gains; the document's language is the one with the largest
proportion in the set, its score is that proportion.

Defined cases: a text that is NULL or has no letter is ``und`` with score 0, as
are all texts if nothing was learned; ties go to the language that comes first;
documents without ``lang`` are not learned from; equal rows give equal results;
a very long text counts whole, as at most one number per bucket once it is counted; an empty table gives no rows; ``lang_pred`` and ``score`` replace columns of that
name, all others are kept.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 1 << 15
SMOOTHING = 0.5
UNKNOWN = "und"
#: Nats by which the likelihood of a further language has to gain, per trigram and logarithm of their number.
PENALTY = 0.02
#: Nats that it has to gain besides, and half the logarithm: a few trigrams are no evidence of a second language.
LEAST_GAIN = 3.0
ROUNDS = 12


def trigrams() -> Callable[[str | None], np.ndarray]:
    """Function from a text to the buckets of its trigrams of letters and word ends, in lower case."""
    other = re.compile(r"[\W\d_]+")
    factors = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)
    shift = np.uint64(64 - (BUCKETS.bit_length() - 1))

    def run(text: str | None) -> np.ndarray:
        words = other.sub(" ", text.lower()) if text else ""
        if not any(c.isalpha() for c in words):
            return np.empty(0, np.int64)
        codes = np.frombuffer(f" {words.strip()} ".encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
        mixed = codes[:-2] * factors[0] + codes[1:-1] * factors[1] + codes[2:] * factors[2]
        mixed ^= mixed >> np.uint64(29)
        return ((mixed * factors[0]) >> shift).astype(np.int64)

    return run


def held_out(doc_id: Column) -> Column:
    """A fixed quarter of the documents."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    cut = trigrams()
    held: dict[str, np.ndarray] = {}
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
            got = np.bincount(cut(text.as_py()), minlength=BUCKETS)
            held[lang] = held[lang] + got if lang in held else got
    for lang, counts in held.items():
        used = np.flatnonzero(counts)
        arrays = [pa.array([lang] * len(used)), pa.array(used, pa.int32()), pa.array(counts[used], pa.int64())]
        yield pa.RecordBatch.from_arrays(arrays, names=["lang", "bucket", "n"])


def learn(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages in order, and the log frequency of each bucket in each; from ``text`` and ``lang`` of ``docs``."""
    labelled = docs.where("lang is not null and text is not null").select("lang", "text")
    counts = labelled.mapInArrow(_counts, "lang string, bucket int, n bigint")
    table = counts.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()  # languages x BUCKETS rows at most
    names = sorted(table["lang"].unique())
    seen = np.zeros((len(names), BUCKETS))
    seen[table["lang"].map({n: i for i, n in enumerate(names)}).to_numpy(int), table["bucket"].to_numpy(int)] = table["n"]
    return names, np.log((seen + SMOOTHING) / (seen.sum(axis=1, keepdims=True) + SMOOTHING * BUCKETS))


def proportions(likelihood: np.ndarray, counts: np.ndarray, start: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, float]:
    """Mixture weights of the rows of ``likelihood`` for trigrams seen ``counts`` times, and the log likelihood."""
    weights, total = start, counts.sum()
    for _ in range(rounds):
        mixed = weights @ likelihood
        new = weights * (likelihood @ (counts / mixed)) / total
        done = np.abs(new - weights).max() < 1e-3
        weights = new
        if done:
            break
    return weights, float(counts @ np.log(weights @ likelihood))


def classifier(names: list[str], logs: np.ndarray) -> Callable[[str | None], tuple[str, float]]:
    """Function from a text to its main language and that one's proportion."""
    cut = trigrams()

    def run(text: str | None) -> tuple[str, float]:
        found = cut(text)
        if not len(found) or not names:
            return UNKNOWN, 0.0
        bucket, counts = np.unique(found, return_counts=True)
        logs_here = logs[:, bucket]
        likelihood = np.exp(logs_here - logs_here.max(axis=0))
        k = len(names)
        whole, _ = proportions(likelihood, counts, np.full(k, 1 / k))
        order = np.argsort(-whole, kind="stable")
        logarithm = np.log(len(found) + 1)
        penalty = LEAST_GAIN + 0.5 * logarithm + PENALTY * len(found) * logarithm / np.log(1000)
        chosen, weights = order[:1], np.ones(1)
        best = float(counts @ np.log(np.maximum(likelihood[order[0]], 1e-300)))
        for size in range(2, k + 1):
            start = whole[order[:size]] + 1e-6
            more, value = proportions(likelihood[order[:size]], counts, start / start.sum())
            if value - best < penalty:
                break
            chosen, weights, best = order[:size], more, value
        top = int(weights.argmax())
        return names[chosen[top]], float(min(1.0, weights[top]))

    return run


def guess(names: list[str], logs: np.ndarray):
    """Column function from a text to ``struct<lang_pred, score>``."""
    logs = logs.astype(np.float32)

    def predict(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        classify = classifier(names, logs.astype(np.float64))
        for batch in texts:
            yield pd.DataFrame([classify(t) for t in batch], columns=["lang_pred", "score"])

    return F.pandas_udf(predict, "lang_pred string, score double")


def identify(docs: DataFrame, names: list[str], logs: np.ndarray) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``; of the documents only ``text`` is looked at."""
    marked = docs.withColumn("_guess", guess(names, logs)("text"))
    return marked.withColumns({"lang_pred": F.col("_guess.lang_pred"), "score": F.col("_guess.score")}).drop("_guess")
