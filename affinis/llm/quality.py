"""Quality rules: gradient-boosted trees over document statistics.

The trees are fitted with numpy on at most ``MAX_TRAINING_ROWS`` labelled
documents (those with the smallest hashes of ``doc_id``), flattened into node
arrays, and score batches of documents level by level. For the features listed
in ``FEATURES`` with a sign, the score can only fall (-1) or rise (1) with the
feature, whatever the training data say.

Defined cases: a NULL or empty text has no words and fails the base rule; labels
that are NULL or belong to no document are passed over; several labels of a
document count as the best one; without labels of both classes every document
that passes the base rule is kept; equal rows give equal results; a very long
text is counted whole, in memory of some times its size; an empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_TRAINING_ROWS = 20_000
WINDOW = 8
SYMBOLS = b"#*$%&|<>"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FEATURES = {
    "log_words": 0,
    "mean_word": 0,
    "symbols_per_char": -1,
    "dup_line_share": -1,
    "repeat_share": -1,
    "distinct_share": 0,
    "top_word_share": -1,
    "upper_share": -1,
    "digit_share": -1,
    "exclamation_share": -1,
    "words_per_line": 0,
    "sentence_words": 0,
}


def repeated_words(ids: np.ndarray, window: int = WINDOW) -> int:
    """Words that lie in a window found twice or more; ``window`` is a power of two.

    Windows are named exactly: names of halves are paired and numbered again.
    """
    n = len(ids) - window + 1
    if n < 2:
        return 0
    names, width = ids.astype(np.int64), 1
    while width < window:
        pairs = names[:-width] * (int(names.max()) + 1) + names[width:]
        distinct, names = np.unique(pairs, return_inverse=True)
        if len(distinct) == len(pairs):
            return 0  # no repeat of this width, so none of a larger one
        width *= 2
    often = np.bincount(names)[names] > 1
    edges = np.zeros(len(ids) + 1, np.int64)
    np.add.at(edges, np.flatnonzero(often), 1)
    np.add.at(edges, np.flatnonzero(often) + window, -1)
    return int((np.cumsum(edges)[:-1] > 0).sum())


def statistics(data: bytes) -> tuple[list[int], list[float]]:
    """The counts and the features of a text in UTF-8."""
    words = data.split()  # bytes split at the six ASCII blanks only
    n = len(words)
    index: dict[bytes, int] = {}
    ids = np.fromiter((index.setdefault(w, len(index)) for w in words), np.int64, n)
    raw = np.frombuffer(data, np.uint8)
    histogram = np.bincount(raw, minlength=256)
    chars = int(len(raw) - histogram[128:192].sum() - histogram[9:14].sum() - histogram[32])
    symbols = int(sum(histogram[c] for c in SYMBOLS))
    lines = [x for x in data.split(b"\n") if x.strip()]
    repeated_lines = len(lines) - len(set(lines))
    repeats = repeated_words(ids)
    counts = [n, chars, symbols, repeated_lines, repeats]
    some, some_chars = max(n, 1), max(chars, 1)
    letters = max(1, int(histogram[65:91].sum() + histogram[97:123].sum()))
    ends = int(histogram[ord(".")] + histogram[ord("!")] + histogram[ord("?")])
    features = [
        float(np.log1p(n)),
        chars / some,
        symbols / some_chars,
        repeated_lines / max(len(lines), 1),
        repeats / some,
        len(index) / some,
        int(np.bincount(ids).max()) / some if n else 0.0,
        int(histogram[65:91].sum()) / letters,
        int(histogram[48:58].sum()) / some_chars,
        int(histogram[ord("!")]) / some_chars,
        n / max(len(lines), 1),
        n / (ends + 1),
    ]
    return counts, features


@dataclass(frozen=True)
class Trees:
    """All nodes of all trees one after the other; a leaf is its own child on both sides."""

    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    start: float
    depth: int

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Probability of the upper class for each row of ``x``."""
        at = np.tile(self.roots, (len(x), 1))
        rows = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            at = np.where(x[rows, self.feature[at]] <= self.threshold[at], self.left[at], self.right[at])
        return 1 / (1 + np.exp(-(self.start + self.value[at].sum(axis=1))))


def fit(
    x: np.ndarray,
    y: np.ndarray,
    signs: tuple[int, ...],
    trees: int = 40,
    depth: int = 3,
    rate: float = 0.2,
    bins: int = 32,
    ridge: float = 1.0,
    least_rows: int = 20,
) -> Trees | None:
    """Logistic boosting on binned features; None unless both classes are there.

    A split that runs against the sign of its feature is not taken, and what
    lies below a split is held on its side of the middle between the two halves.
    """
    if not len(y) or y.min() == y.max():
        return None
    n, width = x.shape
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(width)]
    binned = np.stack([np.searchsorted(edges[f], x[:, f], side="left") for f in range(width)], axis=1)
    offset = np.arange(width) * bins
    share = float(np.clip(y.mean(), 1e-3, 1 - 1e-3))
    start = float(np.log(share / (1 - share)))
    margin = np.full(n, start)
    feature, threshold, left, right, value, roots = [], [], [], [], [], []
    signs_of = np.array(signs)[:, None]

    def add() -> int:
        k = len(feature)
        for column, new in ((feature, 0), (threshold, 0.0), (left, k), (right, k), (value, 0.0)):
            column.append(new)
        return k

    def grow(rows: np.ndarray, level: int, low: float, high: float) -> int:
        k = add()
        g, h = gradient[rows], hessian[rows]
        weight = lambda a, b: np.clip(-a / (b + ridge), low, high)
        value[k] = float(weight(g.sum(), h.sum())) * rate
        if level == depth or len(rows) < 2 * least_rows:
            margin[rows] += value[k]
            return k
        keys = (binned[rows] + offset).ravel()
        sums = [
            np.bincount(keys, np.repeat(w, width), width * bins).reshape(width, bins).cumsum(axis=1)[:, :-1]
            for w in (g, h, np.ones(len(rows)))
        ]
        gl, hl, nl = sums
        gr, hr, nr = g.sum() - gl, h.sum() - hl, len(rows) - nl
        wl, wr = weight(gl, hl), weight(gr, hr)
        reached = lambda a, b, w: -(2 * a * w + (b + ridge) * w * w)
        gain = reached(gl, hl, wl) + reached(gr, hr, wr) - reached(g.sum(), h.sum(), weight(g.sum(), h.sum()))
        allowed = (nl >= least_rows) & (nr >= least_rows) & (signs_of * (wr - wl) >= 0)
        gain = np.where(allowed, gain, -np.inf)
        f, b = np.unravel_index(int(gain.argmax()), gain.shape)
        if not gain[f, b] > 1e-6 or b >= len(edges[f]):
            margin[rows] += value[k]
            return k
        down = binned[rows, f] <= b
        middle = (wl[f, b] + wr[f, b]) / 2
        sides = {0: ((low, high), (low, high)), 1: ((low, middle), (middle, high)), -1: ((middle, high), (low, middle))}[signs[f]]
        feature[k], threshold[k] = int(f), float(edges[f][b])
        left[k] = grow(rows[down], level + 1, *sides[0])
        right[k] = grow(rows[~down], level + 1, *sides[1])
        return k

    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        gradient, hessian = p - y, p * (1 - p)
        roots.append(grow(np.arange(n), 0, -np.inf, np.inf))
    arrays = [np.array(a) for a in (roots, feature, threshold, left, right, value)]
    inner = arrays[3] != np.arange(len(feature))
    arrays[5] = np.where(inner, 0.0, arrays[5])
    return Trees(*arrays, start, depth)


SCHEMA = "doc_id bigint, " + ", ".join(f"{c} bigint" for c in COUNTS) + ", features array<double>, score double"


def _measured(trees: Trees | None):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [statistics(t.as_py() or b"") for t in batch.column("text").cast(pa.large_binary())]
            if not rows:
                continue
            counts = np.array([r[0] for r in rows], np.int64)
            features = np.array([r[1] for r in rows])
            scores = np.ones(len(rows)) if trees is None else trees.scores(features)
            arrays = [batch.column("doc_id"), *(pa.array(c) for c in counts.T)]
            arrays += [pa.array(list(features), pa.list_(pa.float64())), pa.array(scores)]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", *COUNTS, "features", "score"])

    return run


def measure(docs: DataFrame, trees: Trees | None = None) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, the counts, the features, and the score of the trees (1 without trees)."""
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return texts.mapInArrow(_measured(trees), SCHEMA)


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAINING_ROWS) -> Trees | None:
    """Trees fitted on at most ``max_rows`` labelled documents."""
    judged = labels.where("doc_id is not null and quality is not null")
    judged = judged.groupBy(F.col("doc_id").cast("bigint").alias("id")).agg(F.max("quality").alias("quality"))
    sample = judged.orderBy(F.xxhash64("id"), "id").limit(max_rows)
    # the bound on the sample is what makes it small enough to send to every task
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    known = texts.join(F.broadcast(sample), F.col("doc_id") == F.col("id")).select("doc_id", "text")
    rows = measure(known).select("doc_id", "features").join(F.broadcast(sample), F.col("doc_id") == F.col("id"))
    rows = rows.select("doc_id", "features", "quality").orderBy(F.xxhash64("doc_id"), "doc_id", "features").limit(max_rows)
    rows = rows.collect()
    if not rows:
        return None
    x = np.array([r["features"] for r in rows])
    y = np.array([float(r["quality"] > 0) for r in rows])
    return fit(x, y, tuple(FEATURES.values()))


def judge(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, the counts, ``base_failed``, ``score`` and ``kept``."""
    measured = measure(docs, train(docs, labels)).drop("features")
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    measured = measured.withColumn("base_failed", failed)
    return measured.withColumn("kept", ~F.col("base_failed") & (F.col("score") >= threshold))
