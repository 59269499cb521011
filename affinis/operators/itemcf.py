"""Item-to-item similarity from co-rated items.

Each model follows the same plan: attach what the score needs about an item to
its interaction rows (a join on the interactions, which are far fewer than the
pairs), and add up what the users of two items contribute, see ``pair_sums``. No
table with a row per pair is shuffled. Contributions are
summed exactly and divided by the norm of the pair.

Input is one row per (user, item), see ``prepare.max_rate``.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinis.functions.fixedpoint import exact_total
from affinis.operators.pair_sums import Combine, geometric_mean, pair_sums
from affinis.operators.pairs import BLOCK_SIZE, member_pairs
from affinis.operators.topk import best_first, top_k
from affinis.session import materialize


def item_weight(rates: DataFrame) -> DataFrame:
    """Weight of an item: the sum of its rates."""
    return rates.groupBy("item").agg(exact_total(F.col("rate")).alias("weight"))


def item_moments(rates: DataFrame) -> DataFrame:
    """Raters, sums, mean rate and squared deviation of every item.

    The deviation sums centred values. It is zero if and only if all raters
    agree, which is decided on the smallest and the largest rate.
    """
    sums = rates.groupBy("item").agg(
        F.count(F.lit(1)).alias("n"),
        exact_total(F.col("rate")).alias("total"),
        exact_total(F.col("rate") * F.col("rate")).alias("squares"),
        (F.min("rate") == F.max("rate")).alias("_flat"),
    )
    sums = sums.withColumn("mean", F.col("total") / F.col("n"))
    centred = rates.select("item", "rate").join(sums, "item").withColumn("_c", F.col("rate") - F.col("mean"))
    deviation = F.when(F.max("_flat"), 0.0).otherwise(exact_total(F.col("_c") * F.col("_c")))
    fixed = [F.max(c).alias(c) for c in ("n", "total", "squares", "mean")]
    return centred.groupBy("item").agg(*fixed, deviation.alias("deviation"))


def item_pairs(rates: DataFrame, payload: tuple[str, ...] = ("rate",), block_size: int = BLOCK_SIZE) -> DataFrame:
    """Every item pair of every basket, lower id first, with both sides' payload."""
    pairs = member_pairs(rates, "user", "item", payload, block_size)
    return pairs.withColumnsRenamed({"item_a": "item_i", "item_b": "item_j"})


def cooccurrence(interactions: DataFrame, min_support: int = 1, block_size: int = BLOCK_SIZE) -> DataFrame:
    """Number of users that have both items, for pairs with at least ``min_support``.

    An item with fewer users is in no such pair and is left out before pairs are made.
    """
    if min_support > 1:
        users = interactions.groupBy("item").agg(F.count(F.lit(1)).alias("_users")).where(F.col("_users") >= min_support)
        interactions = interactions.join(users, "item", "left_semi")
    counts = pair_sums(interactions, "user", "item", block_size=block_size).withColumnRenamed("value", "co")
    return counts.where(F.col("co") >= min_support) if min_support > 1 else counts


def overlap(rates: DataFrame, block_size: int = BLOCK_SIZE) -> DataFrame:
    """Sum over shared users of the smaller of both rates."""
    return pair_sums(rates, "user", "item", ("rate",), np.minimum, block_size=block_size).withColumnRenamed("value", "overlap")


def scored_by_weight(rates: DataFrame, combine: Combine, block_size: int = BLOCK_SIZE, best: int | None = None) -> DataFrame:
    """Summed contributions of shared users over the geometric mean of both weights."""
    weights = item_weight(rates).where(F.col("weight") > 0)
    weighted = materialize(rates.select("user", "item", "rate").join(weights, "item"), "weighted")
    sums = pair_sums(weighted, "user", "item", ("rate", "weight"), combine, geometric_mean, best, block_size)
    return sums.withColumnRenamed("value", "sim")


def cosine(rates: DataFrame, block_size: int = BLOCK_SIZE, best: int | None = None) -> DataFrame:
    """Overlap of two items over the geometric mean of their weights.

    Items of weight zero have no defined similarity and form no pair. ``best``
    is the number of neighbours that are wanted of an item: pairs then come in both
    directions, for ``neighbours(directed=True)``, without rows that cannot be among them.
    """
    return scored_by_weight(rates, np.minimum, block_size, best)


def raw_product(rates: DataFrame, block_size: int = BLOCK_SIZE, best: int | None = None) -> DataFrame:
    """Uncentred product form: sum of rate products over the same norm as ``cosine``."""
    return scored_by_weight(rates, np.multiply, block_size, best)


def pearson(rates: DataFrame, block_size: int = BLOCK_SIZE, best: int | None = None) -> DataFrame:
    """Products of centred rates over shared users, over the deviation of all raters.

    Items whose raters all agree have no deviation and form no pair. ``best`` is as in ``cosine``.
    """
    moments = item_moments(rates).where(F.col("deviation") > 0)
    moments = moments.select("item", F.col("n").cast("double").alias("n"), "total", F.sqrt("deviation").alias("spread"))
    # written, since the pairs are counted before they are made
    rated = materialize(rates.select("user", "item", "rate").join(moments, "item"), "rated")
    # whole rates, numbers and totals are fewer bytes than centred rates
    centred = lambda rate, n, total, spread: (rate - total / n, spread)
    sums = pair_sums(rated, "user", "item", ("rate", "n", "total", "spread"), np.multiply, np.multiply, best, block_size, of=centred)
    return sums.withColumnRenamed("value", "sim")


def symmetric(sims: DataFrame, score: str = "sim") -> DataFrame:
    """Both directions of a table of unordered pairs, in one pass over it.

    A union of the table with its mirror image would aggregate all pairs twice.
    """
    i, j = F.col("item_i"), F.col("item_j")
    ends = F.array(F.struct(i.alias("a"), j.alias("b")), F.struct(j.alias("a"), i.alias("b")))
    return sims.select(score, F.explode(ends).alias("_e")).select(
        F.col("_e.a").alias("item_i"), F.col("_e.b").alias("item_j"), score
    )


def neighbours(sims: DataFrame, k: int = 20, directed: bool = False) -> DataFrame:
    """Similarity model: the ``k`` best neighbours of every item, ties by lower id; ``directed`` tables list both directions."""
    return top_k(sims if directed else symmetric(sims), "item_i", best_first("sim", "item_j"), k)
