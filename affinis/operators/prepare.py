"""Interaction tables: one row per (user, item), indexes, counts.

The canonical schema is ``user BIGINT, item BIGINT, rate DOUBLE, ts``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinis.session import stack

LIST_SPAN = 4096
SKETCH_BITS = 14


def max_rate(interactions: DataFrame) -> DataFrame:
    """Best rate per (user, item), never below zero, with the first time seen."""
    return interactions.groupBy("user", "item").agg(
        F.greatest(F.lit(0.0), F.max("rate")).alias("rate"), F.min("ts").alias("ts")
    )


def distinct_interactions(interactions: DataFrame) -> DataFrame:
    return interactions.select("user", "item").distinct()


def members_index(interactions: DataFrame, key: str, member: str, span: int = LIST_SPAN) -> DataFrame:
    """Sorted member list per key, in segments of consecutive member ids.

    Segment ``s`` holds the members with ``floor(id / span) = s``, so no row
    and no task has to hold more than ``span`` members of a popular key; the
    segments of a key in order are its full sorted list.
    """
    segment = F.floor(F.col(member) / span).cast("bigint")
    members = F.array_sort(F.collect_set(member))
    return (
        interactions.groupBy(key, segment.alias("segment"))
        .agg(members.alias("_list"))
        .select(key, "segment", F.size("_list").alias("n"), F.concat_ws(",", F.col("_list").cast("array<string>")).alias(f"{member}s"))
    )


def distinct_sketches(interactions: DataFrame, by: Column, bits: int = SKETCH_BITS) -> DataFrame:
    """``(part, n_rows, users, items)`` for each value of ``by``: rows, and sketches of the distinct users and items.

    Sketches of parts that have been stored add up to those of all: a new day is one
    more row, and no other day is read again. The relative standard error is about 1.04 / sqrt(2^bits).
    """
    return interactions.groupBy(by.alias("part")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.hll_sketch_agg("user", F.lit(bits)).alias("users"),
        F.hll_sketch_agg("item", F.lit(bits)).alias("items"),
    )


def profile_of_sketches(sketches: DataFrame) -> DataFrame:
    """One row as ``dataset_profile``, but ``n_rows`` counts repeated rows and distinct counts are estimates."""
    estimate = lambda c: F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(c)), F.lit(0)).cast("bigint")
    rows = F.coalesce(F.sum("n_rows"), F.lit(0)).cast("bigint")
    return sketches.agg(rows.alias("n_rows"), estimate("users").alias("n_users"), estimate("items").alias("n_items"))


def dataset_profile(interactions: DataFrame) -> DataFrame:
    """One row: interactions, users, items.

    Each distinct count is its own two-step aggregate; counting several
    distinct columns in one pass would copy every row once per column.
    """
    zero = F.lit(0).cast("bigint")
    users = interactions.select("user").distinct().agg(F.count(F.lit(1)).alias("n_users"))
    items = interactions.select("item").distinct().agg(F.count(F.lit(1)).alias("n_items"))
    rows = interactions.agg(F.count(F.lit(1)).alias("n_rows"))
    parts = stack(
        rows.select("n_rows", zero.alias("n_users"), zero.alias("n_items")),
        users.select(zero, "n_users", zero),
        items.select(zero, zero, "n_items"),
    )
    return parts.agg(*[F.sum(c).alias(c) for c in ("n_rows", "n_users", "n_items")])
