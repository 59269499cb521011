"""Ranked selection inside groups, and ranked lists as text or maps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_k(df: DataFrame, group: str | Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    """First ``k`` rows of every group under a total order, with their ``rank``.

    The rank filter sits directly on the window, so Spark plans a group limit
    on both sides of the shuffle: a task sends at most ``k`` rows per group,
    however large the group is.
    """
    keys = [group] if isinstance(group, str) else list(group)
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= k)


def best_first(score: str, tie: str) -> list[Column]:
    return [F.col(score).desc(), F.col(tie).asc()]


def ranked_list(topk: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """Per key the values in rank order as one comma-separated string."""
    ordered = F.array_sort(F.collect_list(F.struct("rank", value)))
    text = F.transform(ordered, lambda e: e[value].cast("string"))
    return topk.groupBy(key).agg(F.concat_ws(",", text).alias(name))


def ranked_map(topk: DataFrame, key: str, value: str, score: str, name: str) -> DataFrame:
    """Per key a map value -> score; entries are in rank order, at most k of them."""
    ordered = F.array_sort(F.collect_list(F.struct("rank", value, score)))
    entries = F.transform(ordered, lambda e: F.struct(e[value].alias("key"), e[score].alias("value")))
    return topk.groupBy(key).agg(F.map_from_entries(entries).alias(name))


def preview(df: DataFrame, order: Sequence[str | Column], n: int = 5) -> DataFrame:
    """The first ``n`` rows under an explicit order."""
    return df.orderBy(*order).limit(n)
