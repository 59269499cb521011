"""Train/test splits: contiguous folds, and n rows held out per user."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from affinis.operators.topk import top_k
from affinis.session import materialize

HISTORY_ORDER = ("ts", "item")
GLOBAL_ORDER = ("ts", "user", "item")


def range_table(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Range-partition by a total order and write the result, with the range number of each row.

    Range bounds are sampled, so they must not be drawn anew by a later stage.
    """
    ranges = df.repartitionByRange(*[F.col(c) for c in order]).withColumn("_range", F.spark_partition_id())
    return materialize(ranges, "ranges")


def number_rows(ranges: DataFrame, order: Sequence[str], name: str = "position") -> DataFrame:
    """1-based position of every row of a range table.

    A position is the rank inside the range plus the sizes of the ranges before
    it; one row per range takes part in that running total.
    """
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranges.groupBy("_range")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    )
    inside = Window.partitionBy("_range").orderBy(*order)
    return (
        ranges.withColumn("_row", F.row_number().over(inside))
        .join(F.broadcast(offsets), "_range")
        .withColumn(name, F.col("_row") + F.col("_offset"))
        .drop("_range", "_row", "_offset")
    )


def with_position(df: DataFrame, order: Sequence[str], name: str = "position") -> DataFrame:
    """1-based position of every row under a global order, without a global sort task."""
    return number_rows(range_table(df, order), order, name)


def k_fold(df: DataFrame, folds: int = 5, order: Sequence[str] = GLOBAL_ORDER) -> DataFrame:
    """Label every row with the fold (1..folds) whose test part it belongs to.

    Folds are contiguous in the global order and of equal size (the last may be
    shorter). The train part of fold f is every row with another label.
    """
    ranges = range_table(df, order)
    size = max(1, -(-ranges.count() // folds))
    fold = F.floor((F.col("position") - 1) / F.lit(size)).cast("int") + 1
    return number_rows(ranges, order).withColumn("fold", fold).drop("position")


def leave_n_keys(
    df: DataFrame, start: int, stop: int, max_test: int = 0, order: Sequence[str] = HISTORY_ORDER
) -> DataFrame:
    """(user, item) of each user's start-th to stop-th row; at most ``max_test`` in all if positive.

    Only the first ``stop`` rows of a user are ranked, so a very long history
    is cut down before it is shuffled.
    """
    held = top_k(df, "user", [F.col(c).asc() for c in order], stop).where(F.col("rank") >= start)
    if max_test > 0:
        held = with_position(held.drop("rank"), GLOBAL_ORDER).where(F.col("position") <= max_test)
    return held.select("user", "item")


def leave_n(
    df: DataFrame, start: int, stop: int, max_test: int = 0, order: Sequence[str] = HISTORY_ORDER
) -> DataFrame:
    """Every row labelled ``part`` = 'test' (held out) or 'train'."""
    held = leave_n_keys(df, start, stop, max_test, order).withColumn("_held", F.lit(True))
    part = F.when(F.col("_held"), "test").otherwise("train")
    return df.join(held, ["user", "item"], "left").withColumn("part", part).drop("_held")


def train_test(
    df: DataFrame, start: int, stop: int, max_test: int = 0, order: Sequence[str] = HISTORY_ORDER
) -> tuple[DataFrame, DataFrame]:
    """The two parts of ``leave_n`` as tables; the split is written once and read by both."""
    labelled = materialize(leave_n(df, start, stop, max_test, order), "split")
    parts = (labelled.where(F.col("part") == name).drop("part") for name in ("train", "test"))
    return tuple(parts)


def write_sorted(df: DataFrame, path: str) -> None:
    """Write in (user, item) order: ranges over files, sorted inside each file."""
    df.repartitionByRange("user", "item").sortWithinPartitions("user", "item").write.parquet(path)
