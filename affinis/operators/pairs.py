"""Pairs of members that share a group, with bounded groups per task.

Both model families rest on this one step: items that share a user, and users
that share an item. Groups are collected into arrays of bounded length and the
pairs are unfolded from the array, so one shuffle on the group key is enough.

Every group is cut into blocks of about ``block_size`` members by a hash of the
member; a small group is one block. Each member goes to every block pair its
own block takes part in, so a hot group becomes many equally sized keys, each
of about two blocks, and no task ever sees the whole group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK_SIZE = 2048


def member_pairs(
    df: DataFrame,
    group: str | Sequence[str],
    member: str,
    payload: Sequence[str] = (),
    block_size: int = BLOCK_SIZE,
    inert: Column | None = None,
) -> DataFrame:
    """All ``(group, member_a < member_b)`` of a table unique on (group, member).

    Payload columns come along as ``<name>_a`` and ``<name>_b``. Members for
    which ``inert`` holds are not paired with each other, only with the rest;
    such pairs are never made.
    """
    keys = [group] if isinstance(group, str) else list(group)
    still = F.lit(False) if inert is None else F.coalesce(inert, F.lit(False))
    rows = df.select(*keys, member, *payload, still.alias("_inert"))
    blocked = spread(rows, keys, member, block_size)
    packed = pack(blocked, [*keys, "_low", "_high"], ["_inert", member, *payload, "_block"])
    pairs = unfold(packed, [*keys, "_low", "_high"], member, [*payload, "_block"])
    new_pair = (F.col("_low") == F.col("_high")) | (F.col("_block_a") != F.col("_block_b"))
    return pairs.where(new_pair).drop("_low", "_high", "_block_a", "_block_b")


def spread(rows: DataFrame, keys: list[str], member: str, block_size: int) -> DataFrame:
    """Each member once per block pair of its block; only groups of several blocks are in the table that is joined."""
    large = (
        rows.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_n"))
        .where(F.col("_n") > block_size)
        .select(*keys, F.ceil(F.col("_n") / block_size).cast("int").alias("_blocks"))
    )
    blocks = F.coalesce("_blocks", F.lit(1))
    placed = rows.join(large, keys, "left").withColumn("_block", F.pmod(F.xxhash64(member), blocks).cast("int"))
    meets = placed.withColumn("_other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    return (
        meets.withColumn("_low", F.least("_block", "_other"))
        .withColumn("_high", F.greatest("_block", "_other"))
        .drop("_blocks", "_other")
    )


def pack(
    rows: DataFrame, keys: list[str], fields: Sequence[str], carried: Sequence[Column] = (), width: int | None = None
) -> DataFrame:
    """Rows of a bounded group as one array, with further aggregates of the group.

    Gathering does not shrink rows, so it is done once, after the shuffle.
    """
    # A fixed partition count: the rows are few bytes but unfold into many pairs, so
    # partitions must not be merged for being small.
    width = width or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(width, *keys).groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(*fields))).alias("_members"), *carried)


def unfold(packed: DataFrame, keys: list[str], member: str, payload: Sequence[str]) -> DataFrame:
    """Pairs of an array whose elements are in order, inert ones last."""
    fields = [member, *payload]
    first = packed.where(F.size("_members") > 1).select(*keys, "_members", F.posexplode("_members").alias("_at", "_a"))
    first = first.where(~F.col("_a._inert"))
    rest = F.slice("_members", F.col("_at") + 2, F.size("_members"))
    second = first.select(*keys, "_a", F.explode(rest).alias("_b"))
    # a member comes before the inert ones whatever its id
    swap = F.col("_b._inert") & (F.col(f"_b.{member}") < F.col(f"_a.{member}"))
    side = lambda f, x, y: F.when(swap, F.col(f"{y}.{f}")).otherwise(F.col(f"{x}.{f}"))
    return second.select(
        *keys,
        *[side(f, "_a", "_b").alias(f"{f}_a") for f in fields],
        *[side(f, "_b", "_a").alias(f"{f}_b") for f in fields],
    )
