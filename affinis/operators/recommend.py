"""Recommendations from a similarity model and the users' histories."""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinis.functions.fixedpoint import from_units, to_units
from affinis.functions.planes import mixed
from affinis.operators.pair_sums import BATCH, BLOBS, DEALT_ENTRIES, HELD_PAIRS, TASK_PAIRS, Lists, hopeful, pair_order, read_lists
from affinis.session import materialize, materialize_in_turn, remove

cloudpickle.register_pickle_by_value(sys.modules[__name__])

RECOMMENDATIONS = 100
#: Scores are summed as whole numbers of 1e-10 in two parts, which cannot overflow.
_LOW_BITS = 20
#: Neighbours of a pass, and passes at most.
PASS_ENTRIES, MOST_TURNS = 1 << 25, 16
#: Users of an item in a row, about.
ROW_USERS = 1 << 13


def recommend(
    history: DataFrame,
    model: DataFrame,
    n: int = RECOMMENDATIONS,
    exclude_seen: bool = False,
    pass_entries: int = PASS_ENTRIES,
) -> DataFrame:
    """Top ``n`` items per user by the summed similarity to the items of its history.

    ``history`` is unique on (user, item). Users of an item are packed, a popular item's in several rows, and its
    neighbours are joined to them once: no row per history row and neighbour is made by the join. An item's neighbours go to
    the user's task as a list (see ``pair_sums``); there they are summed and the best are chosen. With more than ``pass_entries`` of these, users are
    dealt into passes over the joined rows and the result is a written table, so the disk holds the lists of one pass only.
    """
    links = F.array_sort(F.collect_list(F.struct("item_j", to_units(F.col("sim")).alias("units"))))
    lists = model.groupBy(F.col("item_i").alias("item")).agg(links.alias("_members"))
    counts = history.groupBy("item").agg(F.count(F.lit(1)).alias("_n"))
    rows, most = counts.agg(F.sum("_n"), F.max("_n")).first()
    items, found = model.agg(F.approx_count_distinct("item_i"), F.count(F.lit(1))).first()
    entries = int(rows or 0) * (1 + found // max(items, 1))
    passes = max(1, min(MOST_TURNS, -(-entries // pass_entries)))
    segment, seen = F.lit(0), history.select("user", "item")
    if (most or 0) > ROW_USERS:
        seen = seen.join(counts, "item")
        segment = F.pmod(F.xxhash64("user"), F.ceil(F.col("_n") / ROW_USERS))
    users = seen.groupBy("item", segment.alias("_segment")).agg(F.collect_list("user").alias("_users"))
    none = F.array().cast("array<struct<item_j:bigint,units:bigint>>")
    packed = users.join(lists, "item", "left" if exclude_seen else "inner").select("item", "_users", F.coalesce("_members", none).alias("_members"))
    width = max(passes * int(history.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-entries // TASK_PAIRS))
    if passes <= 1:
        return _ranked(packed, n, exclude_seen, width, 0, 1)
    packed = materialize(packed, "neighbours")
    recommended = materialize_in_turn((_ranked(packed, n, exclude_seen, width, nth, passes) for nth in range(passes)), "recommended")
    remove(packed)
    return recommended


def _ranked(packed: DataFrame, n: int, exclude_seen: bool, width: int, nth: int, passes: int) -> DataFrame:
    """The best ``n`` items of each user of every ``passes``-th of ``width`` tasks, from ``nth`` on."""
    dealt = packed.mapInArrow(_dealer(width, nth, passes), BLOBS).repartitionById(len(range(nth, width, passes)), F.col("_to"))
    best = dealt.mapInArrow(_ranker(n, exclude_seen), "user bigint, item bigint, high bigint, low bigint, rank int")
    wide = lambda c: F.col(c).cast("decimal(38,0)")
    units = (wide("high") * F.lit(1 << _LOW_BITS).cast("decimal(10,0)") + wide("low")).cast("decimal(38,0)")
    return best.select("user", "item", from_units(units).alias("score"), "rank")


def _dealer(width: int, nth: int = 0, passes: int = 1):
    """Function from ``(item, users, neighbours of the item)`` to the lists for each task of a pass."""

    def lengths(column: pa.ListArray) -> np.ndarray:
        return column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            item, users, links = (batch.column(c) for c in ("item", "_users", "_members"))
            item, seen, met = item.to_numpy(), lengths(users), lengths(links)
            user, row = users.flatten().to_numpy(), np.repeat(np.arange(len(seen)), seen)
            to = (mixed(user) % np.uint64(width)).astype(np.int64)
            if passes > 1:
                now = np.flatnonzero(to % passes == nth)
                user, row, to = user[now], row[now], to[now] // passes
            if not len(user):
                continue
            begin = np.cumsum(met) - met
            ids, units = (c.to_numpy() for c in links.flatten().flatten())
            piece = np.cumsum(met[row] + 1) // DEALT_ENTRIES
            for chosen in np.split(np.arange(len(row)), np.flatnonzero(np.diff(piece)) + 1):
                chosen = chosen[np.argsort(to[chosen], kind="stable")]
                rows = row[chosen]
                sizes = met[rows]
                at = np.arange(sizes.sum()) + np.repeat(begin[rows] - np.cumsum(sizes) + sizes, sizes)
                yield from Lists(sizes, [user[chosen], item[rows]], ids[at], [units[at]]).blobs(to[chosen])

    return run


def _ranker(n: int, exclude_seen: bool):
    """Function from lists to the best ``n`` items of every user."""

    def fold(parts: list[list[np.ndarray]]) -> list[np.ndarray]:
        a, b, *sums = (np.concatenate(c) for c in zip(*parts))
        order, begin = pair_order(a, b)
        first = order[begin]
        return [a[first], b[first], *(np.add.reduceat(s[order], begin) for s in sums)]

    def parted(rows: list[np.ndarray]) -> list[np.ndarray]:
        user, item, units, *seen = rows
        return [user, item, units >> _LOW_BITS, units & ((1 << _LOW_BITS) - 1), *seen]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[list[np.ndarray]] = []
        held: list[list[np.ndarray]] = []
        waiting, largest = 0, 0
        for lists in read_lists(batches, 2, 1):
            rows = [lists.of_entries(0), lists.ids, lists.entries[0]]
            if exclude_seen:
                zeros = np.zeros(len(lists.sizes), np.int64)
                seen = [lists.own[0], lists.own[1], zeros, zeros + 1]
                rows = [np.concatenate(c) for c in zip([*rows, np.zeros(len(rows[0]), np.int64)], seen)]
            if len(rows[0]):
                held.append(rows)
                waiting += len(rows[0])
                largest = max(largest, int(rows[2].max()), -int(rows[2].min()))
            if waiting > HELD_PAIRS:
                kept, held, waiting = [fold([*kept, *map(parted, held)])], [], 0
        if not kept and largest * waiting < 1 << 62:  # sums fit one number
            if not held:
                return
            user, item, units, *seen = fold(held)
            high, low = units >> _LOW_BITS, units & ((1 << _LOW_BITS) - 1)
        else:
            user, item, high, low, *seen = fold([*kept, *map(parted, held)])
            high, low = high + (low >> _LOW_BITS), low & ((1 << _LOW_BITS) - 1)
        if seen:
            user, item, high, low = (c[seen[0] == 0] for c in (user, item, high, low))
        if len(user):  # rows of a user are together
            some = hopeful(np.flatnonzero(np.append(True, user[1:] != user[:-1])), high, n)
            user, item, high, low = (c[some] for c in (user, item, high, low))
        order = np.lexsort((item, -low, -high, user))
        begin = np.flatnonzero(np.append(True, user[order][1:] != user[order][:-1])) if len(user) else np.zeros(0, np.int64)
        rank = np.arange(len(user)) - np.repeat(begin, np.diff(np.append(begin, len(user)))) + 1
        best, rank = order[rank <= n], rank[rank <= n].astype(np.int32)
        out = [c[best] for c in (user, item, high, low)]
        for at in range(0, len(best), BATCH):
            arrays = [pa.array(c[at : at + BATCH]) for c in (*out, rank)]
            yield pa.RecordBatch.from_arrays(arrays, names=["user", "item", "high", "low", "rank"])

    return run
