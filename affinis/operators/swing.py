"""Swing similarity: two items are close when user pairs that share them share little else.

``s(i, j)`` sums ``1 / (alpha + k(u, v))`` over all user pairs that have both
items, ``k`` being the number of items the two users share. Instead of joining
item pairs with user pairs, the shared items of each user pair are gathered
once: their count is ``k`` and their pairs are the contributions.

Items that a good part of all users have are packed into words of bits, and users into
blocks. Most users have some popular item in common, so what they share of these is not made into
rows: a pair of blocks is one task, in which counts of common bits and what they give to item
pairs are products of matrices (``dense_terms``). Only users who also share an item that is not popular
meet in rows; these give what the other items add, and what they change of the first sums.

Each user has a *top*: the item of its history that most users have, under one
order of all items. At a word, users who have only their top of it are not
paired with each other. Two users with two shared items still meet, as only one
shared item can be the top of both; their tops tell whether one more is shared.
So the most popular items, whose users mostly have them as their top, are not
enumerated, and there is no limit on how many items that is.
"""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from affinis.functions.fixedpoint import UNITS, exact_sum, to_units
from affinis.operators.itemcf import symmetric
from affinis.operators.pair_sums import BATCH, TASK_PAIRS, dealt_lists, pair_groups, pair_order, pair_sums, read_lists
from affinis.operators.pairs import BLOCK_SIZE, member_pairs
from affinis.operators.prepare import LIST_SPAN
from affinis.session import materialize, stack

cloudpickle.register_pickle_by_value(sys.modules[__name__])

_USERS = ["user_a", "user_b"]
#: Bits of a word, and the part of all users from which on an item is one: below, pairing users by word makes more rows.
WORD, DENSE_SHARE = 64, 8
#: Rows of a task that finds tops, and rows from which the best are chosen at once.
TASK_ROWS = 1 << 20
#: Rows of a product of bit matrices, and products that a task holds.
PRODUCT_ROWS, HELD_PRODUCTS = 10_000, 1_000
#: Users of the smallest block, of a slice of it that is multiplied at once, pairs of blocks of a task, and how far whole doubles are exact.
DENSE_BLOCK, PRODUCT_USERS, TASK_BLOCKS, EXACT = 256, 256, 16, 2.0**53


def user_cooccurrence(baskets: DataFrame, block_size: int = BLOCK_SIZE) -> DataFrame:
    """Number of shared items for every user pair that shares one."""
    sums = pair_sums(baskets, "item", "user", block_size=block_size)
    return sums.withColumnsRenamed({"item_i": "user_u", "item_j": "user_v", "value": "k"})


def shared_users(baskets: DataFrame, block_size: int = BLOCK_SIZE, span: int = LIST_SPAN) -> DataFrame:
    """Users that have both items, per item pair, in segments of consecutive user ids."""
    return pair_groups(baskets, "user", "item", span, block_size).select(
        "item_i",
        "item_j",
        "segment",
        F.size("groups").alias("n"),
        F.concat_ws(",", F.col("groups").cast("array<string>")).alias("users"),
    )


def item_counts(baskets: DataFrame) -> DataFrame:
    """``(item, _n)``: users of each item; written, as several steps read it."""
    return materialize(baskets.groupBy("item").agg(F.count(F.lit(1)).alias("_n")), "item-counts")


def item_words(baskets: DataFrame, counts: DataFrame, share: int = DENSE_SHARE) -> DataFrame | None:
    """``(item, word, bit)`` of the items that more than about one in ``share`` users have; None if there are none.

    There are at most some ``share`` times as many as a history is long on average, so one task numbers them.
    """
    users = baskets.agg(F.approx_count_distinct("user")).first()[0]
    popular = counts.where(F.col("_n") * share > users)
    if popular.isEmpty():
        return None
    place = F.row_number().over(Window.orderBy("item")) - 1
    placed = popular.select("item", place.alias("_place"))
    word, bit = F.floor(F.col("_place") / WORD).alias("word"), (F.col("_place") % WORD).cast("int").alias("bit")
    return materialize(placed.select("item", word, bit), "words")


def user_words(baskets: DataFrame, counts: DataFrame, words: DataFrame | None, payload: Sequence[str] = ()) -> DataFrame:
    """``(user, dense, word, bits, is_top, top)``: what each user has of each word, and its top.

    A popular item is a bit of a dense word, any other item is a word of its own with one bit.
    ``top`` is the most popular item of the user's history, or NULL if the user
    has a second item of its word; ``is_top`` marks that word. Columns of ``payload`` belong to the user.
    """
    if words is None:
        return _tops(baskets, counts, payload)
    placed = baskets.join(counts, "item")
    one, best = F.lit(1).cast("bigint"), F.struct("_n", "item").alias("_best")
    single = placed.join(words, "item", "left_anti")
    rows = single.select("user", *payload, F.lit(False).alias("dense"), F.col("item").alias("word"), one.alias("bits"), best)
    mask = F.call_function("shiftleft", one, F.col("bit"))
    dense = placed.join(words, "item").groupBy("user", *payload, "word")
    dense = dense.agg(F.bit_or(mask).alias("bits"), F.max(F.struct("_n", "item")).alias("_best"))
    rows = stack(rows, dense.select("user", *payload, F.lit(True), "word", "bits", "_best"))
    tops = rows.groupBy("user").agg(F.max(F.struct("_best", "bits")).alias("_t"))
    alone = F.bit_count("_t.bits") == 1
    tops = tops.select(F.col("user"), F.when(alone, F.col("_t._best.item")).alias("top"))
    is_top = F.coalesce(F.col("_best.item") == F.col("top"), F.lit(False)).alias("is_top")
    return rows.join(tops, "user").select("user", *payload, "dense", "word", "bits", is_top, "top")


def _tops(baskets: DataFrame, counts: DataFrame, payload: Sequence[str]) -> DataFrame:
    """``user_words`` if every word is one item: a task has all items of its users."""
    placed = baskets.select("user", "item", *payload).join(counts, "item").select("user", *payload, F.col("item").alias("word"), "_n")
    width = max(int(baskets.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-(counts.agg(F.sum("_n")).first()[0] or 0) // TASK_ROWS))
    kinds = {f.name: f.dataType.simpleString() for f in placed.schema}
    schema = [*(f"{c} {kinds[c]}" for c in ("user", *payload, "word")), "top bigint", "is_top boolean"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(list(batches)).combine_chunks() if (batches := list(batches)) else None
        if rows is None or not rows.num_rows:
            return
        user, item, n = (rows.column(c).to_numpy() for c in ("user", "word", "_n"))
        order = np.lexsort((item, n, user))
        last = np.append(user[order][1:] != user[order][:-1], True)
        best = item[order][last]
        top = np.empty(len(user), np.int64)
        top[order] = np.repeat(best, np.diff(np.append(-1, np.flatnonzero(last))))
        rows = rows.drop_columns(["_n"]).append_column("top", pa.array(top)).append_column("is_top", pa.array(item == top))
        yield from rows.to_batches(BATCH)

    found = placed.repartition(width, "user").mapInArrow(run, ", ".join(schema))
    one = F.lit(1).cast("bigint").alias("bits")
    return found.select("user", *payload, F.lit(False).alias("dense"), "word", one, "is_top", "top")


def shared_words(
    baskets: DataFrame, counts: DataFrame, words: DataFrame | None, payload: Sequence[str] = (), block_size: int = BLOCK_SIZE
) -> DataFrame:
    """One row per two users that share two items or more: ``user_a < user_b, k``, payload of both, and ``words``.

    ``words`` holds the bits that both have of each word. Users meet once per word,
    not once per item, so two users with hundreds of popular items in common meet
    a few times. At a word, users who have nothing of it but their top are not paired
    with each other: they share one item there at most, their tops tell which, and with two shared
    items they meet at another word. Where no item is popular, users meet in lists, see ``linked_users``.
    """
    members = user_words(baskets, counts, words, payload)
    if words is None:
        return linked_users(materialize(members, "members"), payload, block_size)
    keys, carried = ["dense", "word"], ["bits"]
    links = member_pairs(members, keys, "user", [*carried, "top", *payload], block_size, F.col("is_top"))
    sides = [f"{p}_{side}" for p in payload for side in "ab"]
    both = F.when(F.col("top_a") == F.col("top_b"), F.col("top_a")).alias("_both")
    shared = F.col("bits_a").bitwiseAND(F.col("bits_b")).alias("bits")
    links = links.select(*_USERS, *keys, shared, both, *sides).where("bits <> 0")
    gathered = links.groupBy(*_USERS).agg(
        F.collect_list(F.struct(*keys, *carried)).alias("_links"),
        F.sum(F.bit_count("bits")).cast("int").alias("_k"),
        F.max("_both").alias("_both"),
        *[F.max(c).alias(c) for c in sides],
    )
    gathered = gathered.withColumn("k", F.col("_k") + F.col("_both").isNotNull().cast("int")).where("k > 1")
    entry = lambda dense, word, bits: F.struct(dense.alias("dense"), word.alias("word"), bits.alias("bits"))
    none, one = F.lit(False), F.lit(1).cast("bigint")
    gathered = gathered.join(words.withColumnRenamed("item", "_both"), "_both", "left")
    mask = F.call_function("shiftleft", one, F.col("bit"))
    top = F.when(F.col("word").isNull(), entry(none, F.col("_both"), one)).otherwise(entry(~none, F.col("word"), mask))
    found = F.col("_links")
    everything = F.when(F.col("_both").isNull(), found).otherwise(F.concat(found, F.array(top)))
    return gathered.select(*_USERS, *sides, "k", F.array_sort(everything).alias("words"))


def linked_users(members: DataFrame, payload: Sequence[str], block_size: int, task_pairs: int = TASK_PAIRS) -> DataFrame:
    """``shared_words`` if every word is one item.

    Users meet in lists (``dealt_lists``) that name their tops, all of two users in one task; only those who share
    two items leave it, so the many pairs that share one item are no rows.
    """
    carried = ("top", *payload)
    lists = dealt_lists(members, "word", "user", carried, False, block_size, task_pairs, inert="is_top")
    kinds = {f.name: f.dataType.simpleString() for f in members.schema}
    sides = [f"{p}_{side}" for p in payload for side in "ab"]
    schema = ["user_a bigint", "user_b bigint", *(f"{c} {kinds[c[:-2]]}" for c in sides), "k int", "items array<bigint>"]
    found = lists.mapInArrow(_linker(len(payload), sides), ", ".join(schema))
    entry = lambda item: F.struct(F.lit(False).alias("dense"), item.alias("word"), F.lit(1).cast("bigint").alias("bits"))
    return found.select(*_USERS, *sides, "k", F.transform("items", entry).alias("words"))


def _linker(payload: int, sides: list[str]):
    """Function from lists of users at an item to two users that share two items or more, with these items in order."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for lists in read_lists(batches, 3 + payload, 1 + payload):
            both = [c for i in range(1 + payload) for c in (lists.of_entries(2 + i), lists.entries[i])]
            held.append([lists.of_entries(0), lists.ids, lists.of_entries(1), *both])
        if not held:
            return
        a, b, item, top_a, top_b, *rest = (np.concatenate(c) for c in zip(*held))
        del held
        order, begin = pair_order(a, b)
        first, links = order[begin], np.diff(np.append(begin, len(order)))
        # at their common top, two users do not meet
        same = top_a[first] == top_b[first]
        keep = links + same > 1
        rows, first, same, links = order[np.repeat(keep, links)], first[keep], same[keep], links[keep]
        pair = np.concatenate([np.repeat(np.arange(len(first)), links), np.flatnonzero(same)])
        items = np.concatenate([item[rows], top_a[first[same]]])
        items, k = items[np.lexsort((items, pair))], (links + same).astype(np.int32)
        ends = np.cumsum(k)
        for at in range(0, len(first), BATCH):
            cut = slice(at, at + BATCH)
            offsets = np.append(ends[cut] - k[cut], ends[cut][-1])
            shared = pa.ListArray.from_arrays(pa.array(offsets - offsets[0], pa.int32()), pa.array(items[offsets[0] : offsets[-1]]))
            columns = [a[first[cut]], b[first[cut]], *(c[first[cut]] for c in rest), k[cut]]
            yield pa.RecordBatch.from_arrays([*map(pa.array, columns), shared], names=[*_USERS, *sides, "k", "items"])

    return run


def user_masks(members: DataFrame, words: DataFrame, payload: Sequence[str] = ()) -> DataFrame:
    """``(user, masks)`` and payload of users with popular items: their bits of every word, in order of words."""
    n = words.agg(F.max("word")).first()[0] + 1
    has = F.map_from_entries(F.collect_list(F.struct("word", "bits")))
    mask = lambda w: F.coalesce(F.try_element_at("_has", w), F.lit(0).cast("bigint"))
    masks = F.transform(F.sequence(F.lit(0).cast("bigint"), F.lit(n - 1).cast("bigint")), mask)
    return members.where("dense").groupBy("user", *payload).agg(has.alias("_has")).select("user", *payload, masks.alias("masks"))


def dense_terms(masks: DataFrame, words: DataFrame, alpha: float, payload: Sequence[str] = (), block_size: int = BLOCK_SIZE) -> DataFrame:
    """``(item_i, item_j, units, n)`` of popular items in any number of rows per item pair, as if users shared no other items.

    Users are dealt into blocks by hash. A pair of blocks is worked on at one place, and what leaves a task are sums of item
    pairs, so user pairs are counted with and never written. A task holds a few blocks and two numbers per pair of popular items.
    """
    spark = masks.sparkSession
    users, least = masks.count(), int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks = max(1, -(-users // max(1, min(block_size, max(DENSE_BLOCK, users // least)))))
    keys = blocks * (blocks + 1) // 2
    width = max(min(keys, 4 * least), -(-keys // TASK_BLOCKS))
    held = F.collect_list(F.struct("masks", *payload)).alias("_held")
    packed = masks.groupBy(F.pmod(F.xxhash64("user"), F.lit(blocks)).alias("block")).agg(held)
    columns = ["block", F.flatten("_held.masks").alias("masks"), *[F.col(f"_held.{c}").alias(c) for c in payload]]
    packed = materialize(packed.select(*columns), "user-blocks")
    other = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(blocks - 1).cast("bigint"))).alias("_other")
    met = packed.select("*", other).withColumn("_high", F.greatest("block", "_other"))
    place = F.expr("_high * (_high + 1) div 2") + F.least("block", "_other")
    # small to send but much work, and evenly dealt out
    dealt = met.withColumn("_pair", place).drop("_high").repartitionById(width, (F.col("_pair") % width).cast("int"))
    n_words = words.agg(F.max("word")).first()[0] + 1
    sums = dealt.mapInArrow(_block_products(n_words, alpha, tuple(payload)), "place_a int, place_b int, units bigint, n bigint")
    for x in "ab":
        named = words.select((F.col("word") * WORD + F.col("bit")).cast("int").alias(f"place_{x}"), F.col("item").alias(f"item_{x}"))
        sums = sums.join(named, f"place_{x}")
    return sums.select(F.least("item_a", "item_b").alias("item_i"), F.greatest("item_a", "item_b").alias("item_j"), "units", "n")


def _half_up(values: np.ndarray) -> np.ndarray:
    """Whole numbers next to values of at least zero, as ``F.round`` gives them."""
    whole = np.floor(values)
    return whole + (values - whole >= 0.5)


def _block_products(words: int, alpha: float, payload: tuple[str, ...]):
    """Function from blocks of users to sums per pair of popular items over all pairs of users of two blocks (or of one).

    All sums of doubles are of whole numbers and below 2^53, so they are exact.
    """
    size = words * WORD

    def units_of(shared: np.ndarray, a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
        if not payload:
            table = _half_up(1.0 / (alpha + np.arange(2, size + 1)) * UNITS)
            return np.concatenate([[0.0, 0.0], table])[shared.astype(np.int64)]
        strength = a[0][:, None] * b[0][None, :]
        shares = shared > 1
        return np.where(shares, _half_up(strength / np.where(shares, alpha + shared, 1.0) * UNITS), 0.0)

    def add(total: np.ndarray, left: tuple, right: tuple, same: bool) -> None:
        (a, *of_a), (b, *of_b) = left, right
        narrow = b.astype(np.float32).T  # counts are small
        begin, rows = 0, PRODUCT_USERS
        while begin < len(a):
            some = a[begin : begin + rows]
            units = units_of(some.astype(np.float32) @ narrow, [c[begin : begin + rows] for c in of_a], of_b)
            if same:
                units = np.triu(units, begin + 1)
            most = units.max(initial=0.0) * len(b)
            if most * len(some) > EXACT and len(some) > 1:
                rows = max(1, int(EXACT // most))
                continue
            for i in range(size - 1):
                mine, other = np.flatnonzero(some[:, i]), np.flatnonzero(b[:, i])
                if len(mine) and len(other):
                    sums = units[np.ix_(mine, other)] @ b[other, i + 1 :]
                    total[i, i + 1 :] += (some[mine, i + 1 :] * sums).sum(axis=0).astype(np.int64)
            begin += len(some)

    def count(bits: np.ndarray) -> np.ndarray:
        return (bits.T @ bits).astype(np.int64)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[int, tuple] = {}
        total, n = np.zeros((size, size), np.int64), np.zeros((size, size), np.int64)
        for batch in batches:
            for row in range(batch.num_rows):
                values = lambda c: batch.column(c)[row].values.to_numpy()  # noqa: B023, E731
                block, other, pair = (batch.column(c)[row].as_py() for c in ("block", "_other", "_pair"))
                mine = (_bits(values("masks")).reshape(-1, size), *map(values, payload))
                if block == other:
                    add(total, mine, mine, True)
                    users = count(mine[0])
                    n += users * (users - 1) // 2
                elif pair in waiting:
                    met = waiting.pop(pair)
                    add(total, met, mine, False)
                    n += count(met[0]) * count(mine[0])
                else:
                    waiting[pair] = mine
        i, j = np.nonzero(np.triu(n, 1))
        if len(i):
            columns = [i.astype(np.int32), j.astype(np.int32), total[i, j], n[i, j]]
            yield pa.RecordBatch.from_arrays([*map(pa.array, columns)], names=["place_a", "place_b", "units", "n"])

    return run


def partly_popular(members: DataFrame, masks: DataFrame, payload: Sequence[str] = (), block_size: int = BLOCK_SIZE) -> DataFrame:
    """Rows of ``shared_words`` of two users that share an item which is not popular, with ``k_dense``, how many popular ones they share."""
    known = masks.select("user", "masks")
    # who has a popular item has one as top, and the bits tell which popular items are shared
    rows = members.where(~F.col("dense")).join(known, "user", "left").withColumn("top", F.when(F.col("masks").isNull(), F.col("top")))
    links = member_pairs(rows, "word", "user", ["top", "masks", *payload], block_size, F.col("is_top"))
    both = F.when(F.col("top_a") == F.col("top_b"), F.col("top_a"))
    sides = [f"{p}_{side}" for p in payload for side in "ab"]
    gathered = links.groupBy(*_USERS).agg(
        F.collect_list("word").alias("_items"),
        F.max(both).alias("_both"),
        *[F.first(c).alias(c) for c in ("masks_a", "masks_b")],
        *[F.max(c).alias(c) for c in sides],
    )
    none = F.array().cast("array<bigint>")
    shared = F.coalesce(F.zip_with("masks_a", "masks_b", lambda x, y: x.bitwiseAND(y)), none)
    items = F.when(F.col("_both").isNull(), F.col("_items")).otherwise(F.array_append("_items", F.col("_both")))
    gathered = gathered.select(*_USERS, *sides, F.array_sort(items).alias("_items"), shared.alias("_shared"))
    gathered = gathered.withColumn("k_dense", F.aggregate("_shared", F.lit(0), lambda n, x: n + F.bit_count(x)))
    gathered = gathered.withColumn("k", F.size("_items") + F.col("k_dense")).where("k > 1")
    entry = lambda dense, word, bits: F.struct(F.lit(dense).alias("dense"), word.cast("bigint").alias("word"), bits.alias("bits"))
    one = F.lit(1).cast("bigint")
    single = F.transform("_items", lambda item: entry(False, item, one))
    dense = F.filter(F.transform("_shared", lambda bits, word: entry(True, word, bits)), lambda e: e["bits"] != 0)
    return gathered.select(*_USERS, *sides, "k", "k_dense", F.concat(single, dense).alias("words"))


def _bits(words: np.ndarray) -> np.ndarray:
    octets = np.ascontiguousarray(words).view(np.uint8).reshape(-1, 8)
    return np.unpackbits(octets, axis=1, bitorder="little").astype(np.float64)


def _expanded(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of units and user pairs per item pair, from pairs of words of which the second is dense.

    For two dense words that is a product of their bit matrices. Sums of a batch
    are whole doubles below 2^53 (10,000 rows of at most 1e10 each), so they are exact.
    """
    held: dict[tuple[int, int], list[np.ndarray]] = {}

    def table(dense: bool, wa, ia, wb, ib, units, n) -> pa.RecordBatch:
        columns = [np.full(len(wa), dense), wa, ia.astype(np.int32), wb, ib.astype(np.int32), units, n]
        names = ["dense", "word_a", "bit_a", "word_b", "bit_b", "units", "n"]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)

    def flush() -> Iterator[pa.RecordBatch]:
        for (a, b), (units, n) in held.items():
            i, j = np.nonzero(np.triu(n, 1) if a == b else n)
            yield table(True, np.full(len(i), a), i, np.full(len(i), b), j, units[i, j], n[i, j])
        held.clear()

    for batch in batches:
        for at in range(0, batch.num_rows, PRODUCT_ROWS):
            part = batch.slice(at, PRODUCT_ROWS)
            wa, ba, wb, bb, units = (part.column(c).to_numpy() for c in ("wa", "ba", "wb", "bb", "units"))
            dense = part.column("da").to_numpy(zero_copy_only=False)
            pairs, which = np.unique(np.stack([wa[dense], wb[dense]]), axis=1, return_inverse=True)
            order = np.argsort(which.reshape(-1), kind="stable")
            cuts = np.searchsorted(which.reshape(-1)[order], np.arange(pairs.shape[1] + 1))
            for (a, b), start, end in zip(pairs.T.tolist(), cuts, cuts[1:]):
                rows = np.flatnonzero(dense)[order[start:end]]
                left, right = _bits(ba[rows]), _bits(bb[rows])
                total = held.setdefault((a, b), [np.zeros((WORD, WORD), np.int64) for _ in range(2)])
                total[0] += ((left * units[rows, None]).T @ right).astype(np.int64)
                total[1] += (left.T @ right).astype(np.int64)
            if len(held) > HELD_PRODUCTS:
                yield from flush()
            if not dense.all():  # a word of one item with a dense one
                row, bit = np.nonzero(_bits(bb[~dense]))
                if len(row):
                    single, word, amount = wa[~dense][row], wb[~dense][row], units[~dense][row]
                    order = np.lexsort((bit, word, single))
                    single, word, bit, amount = single[order], word[order], bit[order], amount[order]
                    new = np.append(True, (single[1:] != single[:-1]) | (word[1:] != word[:-1]) | (bit[1:] != bit[:-1]))
                    begin = np.flatnonzero(new)
                    counts = np.diff(np.append(begin, len(bit)))
                    yield table(False, single[begin], np.zeros(len(begin)), word[begin], bit[begin], np.add.reduceat(amount, begin), counts)
    yield from flush()


def _item_pair_terms(pairs: DataFrame, words: DataFrame | None) -> DataFrame:
    """``(item_i, item_j, units, n)`` in any number of rows per item pair, from ``words`` and ``units`` of user pairs.

    With popular items, a user pair has ``counted``, its units in ``dense_terms``: two popular items get what is missing there.
    """
    counted = [] if words is None else ["counted"]
    first = pairs.select("units", *counted, "words", F.posexplode("words").alias("_at", "_a"))
    # a dense word is also paired with itself
    rest = F.slice("words", F.col("_at") + F.when(F.col("_a.dense"), 1).otherwise(2), F.size("words"))
    both = first.select("units", *counted, "_a", F.explode(rest).alias("_b"))
    item_i, item_j = F.col("_a.word").alias("item_i"), F.col("_b.word").alias("item_j")
    # words of one item come before dense ones
    single = both.where(~F.col("_b.dense")).select(item_i, item_j, "units", F.lit(1).cast("bigint").alias("n"))
    if words is None:
        return single
    fields = [F.col(f"_{x}.{f}").alias(f"{f[0]}{x}") for x in "ab" for f in ("dense", "word", "bits")]
    units = F.when(F.col("_a.dense"), F.col("units") - F.col("counted")).otherwise(F.col("units")).alias("units")
    packed = both.where(F.col("_b.dense")).select(*fields, units)
    schema = "dense boolean, word_a bigint, bit_a int, word_b bigint, bit_b int, units bigint, n bigint"
    sums = packed.select("da", "wa", "ba", "wb", "bb", "units").mapInArrow(_expanded, schema)
    for x in "ab":
        names = words.select(F.col("word").alias(f"word_{x}"), F.col("bit").alias(f"bit_{x}"), F.col("item").alias(f"item_{x}"))
        sums = sums.join(names, [f"word_{x}", f"bit_{x}"], "left")
    one = F.when(F.col("dense"), F.col("item_a")).otherwise(F.col("word_a"))
    n = F.when(F.col("dense"), F.lit(0)).otherwise(F.col("n"))
    decoded = sums.select(F.least(one, "item_b"), F.greatest(one, "item_b"), "units", n)
    return stack(single, decoded)


def linked_item_pairs(baskets: DataFrame, block_size: int = BLOCK_SIZE) -> DataFrame:
    """``(item_i < item_j, user_a < user_b, k)``: one row per item pair of every user pair that shares two items or more."""
    pairs = shared_words(baskets, item_counts(baskets), None, (), block_size)
    first = pairs.select(*_USERS, "k", "words", F.posexplode("words").alias("_at", "_i"))
    rest = F.slice("words", F.col("_at") + 2, F.col("k"))
    both = first.select(*_USERS, "k", "_i", F.explode(rest).alias("_j"))
    return both.select(F.col("_i.word").alias("item_i"), F.col("_j.word").alias("item_j"), *_USERS, "k")


def quadruples(baskets: DataFrame, block_size: int = BLOCK_SIZE) -> DataFrame:
    """(item_i, item_j, user_u, user_v, k): every two users around every two items they share."""
    pairs = linked_item_pairs(baskets, block_size=block_size)
    return pairs.select(
        "item_i",
        "item_j",
        F.col("user_a").alias("user_u"),
        F.col("user_b").alias("user_v"),
        F.col("k").cast("bigint").alias("k"),
    )


def swing_pairs(
    baskets: DataFrame,
    alpha: float = 0.5,
    counting: str = "unordered",
    user_weight: str | None = None,
    per_item: Sequence[str] = (),
    min_support: int = 1,
    block_size: int = BLOCK_SIZE,
    share: int = DENSE_SHARE,
) -> DataFrame:
    """Swing score of every item pair with at least two shared users, as exact ``units``.

    ``counting='ordered'`` counts (u, v) and (v, u). ``user_weight='inverse_sqrt'``
    multiplies a contribution by ``1 / sqrt(items of u)`` and the same of v.
    ``per_item`` names columns of ``baskets`` that depend on the item only; they
    come out as ``<name>_i`` and ``<name>_j``. ``min_support`` keeps item pairs
    with that many shared users (all items count for k, so none is left out before).
    Items that more than one in ``share`` users have are bits of words, see
    ``dense_terms``; that changes the work, not the scores. Input is unique on (user, item).
    """
    payload: tuple[str, ...] = ()
    if user_weight is not None:
        if user_weight != "inverse_sqrt":
            raise ValueError(f"unknown user weight: {user_weight}")
        weights = baskets.groupBy("user").agg((F.lit(1.0) / F.sqrt(F.count(F.lit(1)))).alias("_w"))
        baskets, payload = baskets.join(weights, "user"), ("_w",)
    counts = item_counts(baskets)
    words = item_words(baskets, counts, share)
    rows = baskets.select("user", "item", *payload)
    strength = F.col("_w_a") * F.col("_w_b") if payload else F.lit(1.0)
    units = lambda k: to_units(strength / (F.lit(alpha) + k))
    if words is None:
        pairs = shared_words(rows, counts, words, payload, block_size)
        terms = _item_pair_terms(pairs.select("words", units(F.col("k")).alias("units")), words)
    else:
        members = materialize(user_words(rows, counts, words, payload), "members")
        masks = materialize(user_masks(members, words, payload), "masks")
        terms = dense_terms(masks, words, alpha, payload, block_size)
        if not members.where(~F.col("dense")).isEmpty():
            pairs = partly_popular(members, masks, payload, block_size)
            counted = F.when(F.col("k_dense") > 1, units(F.col("k_dense"))).otherwise(F.lit(0)).alias("counted")
            # read by both kinds of words
            pairs = materialize(pairs.select("words", units(F.col("k")).alias("units"), counted), "shared-words")
            terms = stack(terms, _item_pair_terms(pairs, words))
    sums = terms.groupBy("item_i", "item_j").agg(exact_sum(F.col("units")).alias("units"), F.sum("n").alias("_n"))
    # c shared users make c (c - 1) / 2 user pairs, so support needs no table of its own.
    enough = min_support * (min_support - 1) // 2
    if enough > 1:
        sums = sums.where(F.col("_n") >= enough)
    times = 2 if counting == "ordered" else 1
    sums = sums.select("item_i", "item_j", (F.col("units") * times).cast("decimal(38,0)").alias("units"))
    if per_item:
        of_item = baskets.select("item", *per_item).distinct()
        for x in "ij":
            sums = sums.join(of_item.select(F.col("item").alias(f"item_{x}"), *[F.col(c).alias(f"{c}_{x}") for c in per_item]), f"item_{x}")
    return sums


def scaled(sums: DataFrame, weight: str) -> DataFrame:
    """Scores times the weights of both items, a ``per_item`` column of ``swing_pairs``; without one it is 1."""
    scale = F.coalesce(f"{weight}_i", F.lit(1.0)) * F.coalesce(f"{weight}_j", F.lit(1.0))
    units = F.round(F.col("units").cast("double") * scale).cast("decimal(38,0)")
    return sums.select("item_i", "item_j", units.alias("units"))


def both_directions(sums: DataFrame) -> DataFrame:
    return symmetric(sums, "units")


def with_first_seen(interactions: DataFrame) -> DataFrame:
    """``(user, item, first)``: the place of the item, its first (ts, user)."""
    first = interactions.groupBy("item").agg(F.min(F.struct("ts", "user")).alias("first"))
    return interactions.select("user", "item").join(first, "item")


def first_seen_direction(sums: DataFrame) -> DataFrame:
    """List the later item under the earlier one only; ``first`` is a ``per_item`` column, the lower id of equal ones is earlier."""
    swap = F.col("first_j") < F.col("first_i")
    return sums.select(
        F.when(swap, F.col("item_j")).otherwise(F.col("item_i")).alias("item_i"),
        F.when(swap, F.col("item_i")).otherwise(F.col("item_j")).alias("item_j"),
        "units",
    )


def rounded(sums: DataFrame, places: int = 5) -> DataFrame:
    """Scores rounded half-even to ``places`` decimals, before any ranking."""
    return sums.withColumn("units", F.bround("units", places - 10).cast("decimal(38,0)"))


def neighbours(directed: DataFrame, k: int = 20) -> DataFrame:
    """The ``k`` best neighbours of every ``item_i`` of a directed score table, ties by lower id."""
    short = F.col("units").try_cast("bigint").alias("short")
    rows = directed.select("item_i", "item_j", short, F.when(short.isNull(), F.col("units")).cast("decimal(38,0)").alias("wide"))
    kind = "item_i bigint, item_j bigint, short bigint, wide decimal(38,0)"
    few = rows.mapInArrow(_best(k, False), kind).repartition("item_i")
    best = few.mapInArrow(_best(k, True), f"{kind}, rank int")
    units = F.coalesce(F.col("short").cast("double"), F.col("wide").cast("double"))
    return best.select("item_i", "item_j", (units / F.lit(UNITS)).alias("sim"), "rank")


def _best(k: int, ranked: bool):
    """Function to the ``k`` rows of highest score of every ``item_i``, of some rows at a time or, ``ranked``, of all.

    What is held is cut down to the best whenever ``TASK_ROWS`` more have come. Scores beyond a long are compared as they are.
    """

    def cut(held: list[pa.RecordBatch]) -> tuple[pa.Table, np.ndarray]:
        rows = pa.Table.from_batches(held)
        if rows.column("wide").null_count == rows.num_rows:
            score = -rows.column("short").to_numpy()
        else:
            exact = [w if w is not None else s for s, w in zip(rows.column("short").to_pylist(), rows.column("wide").to_pylist())]
            place = {v: at for at, v in enumerate(sorted(set(map(int, exact)), reverse=True))}
            score = np.array([place[int(v)] for v in exact], np.int64)
        item, other = (rows.column(c).to_numpy() for c in ("item_i", "item_j"))
        order = np.lexsort((other, score, item))
        first = np.flatnonzero(np.append(True, item[order][1:] != item[order][:-1]))
        rank = np.arange(len(order)) - np.repeat(first, np.diff(np.append(first, len(order)))) + 1
        return rows.take(pa.array(order[rank <= k])), rank[rank <= k].astype(np.int32)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, waiting = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                waiting += batch.num_rows
            if waiting >= TASK_ROWS:
                rows, _ = cut(held)
                held, waiting = rows.to_batches(), 0
                if not ranked:
                    yield from held
                    held = []
        if held:
            rows, rank = cut(held)
            yield from (rows.append_column("rank", pa.array(rank)) if ranked else rows).to_batches(BATCH)

    return run
