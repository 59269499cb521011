"""Mixing sources to target weights by weighted fair queueing.

Every source sends its documents in a random but repeatable order, again and
again up to ``max_copies`` times. A copy of a document gets the virtual time at
which it is through: the words its source has sent by then over the source's
target. All copies are dealt out by ranges of that time; the mix is what comes
first in time until the total budget is used up.

Nothing is sorted that need not be: sources are cut into slots of their random
order (so a source with most of the rows is many slots), slots and time ranges
are summed first, and only the range in which the budget ends is put in order.

Defined cases: a NULL text or one without words has size 0 and is never taken;
a NULL source is a source of its own and comes last; equal rows count as often
as they are there and are interchangeable; a very long text is only its size
until the mix is made of whole rows; an empty table gives no rows; columns
other than ``doc_id``, ``text`` and ``source`` are not looked at.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from affinis.llm.common import BLANK_WORD, whole_row
from affinis.session import materialize, stack

SLOT_ROWS = 50_000
KEY_BITS = 60
KEY, KEY_TYPES = ("finish", "rank", "sent", "copy"), ("double", "int", "bigint", "int")


def sized(docs: DataFrame, seed: str = "mix") -> DataFrame:
    """``(doc_id, source, size, place)``: words of each document and its place in the random order, 0 to 2^60 - 1."""
    words = F.coalesce(F.regexp_count("text", F.lit(BLANK_WORD)), F.lit(0)).cast("bigint")
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    place = F.conv(F.substring(digest, 1, KEY_BITS // 4), 16, 10).cast("bigint")
    return docs.select("doc_id", "source", words.alias("size"), place.alias("place"))


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = (1, 2, 3), max_copies: int = 3) -> DataFrame:
    """One row per source: ``source, rank, n, source_size, target``.

    Weights go round over the sources in order of code points, NULL last. The
    targets share the sum of all sizes by weight; none is above ``max_copies``
    times its source, what is left is shared by the others. That is one water
    level: with sources in order of capacity over weight, the level is the
    largest of (budget - capacities before) / (weights from here on).
    """
    by_source = Window.orderBy(F.col("source").asc_nulls_last())
    totals = sizes.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("source_size"))
    ranked = totals.withColumn("rank", F.row_number().over(by_source))
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    capped = ranked.withColumn("weight", F.element_at(cycle, ((F.col("rank") - 1) % len(weights) + 1).cast("int")))
    capped = capped.withColumn("capacity", max_copies * F.col("source_size"))
    filled = Window.orderBy(F.col("capacity") / F.col("weight"), "rank")
    everything = Window.partitionBy()
    level = (F.sum("source_size").over(everything) - (F.sum("capacity").over(filled) - F.col("capacity"))) / (
        F.sum("weight").over(everything) - (F.sum("weight").over(filled) - F.col("weight"))
    )
    levelled = capped.withColumn("level", level).withColumn("level", F.max("level").over(everything))
    target = F.least(F.col("capacity").cast("double"), F.col("level") * F.col("weight"))
    return levelled.select("source", "rank", "n", "source_size", target.alias("target"))


def mix(docs: DataFrame, weights: tuple[float, ...] = (1, 2, 3), max_copies: int = 3, seed: str = "mix") -> DataFrame:
    """Per row of ``docs``: ``doc_id, size, source_size, target, copies, taken``."""
    return _mix(docs, weights, max_copies, seed)


def _mix(docs: DataFrame, weights: tuple[float, ...], max_copies: int, seed: str, extra: tuple[str, ...] = ()) -> DataFrame:
    sizes = materialize(sized(docs, seed), "mix-sizes")
    sources = materialize(source_targets(sizes, weights, max_copies), "mix-sources")
    budget, rows = sources.agg(F.sum("source_size"), F.sum("n")).first()

    # running words of each source: totals of the slots before, and the order inside the slot
    slots = (1 + F.floor(F.col("n") / SLOT_ROWS)).cast("bigint")
    slot = F.shiftright(F.shiftright("place", 20) * slots, KEY_BITS - 20)
    placed = sizes.join(sources.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")))
    placed = placed.drop("s").withColumn("slot", slot)
    before = placed.groupBy("rank", "slot").agg(F.sum("size").alias("words"))
    before = before.withColumn(
        "before", F.sum("words").over(Window.partitionBy("rank").orderBy("slot")) - F.col("words")
    ).drop("words")
    inside = Window.partitionBy("rank", "slot").orderBy("place", "doc_id", "size")
    inside = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sent = placed.withColumn("inside", F.sum("size").over(inside)).join(before, ["rank", "slot"])
    sent = sent.withColumn("sent", F.col("before") + F.col("inside"))
    sent = materialize(sent.select("doc_id", *extra, "size", "rank", "sent", "source_size", "target"), "mix-sent")

    # an entry per copy; its key orders all copies by virtual finish time
    def key(copy: int):
        finish = (F.col("sent") + copy * F.col("source_size")) / F.col("target")
        return F.struct(finish.alias("finish"), F.col("rank"), F.col("sent"), F.lit(copy).alias("copy"))

    possible = (F.col("size") > 0) & (F.col("target") > 0)
    entries = sent.where(possible).select("size", F.explode(F.array(*[key(c) for c in range(max_copies)])).alias("key"))
    ranges = 1 + int(max_copies * (rows or 0) // SLOT_ROWS)
    dealt = entries.withColumn("range", F.least(F.floor(F.col("key.finish") * ranges), F.lit(2 * ranges)))
    sums = dealt.groupBy("range").agg(F.sum("size").alias("words"))
    sums = sums.withColumn("upto", F.sum("words").over(Window.orderBy("range")))
    end = sums.where(F.col("upto") > F.lit(budget)).orderBy("range").limit(1).first()
    if end is None:
        taken = F.when(possible, F.lit(max_copies)).otherwise(0)
    else:
        order = Window.orderBy("key").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        last = dealt.where(F.col("range") == end["range"]).withColumn("upto", F.sum("size").over(order))
        last = last.where(F.col("upto") + F.lit(end["upto"] - end["words"]) > F.lit(budget))
        first_out = last.agg(F.min("key").alias("k")).first()["k"]
        cut = F.struct(*[F.lit(v).cast(t).alias(n) for n, t, v in zip(KEY, KEY_TYPES, first_out)])
        taken = F.when(possible, sum(F.when(key(c) < cut, 1).otherwise(0) for c in range(max_copies))).otherwise(0)
    copies = taken.cast("int")
    return sent.select(
        "doc_id",
        *extra,
        "size",
        "source_size",
        "target",
        copies.alias("copies"),
        (copies * F.col("size")).alias("taken"),
    )


def mixed_rows(docs: DataFrame, weights: tuple[float, ...] = (1, 2, 3), max_copies: int = 3, seed: str = "mix") -> DataFrame:
    """``docs`` with each row as often as the mix takes it, numbered in ``mix_copy``.

    Rows meet their number of copies by id, source and size, in one join, for
    which texts are shuffled once. Of the rows that share all three, the first
    ones by number get the most copies; only they are numbered, where the join has put them.
    """
    docs = docs.drop("mix_copy")
    key = ["doc_id", "source", "size"]
    taken = _mix(docs, weights, max_copies, seed, extra=("source",)).groupBy(*key)
    often = [F.count_if(F.col("copies") >= c).alias(f"at_least_{c}") for c in range(1, max_copies + 1)]
    taken = taken.agg(F.count(F.lit(1)).alias("rows"), *often).where("at_least_1 > 0")
    taken = taken.select(F.xxhash64(*key).alias("digest"), *[F.col(c).alias(f"k_{c}") for c in key], "rows", *[f"at_least_{c}" for c in range(1, max_copies + 1)])
    words = F.coalesce(F.regexp_count("text", F.lit(BLANK_WORD)), F.lit(0)).cast("bigint")
    held = docs.select(whole_row(docs).alias("row"), "doc_id", "source", words.alias("size"))
    held = held.withColumn("held_digest", F.xxhash64(*key))
    same = F.col("held_digest") == F.col("digest")
    for c in key:
        same &= F.col(c).eqNullSafe(F.col(f"k_{c}"))
    # counts are small rows: hashed, so that texts need not be sorted to meet them
    met = held.join(taken.hint("shuffle_hash"), same)
    nth = F.row_number().over(Window.partitionBy("held_digest", *key).orderBy("rows"))
    numbered = stack(
        met.where("rows = 1").withColumn("nth", F.lit(1)),
        met.where("rows > 1").withColumn("nth", nth),
    )
    copies = sum(F.when(F.col("nth") <= F.col(f"at_least_{c}"), 1).otherwise(0) for c in range(1, max_copies + 1))
    numbered = numbered.select("row", copies.cast("int").alias("copies")).where("copies > 0")
    return numbered.select("row.*", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("mix_copy"))
