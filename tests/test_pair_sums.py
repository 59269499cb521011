import random
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from affinis.functions import fixedpoint
from affinis.operators import itemcf, swing
from affinis.operators import pair_sums as ps
from affinis.operators.pair_sums import LIST_ENTRIES, geometric_mean, neighbour_lists, pair_groups, pair_sums
from tests.conftest import histories, rates_frame, skewed_rates


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("kind", ["cosine", "raw_product", "pearson"])
def test_no_row_per_item_pair_is_shuffled(spark, kind):
    sims = getattr(itemcf, kind)(rates_frame(spark, skewed_rates()), best=5)
    assert "hashpartitioning(item_i" not in plan(sims) and "hashpartitioning(item_a" not in plan(sims)


def test_no_row_per_pair_is_shuffled_for_counts_and_lists(spark):
    frame = rates_frame(spark, skewed_rates())
    tables = itemcf.cooccurrence(frame), itemcf.overlap(frame), swing.user_cooccurrence(frame), swing.shared_users(frame)
    for pairs in map(plan, tables):
        assert not any(f"hashpartitioning({c}" in pairs for c in ("item_i", "item_a", "user_a", "user_u"))


def test_tasks_grow_with_pairs_and_lists_are_short(spark):
    rows = spark.range(6000).select((F.col("id") % 4).alias("user"), F.floor(F.col("id") / 4).alias("item"))
    lists = neighbour_lists(rows, "user", "item", (), True, 400, 100_000)
    assert lists.rdd.getNumPartitions() == -(-4 * 1500 * 1499 // 100_000)
    longest, entries = lists.agg(F.max(F.size("_low_bits")), F.sum(F.size("_low_bits"))).first()
    assert longest <= LIST_ENTRIES and entries == 4 * (1500 * 1499 + 1500)


def test_a_hot_member_is_dealt_to_several_tasks(spark):
    rows = [(u, i) for u in range(200) for i in (0, 1 + u, 201 + u, 401 + u)]
    frame = spark.createDataFrame(rows, "user BIGINT, item BIGINT")
    lists = neighbour_lists(frame, "user", "item", (), True, 100, 60).where("item = 0")
    sizes = lists.groupBy(F.spark_partition_id()).agg(F.sum(F.size("_low_bits")).alias("n")).collect()
    assert len(sizes) > 3 and sum(r.n for r in sizes) in range(600, 801)


@pytest.mark.parametrize("task_pairs", [7, 1000])
@pytest.mark.parametrize("block_size", [3, 1000])
def test_best_rows_are_those_of_the_whole_table(spark, task_pairs, block_size):
    frame = rates_frame(spark, skewed_rates()).withColumn("w", F.col("item") + 1.0)
    args = (frame, "user", "item", ("rate", "w"), np.minimum, geometric_mean)
    sims = pair_sums(*args, None, block_size, task_pairs).withColumnRenamed("value", "sim")
    best = pair_sums(*args, 4, block_size, task_pairs).withColumnRenamed("value", "sim")
    rows = lambda model: sorted((r.item_i, r.item_j, r.sim, r["rank"]) for r in model.collect())
    want = rows(itemcf.neighbours(sims, 4))
    assert want and rows(itemcf.neighbours(best, 4, directed=True)) == want


@pytest.mark.parametrize("task_pairs", [7, 1000])
def test_groups_of_pairs_when_members_are_dealt_out(spark, task_pairs):
    rates = skewed_rates()
    got = {}
    for r in pair_groups(rates_frame(spark, rates), "user", "item", 8, 5, task_pairs).collect():
        assert {u // 8 for u in r.groups} == {r.segment} and (r.item_i, r.item_j, r.segment) not in got
        got[r.item_i, r.item_j, r.segment] = r.groups
    want = {}
    for u, h in sorted(histories(rates).items()):
        for i, j in combinations(sorted(h), 2):
            want.setdefault((i, j, u // 8), []).append(u)
    assert got == want


def test_very_large_ids(spark):
    rows = [(u, i, 1.0) for u in (-(2**62), 2**62) for i in (-(2**63), -1, 2**63 - 1)]
    frame = spark.createDataFrame(rows, "user BIGINT, item BIGINT, rate DOUBLE")
    got = sorted(map(tuple, itemcf.cooccurrence(frame).collect()))
    assert got == [(-(2**63), -1, 2), (-(2**63), 2**63 - 1, 2), (-1, 2**63 - 1, 2)]


def test_passes_give_the_same_rows(spark):
    frame = rates_frame(spark, skewed_rates()).withColumn("weight", F.col("item") + 1.0)
    rows = lambda **limits: sorted(
        tuple(r) for r in pair_sums(frame, "user", "item", ("rate", "weight"), np.minimum, geometric_mean, 5, task_pairs=2000, **limits).collect()
    )
    assert rows(pass_pairs=2000) == rows()
    written = pair_sums(frame, "user", "item", ("rate", "weight"), np.minimum, geometric_mean, 5, task_pairs=2000, pass_pairs=2000)
    assert "Exchange" not in plan(written)


def lists_of(rows):
    """Rows ``(a, b, own, met)`` as one task gets them, ``own`` and ``met`` being pairs of a value and a norm."""
    a, b, own, met = (np.array(c) for c in zip(*rows))
    lists = ps.Lists(np.ones(len(a), np.int64), [a, *own.T.astype(float)], b, list(met.T.astype(float)))
    return list(lists.blobs(np.zeros(len(a), np.int64)))


@pytest.mark.parametrize("held", [1, 5, 1 << 20])
def test_a_task_adds_and_ranks_the_same_whenever_it_folds(monkeypatch, held):
    """Values of pairs that come once are not cut into parts, and only rows with one of the best scores are sorted."""
    monkeypatch.setattr(ps, "HELD_PAIRS", held)
    monkeypatch.setattr(ps, "READ_ENTRIES", 1)
    rng = random.Random(held)
    value = lambda: rng.choice([0.0, 0.1, -0.1, 3.0, 1e-30, rng.uniform(-9, 9)])
    rows = [(rng.randrange(4), 10 + rng.randrange(60), (value(), 2.0), (value(), 8.0)) for _ in range(300)]
    sums = {}
    for a, b, own, met in rows:
        sums.setdefault((a, b), []).append(own[0] * met[0])
    total = {k: fixedpoint.from_parts([p.sum(keepdims=True) for p in fixedpoint.to_parts(np.array(v))])[0] for k, v in sums.items()}
    score = {k: fixedpoint.forty_bits(np.array([t]) / 4.0)[0] for k, t in total.items()}
    want = sorted((a, b, score[a, b]) for a in range(4) for b in sorted((y for x, y in score if x == a), key=lambda y: (-score[a, y], y))[:6])
    sorted_rows, keep = [], np.lexsort
    monkeypatch.setattr(ps.np, "lexsort", lambda keys: sorted_rows.append(len(keys[0])) or keep(keys))
    batches = [batch for row in rows for batch in lists_of([row])]
    got = [r for out in ps._adder(("v", "w"), np.multiply, geometric_mean, 6)(batches) for r in zip(*out.to_pydict().values())]
    assert sorted(got) == want
    ties = sum(score[a, b] >= min(s for x, _, s in want if x == a) for a, b in score)
    assert sorted_rows[-1] <= ties < len(score)
