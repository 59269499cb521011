import random
from decimal import Decimal
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from affinis.operators import swing
from affinis.operators.topk import ranked_list
from tests.conftest import brute_swing, histories, rates_frame, skewed_rates


def scores(frame, **kwargs):
    return {(r.item_i, r.item_j): int(r.units) for r in swing.swing_pairs(frame, **kwargs).collect()}


def test_worked_example(spark):
    h, t, r, p = range(4)
    baskets = {(0, h): 1, (0, t): 1, (0, r): 1, (0, p): 1, (1, h): 1, (1, r): 1, (1, p): 1, (2, h): 1, (2, p): 1}
    got = scores(rates_frame(spark, {k: 1.0 for k in baskets}))
    assert got.keys() == {(h, p), (h, r), (r, p)}
    assert abs(got[h, p] / 1e10 - (1 / 3.5 + 2 / 2.5)) < 1e-9
    assert abs(got[h, r] / 1e10 - 1 / 3.5) < 1e-9 and got[h, r] == got[r, p]


@pytest.mark.parametrize("block_size", [4, 13, 1000])
def test_tops_and_blocks_do_not_change_scores(spark, block_size):
    rates = skewed_rates()
    assert scores(rates_frame(spark, rates).select("user", "item"), block_size=block_size) == brute_swing(rates)


@pytest.mark.parametrize("share", [0, 2, 8, 10**6])
def test_words_of_popular_items_do_not_change_scores(spark, share):
    """With a large share every item is a bit, and they fill several words."""
    rng = random.Random(share)
    rates = {(u, i): 1.0 for u in range(30) for i in rng.sample(range(150), rng.choice([3, 20, 100]))}
    rates |= {(u, 7): 1.0 for u in range(0, 30, 2)}
    frame = rates_frame(spark, rates).select("user", "item")
    assert scores(frame, share=share) == brute_swing(rates)
    support = {}
    for h in histories(rates).values():
        for pair in combinations(sorted(h), 2):
            support[pair] = support.get(pair, 0) + 1
    assert scores(frame, share=share, min_support=4) == {p: s for p, s in brute_swing(rates).items() if support[p] >= 4}


def test_large_item_numbers_and_many_batches(spark, monkeypatch):
    monkeypatch.setattr(swing, "PRODUCT_ROWS", 7)
    monkeypatch.setattr(swing, "HELD_PRODUCTS", 1)
    rates = {(u - 3, i * 2**55): 1.0 for u, i in skewed_rates(7)}
    assert scores(rates_frame(spark, rates).select("user", "item"), share=20) == brute_swing(rates)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_zipf_items(spark, seed):
    rng = random.Random(seed)
    rates = {(u, min(int(rng.paretovariate(0.7)), 40)): 1.0 for u in range(60) for _ in range(12)}
    assert scores(rates_frame(spark, rates).select("user", "item"), block_size=9) == brute_swing(rates)


def test_users_of_their_top_are_not_paired_with_each_other(spark):
    frame = spark.range(3000).selectExpr("id AS user", "0L AS item")
    frame = frame.union(spark.createDataFrame([(0, 1), (1, 1), (2, 1)], "user BIGINT, item BIGINT"))
    assert swing.linked_item_pairs(frame).count() == 3
    for share in (0, 8, 5000):  # the hot item as a word of its own, as a bit, and both items as bits of one word
        counts = swing.item_counts(frame)
        words = swing.item_words(frame, counts, share)
        rows = swing.user_words(frame, counts, words).groupBy("top").count().collect()
        assert {r.top: r["count"] for r in rows} == [{0: 3003}, {0: 3003}, {0: 2997, None: 3}][[0, 8, 5000].index(share)]
        assert swing.shared_words(frame, counts, words).count() == 3


def test_few_items(spark):
    rates = {(u, i): 1.0 for u in range(7) for i in range(3) if (u + i) % 4}
    assert scores(rates_frame(spark, rates)) == brute_swing(rates)


def test_weights_order_and_support(spark):
    rates = skewed_rates()
    frame = rates_frame(spark, rates).select("user", "item")
    plain = brute_swing(rates)
    ordered = scores(frame, counting="ordered")
    assert ordered == {p: 2 * s for p, s in plain.items()}
    weighted = scores(frame, user_weight="inverse_sqrt")
    want = brute_swing(rates, weight=lambda n: n**-0.5)
    assert weighted.keys() == want.keys() and all(abs(weighted[p] - want[p]) < 200 for p in want)
    support = {}
    for h in histories(rates).values():
        for pair in combinations(sorted(h), 2):
            support[pair] = support.get(pair, 0) + 1
    frequent = scores(frame, min_support=4)
    assert frequent == {p: s for p, s in plain.items() if support[p] >= 4}
    weight = spark.createDataFrame([(0, 0.5)], "item BIGINT, weight DOUBLE")
    sums = swing.swing_pairs(frame.join(weight, "item", "left"), per_item=("weight",))
    halved = {(r.item_i, r.item_j): int(r.units) for r in swing.scaled(sums, "weight").collect()}
    assert all(abs(halved[p] - plain[p] * (0.5 if 0 in p else 1)) <= 1 for p in plain)
    with pytest.raises(ValueError):
        swing.swing_pairs(frame, user_weight="other")


@pytest.mark.parametrize("block_size", [4, 1000])
def test_quadruples(spark, block_size):
    rates = skewed_rates(users=20)
    baskets, want = histories(rates), set()
    for u, v in combinations(sorted(baskets), 2):
        shared = sorted(baskets[u] & baskets[v])
        want |= {(i, j, u, v, len(shared)) for i, j in combinations(shared, 2)}
    got = swing.quadruples(rates_frame(spark, rates).select("user", "item"), block_size).collect()
    assert len(got) == len(want) and {tuple(r) for r in got} == want


def test_same_scores_at_any_partitioning(spark, partitions):
    frame, seen = rates_frame(spark, skewed_rates()).select("user", "item"), []
    for n in (1, 4, 37):
        partitions(n)
        seen.append(scores(frame, alpha=1.0))
    assert seen[0] == seen[1] == seen[2] == brute_swing(skewed_rates(), alpha=1.0)


def test_rounding_direction_and_lists(spark):
    sums = spark.createDataFrame(
        [(1, 2, Decimal(150_000)), (1, 3, Decimal(250_000)), (2, 3, Decimal(990_000))], "item_i BIGINT, item_j BIGINT, units DECIMAL(38,0)"
    )
    half_even = {(r.item_i, r.item_j): int(r.units) for r in swing.rounded(sums, 5).collect()}
    assert half_even == {(1, 2): 200_000, (1, 3): 200_000, (2, 3): 1_000_000}
    place = F.element_at(F.array(F.lit(2), F.lit(3), F.lit(1)), F.col("item_i").cast("int"))
    place_j = F.element_at(F.array(F.lit(2), F.lit(3), F.lit(1)), F.col("item_j").cast("int"))
    placed = sums.withColumns({"first_i": place, "first_j": place_j})
    directed = {(r.item_i, r.item_j) for r in swing.first_seen_direction(placed).collect()}
    assert directed == {(1, 2), (3, 1), (3, 2)}
    top = swing.neighbours(swing.both_directions(sums), 2)
    lists = {r.item_i: r.sims for r in ranked_list(top, "item_i", "item_j", "sims").collect()}
    assert lists == {1: "3,2", 2: "3,1", 3: "2,1"}


def test_small_inputs(spark):
    frame = spark.createDataFrame([(1, 1), (1, 2), (2, 1)], "user BIGINT, item BIGINT")
    assert scores(frame) == {}
    assert scores(frame.limit(0)) == {}


def test_users_with_one_common_item_are_no_rows(spark):
    """Where no item is popular, only users that share two items leave the task where they meet."""
    baskets = rates_frame(spark, skewed_rates()).select("user", "item")
    pairs = swing.shared_words(baskets, swing.item_counts(baskets), None, (), 5)
    planned = pairs._jdf.queryExecution().executedPlan().toString()
    assert not any(f"hashpartitioning({c}" in planned for c in ("user_a", "user_b"))
    want = {}
    for (u, a), (v, b) in combinations(sorted(histories(skewed_rates()).items()), 2):
        if len(a & b) > 1:
            want[u, v] = sorted(a & b)
    assert {(r.user_a, r.user_b): [w.word for w in r.words] for r in pairs.collect()} == want


@pytest.mark.parametrize("task_pairs", [5, 1000])
def test_linked_users_when_members_are_dealt_out(spark, task_pairs):
    baskets = rates_frame(spark, skewed_rates()).select("user", "item")
    members = swing.user_words(baskets, swing.item_counts(baskets), None)
    got = {(r.user_a, r.user_b): r.k for r in swing.linked_users(members, (), 7, task_pairs).collect()}
    both = combinations(sorted(histories(skewed_rates()).items()), 2)
    assert got == {(u, v): len(a & b) for (u, a), (v, b) in both if len(a & b) > 1}


@pytest.mark.parametrize("share,block_size,users", [(8, 5, 3), (3, 1000, 256), (10**6, 7, 2)])
def test_users_of_popular_items_are_no_rows(spark, monkeypatch, share, block_size, users):
    """Two users that share popular items only are written nowhere; scores and support are those of the definition."""
    monkeypatch.setattr(swing, "DENSE_BLOCK", 1)
    monkeypatch.setattr(swing, "PRODUCT_USERS", users)
    rng, written = random.Random(share), []
    rates = {(u, i): 1.0 for u in range(25) for i in rng.sample(range(70), 35)}
    rates |= {(u, 100 + u // 3): 1.0 for u in range(25)} | {(u, 200 + u % 7): 1.0 for u in range(25)}
    frame = rates_frame(spark, rates).select("user", "item")
    keep = swing.materialize
    monkeypatch.setattr(swing, "materialize", lambda df, label="table", **more: written.append((label, keep(df, label, **more))) or written[-1][1])
    for weight in (None, "inverse_sqrt"):
        written.clear()
        got = scores(frame, share=share, block_size=block_size, user_weight=weight)
        want = brute_swing(rates, weight=(lambda n: n**-0.5) if weight else (lambda n: 1.0))
        assert got.keys() == want.keys() and all(abs(got[p] - want[p]) <= (300 if weight else 0) for p in want)
        single = {i for i in {i for _, i in rates} if share * sum(j == i for _, j in rates) <= 25}
        baskets = histories(rates)
        met = sum(bool(a & b & single) for a, b in combinations(baskets.values(), 2))
        assert sum(t.count() for label, t in written if label == "shared-words") == met


def test_best_neighbours_of_scores_longer_than_a_long(spark):
    units = [10**25 + d for d in (0, 3, 1, 3)] + [7, 5, 9]
    rows = [(1, j, Decimal(u)) for j, u in enumerate(units)]
    frame = spark.createDataFrame(rows, "item_i BIGINT, item_j BIGINT, units DECIMAL(38,0)")
    got = swing.neighbours(frame, 6).orderBy("rank").collect()
    assert [r.item_j for r in got] == [1, 3, 2, 0, 6, 4] and [r["rank"] for r in got] == [1, 2, 3, 4, 5, 6]
