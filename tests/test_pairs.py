from itertools import combinations

import pytest

from affinis.operators import itemcf, swing
from affinis.operators.pairs import member_pairs
from tests.conftest import histories, rates_frame, skewed_rates


@pytest.mark.parametrize("block_size", [2, 5, 1000])
def test_every_pair_once_with_its_payload(spark, block_size):
    rates = skewed_rates()
    got = member_pairs(rates_frame(spark, rates), "user", "item", ("rate",), block_size).collect()
    want = sorted(
        (u, a, b, rates[u, a], rates[u, b]) for u, h in histories(rates).items() for a, b in combinations(sorted(h), 2)
    )
    assert sorted((r.user, r.item_a, r.item_b, r.rate_a, r.rate_b) for r in got) == want


def test_a_hot_group_is_spread_over_many_keys(spark):
    """One group with a third of all rows: no packed array is longer than about two blocks."""
    from pyspark.sql import functions as F

    from affinis.operators.pairs import pack, spread

    hot = spark.range(2000).select(F.lit(0).cast("bigint").alias("user"), F.col("id").alias("item"))
    cold = spark.range(4000).select((F.col("id") % 1000 + 1).alias("user"), F.col("id").alias("item"))
    packed = pack(spread(hot.union(cold), ["user"], "item", 100), ["user", "_low", "_high"], ["item", "_block"])
    longest = packed.agg(F.max(F.size("_members"))).first()[0]
    assert longest < 300
    assert packed.where("user = 0").count() == 20 * 21 // 2


@pytest.mark.parametrize("block_size", [3, 1000])
def test_cooccurrence_both_ways(spark, block_size):
    rates = skewed_rates()
    frame, baskets = rates_frame(spark, rates), histories(rates)
    items, users = {}, {}
    for h in baskets.values():
        for pair in combinations(sorted(h), 2):
            items[pair] = items.get(pair, 0) + 1
    for u, v in combinations(sorted(baskets), 2):
        if baskets[u] & baskets[v]:
            users[u, v] = len(baskets[u] & baskets[v])
    co = itemcf.cooccurrence(frame, block_size=block_size)
    assert {(r.item_i, r.item_j): r.co for r in co.collect()} == items
    frequent = itemcf.cooccurrence(frame, 4, block_size)
    assert {(r.item_i, r.item_j): r.co for r in frequent.collect()} == {p: n for p, n in items.items() if n >= 4}
    k = swing.user_cooccurrence(frame, block_size)
    assert {(r.user_u, r.user_v): r.k for r in k.collect()} == users


def test_shared_users_in_segments(spark):
    rates = skewed_rates()
    got = {}
    for r in swing.shared_users(rates_frame(spark, rates), span=8).collect():
        members = [int(u) for u in r.users.split(",")]
        assert members == sorted(members) and len(members) == r.n <= 8
        assert {u // 8 for u in members} == {r.segment}
        got.setdefault((r.item_i, r.item_j), set()).update(members)
    want = {}
    for u, h in histories(rates).items():
        for pair in combinations(sorted(h), 2):
            want.setdefault(pair, set()).add(u)
    assert got == want
