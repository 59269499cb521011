import random
from itertools import combinations
from math import sqrt

import pytest

from affinis.operators import itemcf, prepare
from tests.conftest import histories, rates_frame, skewed_rates


def brute(rates, kind):
    by_item, pairs = {}, {}
    for (_, i), r in rates.items():
        by_item.setdefault(i, []).append(r)
    for u, h in histories(rates).items():
        for i, j in combinations(sorted(h), 2):
            pairs.setdefault((i, j), []).append((rates[u, i], rates[u, j]))
    mean = {i: sum(r) / len(r) for i, r in by_item.items()}
    norm = {i: sum(r) for i, r in by_item.items()}
    if kind == "pearson":
        norm = {i: sum((x - mean[i]) ** 2 for x in r) for i, r in by_item.items()}
    out = {}
    for (i, j), both in pairs.items():
        if norm[i] < 1e-9 or norm[j] < 1e-9:
            continue
        joint = {
            "cosine": lambda: sum(min(a, b) for a, b in both),
            "raw_product": lambda: sum(a * b for a, b in both),
            "pearson": lambda: sum((a - mean[i]) * (b - mean[j]) for a, b in both),
        }[kind]()
        out[i, j] = joint / sqrt(norm[i] * norm[j])
    return out


@pytest.mark.parametrize("kind", ["cosine", "raw_product", "pearson"])
@pytest.mark.parametrize("block_size", [4, 1000])
def test_matches_definition(spark, kind, block_size):
    rates = skewed_rates()
    sims = getattr(itemcf, kind)(rates_frame(spark, rates), block_size)
    got = {(r.item_i, r.item_j): r.sim for r in sims.collect()}
    want = brute(rates, kind)
    assert got.keys() == want.keys()
    assert all(abs(got[p] - want[p]) < 1e-9 for p in want)
    if kind == "cosine":
        assert max(got.values()) <= 1 + 1e-12
    if kind == "pearson":
        assert max(map(abs, got.values())) <= 1 + 1e-9


def test_neighbours_are_ranked_with_ties_by_id(spark):
    sims = spark.createDataFrame(
        [(1, 2, 0.5), (1, 3, 0.5), (1, 4, 0.9), (2, 3, 0.1)], "item_i BIGINT, item_j BIGINT, sim DOUBLE"
    )
    got = {(r.item_i, r["rank"]): r.item_j for r in itemcf.neighbours(sims, 2).collect()}
    assert got == {(1, 1): 4, (1, 2): 2, (2, 1): 1, (2, 2): 3, (3, 1): 1, (3, 2): 2, (4, 1): 1}


def test_same_model_at_any_partitioning(spark, partitions):
    rates, seen = rates_frame(spark, skewed_rates()), []
    for n in (1, 4, 37):
        partitions(n)
        seen.append(sorted(map(tuple, itemcf.neighbours(itemcf.cosine(rates, 4), 5).collect())))
    assert seen[0] == seen[1] == seen[2]


def test_duplicates_zero_rates_and_flat_items(spark):
    rows = [(1, 1, 3.0), (1, 1, 5.0), (1, 2, -4.0), (2, 1, 5.0), (2, 2, 0.0), (1, 3, 1.0), (2, 3, 2.0)]
    frame = spark.createDataFrame(rows, "user BIGINT, item BIGINT, rate DOUBLE").selectExpr("*", "timestamp_ntz'2020-01-01' ts")
    best = prepare.max_rate(frame)
    assert {(r.user, r.item): r.rate for r in best.collect()} == {
        (1, 1): 5.0, (1, 2): 0.0, (2, 1): 5.0, (2, 2): 0.0, (1, 3): 1.0, (2, 3): 2.0,
    }
    # Item 2 weighs nothing, item 1 never varies: such pairs have no similarity.
    assert [(r.item_i, r.item_j) for r in itemcf.cosine(best).collect()] == [(1, 3)]
    assert itemcf.pearson(best).collect() == []
    moments = {r.item: (r.n, r.mean, r.deviation) for r in itemcf.item_moments(best).collect()}
    assert moments[1] == (2, 5.0, 0.0) and moments[3] == (2, 1.5, 0.5)


def test_empty_input(spark):
    empty = spark.createDataFrame([], "user BIGINT, item BIGINT, rate DOUBLE")
    assert itemcf.neighbours(itemcf.cosine(empty)).collect() == []
    assert itemcf.neighbours(itemcf.pearson(empty)).collect() == []


def test_index_segments_and_profile(spark):
    rates = skewed_rates()
    frame = rates_frame(spark, rates)
    got = {}
    for r in prepare.members_index(frame, "item", "user", 16).collect():
        got.setdefault(r.item, {})[r.segment] = [int(u) for u in r.users.split(",")]
        assert r.n <= 16
    for item, segments in got.items():
        assert [u for s in sorted(segments) for u in segments[s]] == sorted(u for u, i in rates if i == item)
    profile = prepare.dataset_profile(frame).first()
    assert tuple(profile) == (len(rates), len({u for u, _ in rates}), len({i for _, i in rates}))


@pytest.mark.parametrize("rate", [0.1, 0.7, 4.7])
def test_equal_rates_have_no_deviation(spark, rate):
    rows = {(u, 1): rate for u in range(5)} | {(u, 2): 0.3 * u for u in range(5)} | {(u, 3): 1.1 * u * u for u in range(5)}
    frame = rates_frame(spark, rows)
    deviation = {r.item: r.deviation for r in itemcf.item_moments(frame).collect()}
    assert deviation[1] == 0.0 and deviation[2] > 0
    assert {(r.item_i, r.item_j) for r in itemcf.pearson(frame).collect()} == {(2, 3)}


def test_pearson_of_fractional_rates_at_any_partitioning(spark, partitions):
    rng, seen = random.Random(9), []
    rows = {(u, i): rng.random() * 5 for u in range(30) for i in range(12) if rng.random() < 0.6}
    for n in (1, 4, 37):
        partitions(n)
        seen.append({(r.item_i, r.item_j): r.sim for r in itemcf.pearson(rates_frame(spark, rows).repartition(n)).collect()})
    assert seen[0] == seen[1] == seen[2]
    by_item = {}
    for (u, i), r in rows.items():
        by_item.setdefault(i, {})[u] = r
    mean = {i: sum(v.values()) / len(v) for i, v in by_item.items()}
    dev = {i: sum((r - mean[i]) ** 2 for r in v.values()) for i, v in by_item.items()}
    for (i, j), sim in seen[0].items():
        both = by_item[i].keys() & by_item[j].keys()
        want = sum((by_item[i][u] - mean[i]) * (by_item[j][u] - mean[j]) for u in both) / (dev[i] * dev[j]) ** 0.5
        assert abs(sim - want) < 1e-7


@pytest.mark.parametrize("kind", ["cosine", "raw_product", "pearson"])
def test_small_shares_of_heavy_items_are_kept(spark, kind):
    """Three users' shares of two items are each below half of 1e-10, as those of items with very many raters are."""
    rows = {(u, i): 1.0 for u in range(3) for i in (1, 2)} | {(3, 1): 1e11, (4, 2): 1e11}
    sims = getattr(itemcf, kind)(rates_frame(spark, rows)).collect()
    exact = brute(rows, kind)[1, 2] if kind == "pearson" else 3 / (1e11 + 3)
    assert [(r.item_i, r.item_j) for r in sims] == [(1, 2)]
    assert sims[0].sim == pytest.approx(exact, rel=1e-9)


def test_large_rates_do_not_overflow(spark):
    rows = {(u, i): 1e6 * (u + i) for u in range(4) for i in (1, 2)}
    moments = {r.item: r for r in itemcf.item_moments(rates_frame(spark, rows)).collect()}
    assert moments[1].squares == 30e12 and moments[1].deviation == 5e12
    for kind in ("cosine", "raw_product", "pearson"):
        sims = {(r.item_i, r.item_j): r.sim for r in getattr(itemcf, kind)(rates_frame(spark, rows)).collect()}
        assert sims == pytest.approx(brute(rows, kind), rel=1e-9)
