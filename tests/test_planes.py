import numpy as np
import pytest
from pyspark.sql import functions as F

from affinis.functions.planes import Planes, decode, encode, from_steps, steps
from affinis.operators.itemcf import item_weight
from affinis.operators.pair_sums import dealt_lists, read_lists
from affinis.operators.recommend import recommend
from tests.conftest import rates_frame, skewed_rates
from tests.test_pair_sums import plan


@pytest.mark.parametrize(
    "values",
    [
        np.array([3, -7, 2**62, -(2**63), 2**63 - 1]),
        np.array([5, 5, 5]),
        np.zeros(0, np.int64),
        np.arange(1000) % 50 + 0.0,
        np.array([0.5, -0.0, np.nan, np.inf, 1e300]),
        np.array([-1.0, 2.0, 2.0**60]),
    ],
)
def test_columns_come_back_as_they_were(values):
    column, half = Planes.of(values), len(values) // 2
    parts = [decode(encode([column, column], [b, 0], [e, e]), 2) for b, e in ((0, half), (half, len(values)))]
    back = np.concatenate([p[0] for p in parts])
    assert back.dtype == values.dtype and back.tobytes() == values.tobytes()
    assert parts[1][1].tobytes() == values.tobytes()


def test_steps_of_lists():
    sizes, ids = np.array([2, 0, 3, 1]), np.array([-(2**63), 2**63 - 1, 4, 9, 9, -5])
    assert from_steps(steps(ids, sizes), sizes).tolist() == ids.tolist()


def test_an_entry_of_a_list_is_a_few_bytes(spark):
    rows = spark.range(40_000).select(F.floor(F.col("id") / 40).alias("user"), (F.xxhash64("id") % 50_000 + 50_000).alias("item"))
    rates = rows.distinct().withColumn("rate", F.col("item") % 50 + 1.0)
    rates = rates.join(item_weight(rates), "item")
    blobs = dealt_lists(rates, "user", "item", ("rate", "weight"), True, 2048, 1 << 20)
    size = blobs.agg(F.sum(F.length("lists"))).first()[0]
    batches = blobs.select("lists").toArrow().to_batches()
    entries = sum(len(lists.ids) for lists in read_lists(batches, 3, 2))
    assert entries > 1_500_000 and size < 6 * entries


@pytest.mark.parametrize("unseen", [False, True])
def test_no_row_per_scored_item_is_shuffled(spark, unseen):
    model = spark.createDataFrame([(0, 1, 0.5), (1, 0, 0.5)], "item_i BIGINT, item_j BIGINT, sim DOUBLE")
    recs = recommend(rates_frame(spark, skewed_rates()), model, 7, unseen)
    assert "hashpartitioning(user" not in plan(recs) and recs.count() > 0


def test_recommendations_for_histories_of_unknown_items(spark):
    model = spark.createDataFrame([(5, 6, 0.5)], "item_i BIGINT, item_j BIGINT, sim DOUBLE")
    history = spark.createDataFrame([(1, 5), (1, 6), (2, 5), (3, 9)], "user BIGINT, item BIGINT")
    got = sorted(map(tuple, recommend(history, model, 3, True).collect()))
    assert got == [(2, 6, 0.5, 1)]
    assert recommend(history, model.limit(0), 3).count() == 0 and recommend(history.limit(0), model, 3).count() == 0
