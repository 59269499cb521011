import random

import pytest

from affinis.operators import splits


@pytest.fixture(scope="module")
def history(spark):
    rng = random.Random(1)
    rows = {(rng.randint(0, 12), rng.randint(0, 60)): rng.randint(0, 9) for _ in range(300)}
    data = [(u, i, 1.0, t) for (u, i), t in rows.items()] + [(99, i, 1.0, 5) for i in range(150)]
    return spark.createDataFrame(data, "user BIGINT, item BIGINT, rate DOUBLE, ts BIGINT"), data


def ordered(data):
    return sorted(data, key=lambda r: (r[3], r[0], r[1]))


@pytest.mark.parametrize("n", [1, 5, 23])
def test_positions_and_folds(history, partitions, n):
    partitions(n)
    frame, data = history
    placed = splits.with_position(frame, splits.GLOBAL_ORDER).collect()
    assert [(r.user, r.item) for r in sorted(placed, key=lambda r: r.position)] == [r[:2] for r in ordered(data)]
    assert sorted(r.position for r in placed) == list(range(1, len(data) + 1))
    size = -(-len(data) // 5)
    want = {r[:2]: at // size + 1 for at, r in enumerate(ordered(data))}
    assert {(r.user, r.item): r.fold for r in splits.k_fold(frame, 5).collect()} == want


@pytest.mark.parametrize("start,stop,cap", [(1, 10, 0), (11, 20, 0), (1, 10, 37)])
def test_leave_n(history, start, stop, cap):
    frame, data = history
    held, place = [], {}
    for row in sorted(data, key=lambda r: (r[3], r[1])):
        place[row[0]] = place.get(row[0], 0) + 1
        if start <= place[row[0]] <= stop:
            held.append(row)
    held = ordered(held)[: cap or None]
    train, test = splits.train_test(frame, start, stop, cap)
    assert {(r.user, r.item) for r in test.collect()} == {r[:2] for r in held}
    assert train.count() + test.count() == len(data)
    assert train.join(test, ["user", "item"]).count() == 0


def test_sorted_write(spark, history, tmp_path):
    frame, data = history
    splits.write_sorted(frame, str(tmp_path / "sorted"))
    back = spark.read.parquet(str(tmp_path / "sorted"))
    assert {tuple(r) for r in back.collect()} == set(data)
