import pytest

from affinis.operators import evaluate as ev
from affinis.operators import recommend as rc
from affinis.operators.recommend import recommend
from tests.conftest import histories, rates_frame, skewed_rates


def model_frame(spark):
    rows = [(i, (i + d) % 30, 1.0 / (d + i % 3), d) for i in range(0, 30, 2) for d in (1, 2, 3, 4)]
    return spark.createDataFrame(rows, "item_i BIGINT, item_j BIGINT, sim DOUBLE, rank INT"), rows


def brute(rates, rows, n, unseen):
    out = {}
    for user, seen in histories(rates).items():
        score = {}
        for i, j, sim, _ in rows:
            if i in seen and not (unseen and j in seen):
                score[j] = score.get(j, 0) + int(sim * 1e10 + 0.5)
        out[user] = [j for _, j in sorted((-s, j) for j, s in score.items())[:n]]
    return {u: items for u, items in out.items() if items}


def test_recommendations(spark):
    rates = skewed_rates()
    model, rows = model_frame(spark)
    for unseen in (False, True):
        got = {}
        for r in recommend(rates_frame(spark, rates), model, 7, unseen).orderBy("user", "rank").collect():
            got.setdefault(r.user, []).append(r.item)
        assert got == brute(rates, rows, 7, unseen)


def test_metrics(spark):
    train = spark.createDataFrame([(1, 10), (1, 11), (2, 10), (3, 12), (4, 13)], "user BIGINT, item BIGINT")
    test = spark.createDataFrame([(1, 20), (1, 21), (2, 22), (4, 20), (9, 20), (9, 11)], "user BIGINT, item BIGINT")
    # User 3 has no held-out items, 4 no recommendations, 9 is not in train.
    recs = spark.createDataFrame(
        [(1, 20), (1, 11), (2, 20), (2, 23), (3, 24), (9, 20)], "user BIGINT, item BIGINT"
    )
    row = ev.evaluate(recs, train, test, 5).first()
    assert (row.hits, row.slots, row.test_items, row.recommended_items, row.train_items) == (1, 10, 3, 4, 4)
    assert (row.precision, row.recall, row.coverage) == (0.1, 1 / 3, 1.0)
    text = ev.as_percent(ev.evaluate(recs, train, test, 5)).first()
    assert text.recall == "33.3333%" and text.precision.startswith("10.0")
    counts = ev.evaluation_counts(recs, train, test)
    assert ev.precision(counts, 5).first().precision == 0.1
    assert ev.recall(counts).first().hits == 1
    assert ev.coverage(counts).first().train_items == 4


def test_nothing_to_measure_is_null(spark):
    empty = spark.createDataFrame([], "user BIGINT, item BIGINT")
    row = ev.evaluate(empty, empty, empty, 5).first()
    assert (row.hits or 0) == 0 and row.precision is None and row.recall is None and row.coverage is None
    assert ev.as_percent(ev.evaluate(empty, empty, empty, 5)).first().recall is None


def test_shuffle_files_of_finished_steps_are_released(spark, monkeypatch):
    """Before a step of an evaluation is run, Spark is told to drop what the steps before it have shuffled."""
    from affinis.plans import queries

    done, keep = [], queries.materialize
    monkeypatch.setattr(queries, "materialize", lambda df, label="table", **more: done.append(label) or keep(df, label, **more))
    monkeypatch.setattr(queries, "release_shuffles", lambda session: done.append("release"))
    few = lambda rates: rates.selectExpr("item AS item_i", "item + 1 AS item_j", "0.5D AS sim").distinct()
    recs, train, test = queries._held_out(spark, "/root/testdata/sf0.001", few)
    assert recs.count() and train.count() and test.count()
    assert done == ["rates", "release", "model", "release", "recs", "release"]


@pytest.mark.parametrize("unseen", [False, True])
def test_passes_give_the_same_recommendations(spark, unseen):
    model, _ = model_frame(spark)
    rates = rates_frame(spark, skewed_rates())
    assert sorted(recommend(rates, model, 7, unseen, pass_entries=400).collect()) == sorted(recommend(rates, model, 7, unseen).collect())


def test_rows_are_shuffled_once_to_be_counted(spark):
    rates = rates_frame(spark, skewed_rates(5))
    counts = ev.evaluation_counts(rates, rates, rates)
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(user" in plan
    assert not [line for line in plan.splitlines() if "hashpartitioning(user" in line and "item" in line.split("hashpartitioning(user")[1].split(")")[0]]


@pytest.mark.parametrize("unseen", [False, True])
@pytest.mark.parametrize("pass_entries,held", [(1 << 25, 1 << 20), (97, 5), (97, 1 << 20)])
def test_users_of_an_item_are_packed_and_its_neighbours_joined_once(spark, monkeypatch, unseen, pass_entries, held):
    """Also where an item's users are several rows, and users are dealt into passes."""
    monkeypatch.setattr(rc, "ROW_USERS", 4)
    monkeypatch.setattr(rc, "HELD_PAIRS", held)
    rates = skewed_rates(5)
    model, rows = model_frame(spark)
    joined = []
    monkeypatch.setattr(rc, "_ranked", lambda packed, *rest, call=rc._ranked: joined.append(packed.count()) or call(packed, *rest))
    recs = recommend(rates_frame(spark, rates), model, 7, unseen, pass_entries)
    got = {}
    for r in sorted(recs.collect(), key=lambda r: r["rank"]):
        got.setdefault(r.user, []).append(r.item)
    assert got == {u: items for u, items in brute(rates, rows, 7, unseen).items() if items}
    assert joined[0] < len(rates) and (len(joined) > 1) == (pass_entries == 97)


def test_users_are_counted_in_tasks(spark, monkeypatch):
    """Repeated and unknown users and items count as before, in any number of tasks, and no table of users and items is aggregated."""
    monkeypatch.setattr(ev, "TASK_ROWS", 3)
    frame = lambda rows: spark.createDataFrame(rows, "user BIGINT, item BIGINT")
    recs = frame([(1, 0), (1, 0), (1, 5), (2, None), (2, 7), (None, 4), (3, 1), (4, 2)])
    test = frame([(1, 0), (1, 9), (1, 9), (2, None), (2, 0), (None, 4), (3, 1), (5, 2)])
    train = frame([(1, 2), (1, 3), (2, 2), (None, 1), (4, 4), (5, 5)])
    counts = ev.evaluation_counts(recs, train, test)
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert not [line for line in plan.splitlines() if "HashAggregate(keys=[user#" in line and "item" in line.split("]")[0] and "mark" not in line and "max(" in line]
    row = counts.first()
    assert (row.hits, row.users, row.test_items) == (3, 3, 5)  # users 1, 2 and NULL
