"""Bucketed tables, models published by two builders, rejected lines, source order, sketches."""

import threading
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from affinis import session
from affinis.operators import prepare, splits
from affinis.operators.itemcf import cosine, neighbours
from affinis.operators.recommend import recommend
from affinis.sources import bucketed, interactions, model_store
from tests.conftest import rates_frame, skewed_rates


def exchanges(df):
    """What each shuffle of a plan is dealt by."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line.strip() for line in plan.splitlines() if "Exchange hashpartitioning" in line]


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_a_stored_model_is_joined_without_an_exchange(spark, no_broadcast):
    rates = session.materialize(rates_frame(spark, skewed_rates()))
    model = session.materialize(neighbours(cosine(rates), 5))
    stored = bucketed.write_bucketed(model, session.new_path(spark, "model"), "item_i", "rank")
    plain, with_buckets = recommend(rates, model, 7), recommend(rates, stored, 7)
    by_item = lambda df: [x for x in exchanges(df) if "(item" in x]
    assert len(by_item(plain)) == 2 and len(by_item(with_buckets)) == 1
    assert sorted(map(tuple, with_buckets.collect())) == sorted(map(tuple, plain.collect()))


def test_reading_by_the_key_of_the_buckets_needs_no_shuffle(spark, no_broadcast):
    rates = rates_frame(spark, skewed_rates())
    path = session.new_path(spark, "recs")
    stored = bucketed.write_bucketed(rates, path, "user", "item", buckets=4)
    assert exchanges(stored.groupBy("user").agg(F.count(F.lit(1)))) == []
    assert exchanges(stored.join(bucketed.open_bucketed(spark, path), "user")) == []


def test_a_bucketed_table_is_opened_by_another_session(spark, tmp_path):
    rows = [(i % 5, i, None if i == 3 else "x", [i]) for i in range(40)]
    df = spark.createDataFrame(rows, "`a key` BIGINT, n INT, s STRING, many ARRAY<INT>")
    path = f"{tmp_path}/table"
    bucketed.write_bucketed(df, path, "a key", "n", buckets=3)
    spark.sql(f"DROP TABLE {bucketed._name(path)}")  # the catalog of a session that ended; files of a path stay
    again = bucketed.open_bucketed(spark, path)
    assert again.schema.simpleString() == df.schema.simpleString()
    assert sorted(map(str, again.collect())) == sorted(map(str, df.collect()))
    assert exchanges(again.groupBy("a key").agg(F.sum("n"))) == []
    with pytest.raises(ValueError):
        bucketed.write_bucketed(df, path, "a key")


def test_two_builders_leave_one_whole_model(spark, tmp_path):
    rates = session.materialize(rates_frame(spark, skewed_rates()))
    together, found = threading.Barrier(2), {}

    def build(rows):
        model = neighbours(cosine(rows), 5)
        together.wait(60)  # both have seen that there is no model
        return model

    def builder(name):
        stored = model_store.compute_or_load(rates, "cosine", 1, {"k": 5}, build, str(tmp_path))
        found[name] = sorted(map(tuple, stored.collect()))

    threads = [threading.Thread(target=builder, args=(n,)) for n in "ab"]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert found["a"] == found["b"] == sorted(map(tuple, neighbours(cosine(rates), 5).collect()))
    assert len(list((tmp_path / "models").iterdir())) == 1 and not list((tmp_path / "models-in-work").iterdir())


def test_publish_never_replaces(spark, tmp_path):
    for name in ("one", "two"):
        spark.range(3 if name == "one" else 5).write.parquet(f"{tmp_path}/{name}")
    assert session.publish(spark, f"{tmp_path}/one", f"{tmp_path}/deep/target")
    assert not session.publish(spark, f"{tmp_path}/two", f"{tmp_path}/deep/target")
    assert spark.read.parquet(f"{tmp_path}/deep/target").count() == 3
    assert not session.exists(spark, f"{tmp_path}/two") and not session.exists(spark, f"{tmp_path}/one")


LINES = {
    "1\t2\t3.5\t100": None, "1\t2": None, "1\t2\t\t": None, " 7 \t8\t1\t5\textra": None, "": "blank", "   ": "blank", "5": "fields",
    "x\t2\t3\t4": "user", "\t2\t3\t4": "user", "1\t\t3\t4": "item", "1\t2.5\t3\t4": "item", "1\t2\tmany\t4": "rate", "1\t2\t3\tnow": "ts",
    "99999999999999999999\t2": "user",
}


def test_good_and_bad_lines_add_up_in_one_pass(spark, tmp_path):
    (tmp_path / "lines").write_text("\n".join(LINES) + "\n")
    got = interactions.ingest_ratings(spark, str(tmp_path / "lines"), f"{tmp_path}/out")
    assert (got.lines, got.kept, got.rejected) == (14, 4, 10)
    assert got.good.count() == got.kept and got.bad.count() == got.rejected
    assert {r.value: r.problem for r in got.bad.collect()} == {v: p for v, p in LINES.items() if p}
    rows = [(r.user, r.item, r.rate, r.ts is None) for r in got.good.collect()]
    assert sorted(map(str, rows)) == sorted(map(str, [(1, 2, 3.5, False), (1, 2, None, True), (1, 2, None, True), (7, 8, 1.0, False)]))


def test_an_empty_file_has_no_lines(spark, tmp_path):
    (tmp_path / "lines").write_text("")
    got = interactions.ingest_ratings(spark, str(tmp_path / "lines"), f"{tmp_path}/out")
    assert (got.lines, got.kept, got.rejected, got.good.count(), got.bad.count()) == (0, 0, 0, 0, 0)


@pytest.mark.parametrize("block", ["64", "1000", "1000000"])
def test_positions_follow_files_and_lines_whatever_the_blocks(spark, tmp_path, block):
    lines = [f"{n % 7}\t{n}\t1\t{1000 - n}" for n in range(300)]
    (tmp_path / "in").mkdir()
    for part in range(3):
        (tmp_path / "in" / f"part-{part}").write_text("\n".join(lines[100 * part : 100 * part + 100]) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", block)
    try:
        rows = interactions.read_ratings_in_order(spark, str(tmp_path / "in"))
        assert [(r.position, r.item) for r in rows.orderBy("position").collect()] == [(n + 1, n) for n in range(300)]
        held = splits.leave_n(rows, 2, 3, order=("position",)).where("part = 'test'").collect()
        want = {(u, i) for u in range(7) for i in [n for n in range(300) if n % 7 == u][1:3]}
        assert {(r.user, r.item) for r in held} == want
        folds = splits.k_fold(rows, 5, ("position",)).collect()
        assert all(r.fold == r.item // 60 + 1 for r in folds)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_sketches_of_days_add_up(spark):
    rows = spark.range(60_000).selectExpr("(id * 7919) % 20000 AS user", "id % 5000 AS item", "id % 6 AS day")
    sketches = session.materialize(prepare.distinct_sketches(rows, F.col("day")))
    whole = prepare.profile_of_sketches(sketches).first()
    assert whole.n_rows == 60_000 and abs(whole.n_users - 20_000) < 600 and abs(whole.n_items - 5000) < 150
    # a further day is one more row of the stored table
    more = prepare.distinct_sketches(spark.range(100).selectExpr("id + 1000000 AS user", "id AS item", "6L AS day"), F.col("day"))
    grown = prepare.profile_of_sketches(session.stack(sketches, more)).first()
    assert grown.n_rows == 60_100 and 0 < grown.n_users - whole.n_users < 300
    assert tuple(prepare.profile_of_sketches(sketches.limit(0)).first()) == (0, 0, 0)


def test_a_local_warehouse_is_no_shared_folder_of_a_cluster(spark, monkeypatch):
    class Cluster:
        conf, sparkContext, _jvm = {"spark.sql.warehouse.dir": "file:/tmp/warehouse"}, None, spark._jvm

    class Context:
        master, _jsc = "yarn", spark.sparkContext._jsc

    Cluster.sparkContext = Context()
    Cluster.conf = type("C", (), {"get": staticmethod(lambda k, d=None: {"spark.sql.warehouse.dir": "file:/tmp/warehouse"}.get(k, d))})
    with pytest.raises(ValueError):
        session.shared_dir(Cluster())
    Context.master = "local[4]"
    assert session.shared_dir(Cluster()) == "file:/tmp/warehouse"


def test_a_written_table_leaves_no_shuffle_files(spark):
    folders = [Path(str(d)) for d in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]
    files = lambda: {f.name for d in folders for f in d.rglob("shuffle_*.data")}
    before = files()
    table = session.materialize(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "counted")
    assert not files() - before
    assert table.count() == 7 and session.materialize(table, "again") is table
