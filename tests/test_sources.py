import datetime
from pathlib import Path
from types import SimpleNamespace

import pytest

from affinis import session
from affinis.sources import dimensions, interactions, model_store

MODEL = [(1, 5, 0.9, 1), (1, 3, 0.25, 2), (2, 3, 0.5, 1)]


@pytest.fixture
def model(spark):
    return spark.createDataFrame(MODEL, model_store.MODEL_SCHEMA)


def test_ratings_text(spark, tmp_path):
    path = tmp_path / "ratings"
    path.write_text("7\t7\t3\t881250949\nbad\t1\t2\t3\n8\t9\tx\t\n")
    rows = interactions.read_ratings(spark, str(path)).orderBy("user").collect()
    assert [tuple(r)[:3] for r in rows] == [(7, 7, 3.0), (8, 9, None)]
    assert rows[0].ts == datetime.datetime(1997, 12, 4, 15, 55, 49) and rows[1].ts is None
    interactions.write_ratings(interactions.read_ratings(spark, str(path)), str(tmp_path / "copy"))
    again = interactions.read_ratings(spark, str(tmp_path / "copy"))
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, rows))


def test_dimension_files(spark, tmp_path):
    for name, text in {
        "users": "1|24|M|technician|85711\n74|39|M|scientist|T8H1N\n",
        "genres": "unknown|0\nAction|1\n\n",
        "jobs": "artist\nother\n",
        "totals": "943 users\n1682 items\n",
        "items": "1|A film (1995)|01-Jan-1995||http://x|0|1|0|1\n",
    }.items():
        (tmp_path / name).write_text(text)
    path = lambda name: str(tmp_path / name)
    assert [r.zip for r in dimensions.read_users(spark, path("users")).orderBy("user").collect()] == ["85711", "T8H1N"]
    assert {tuple(r) for r in dimensions.read_genres(spark, path("genres")).collect()} == {("unknown", 0), ("Action", 1)}
    assert {r.occupation for r in dimensions.read_occupations(spark, path("jobs")).collect()} == {"artist", "other"}
    assert {tuple(r) for r in dimensions.read_totals(spark, path("totals")).collect()} == {(943, "users"), (1682, "items")}
    assert dimensions.read_items(spark, path("items"), 4).first().genres == [1, 3]


def test_model_json_forms(spark, model, tmp_path):
    model_store.save_map_json(model, str(tmp_path / "map"))
    assert sorted(map(tuple, model_store.load_map_json(spark, str(tmp_path / "map")).collect())) == sorted(MODEL)
    model_store.save_single_key_json(model, str(tmp_path / "lines"))
    assert '{"2":{"3":0.5}}' in {r.value for r in spark.read.text(str(tmp_path / "lines")).collect()}
    assert sorted(map(tuple, model_store.load_single_key_json(spark, str(tmp_path / "lines")).collect())) == sorted(MODEL)


def test_model_is_built_once_per_input_and_parameters(spark, model, tmp_path):
    built = []

    def build(rows):
        built.append(1)
        return rows

    for version, params in ((1, {"k": 1}), (1, {"k": 1}), (1, {"k": 2}), (2, {"k": 2})):
        got = model_store.compute_or_load(model, "test", version, params, build, str(tmp_path))
        assert sorted(map(tuple, got.collect())) == sorted(MODEL)
    model_store.compute_or_load(model.where("rank = 1"), "test", 1, {"k": 1}, build, str(tmp_path))
    model_store.compute_or_load(model, "other", 1, {"k": 1}, build, str(tmp_path))
    assert len(built) == 5


def test_tables_are_in_the_shared_folder_and_go_when_replaced(spark):
    folder = Path(spark.sparkContext.getConf().get("spark.checkpoint.dir"))
    assert session.shared_dir(spark) == str(folder)
    first = session.materialize(spark.range(5), "five")
    assert first.count() == 5
    mine = Path(session.job_dir(spark))
    assert mine.parent == folder and any(path.name.startswith("five-") for path in mine.iterdir())
    before = len(list(mine.iterdir()))
    second = session.materialize(first, "six", instead_of=first)
    assert second.count() == 5 and len(list(mine.iterdir())) == before


def test_without_a_shared_folder_the_warehouse_is_used():
    unset = SimpleNamespace(conf={"spark.sql.warehouse.dir": "hdfs://somewhere/warehouse"})
    assert session.shared_dir(unset) == "hdfs://somewhere/warehouse"
