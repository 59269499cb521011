"""The registered queries: each runs one operator, or one whole pipeline, over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from affinis.functions.fixedpoint import from_units
from affinis.operators import evaluate as ev
from affinis.operators import itemcf, prepare, push, splits, swing, topk, walk
from affinis.operators.recommend import RECOMMENDATIONS, recommend
from affinis.session import materialize, new_path, release_shuffles, stack
from affinis.sources import bucketed, dimensions, interactions, model_store

Query = Callable[[SparkSession, str], DataFrame]

FOLDS = 5
NEIGHBOURS = 20
MAX_TEST = 1000
PUSH_ROUNDS = 30
WALK_ROUNDS = 10


def _orders(spark: SparkSession, folder: str) -> DataFrame:
    return interactions.order_interactions(spark, folder)


def _rates(spark: SparkSession, folder: str) -> DataFrame:
    """One row per (user, item), written once because every model reads it several times."""
    return materialize(prepare.max_rate(_orders(spark, folder)), "rates")


def _baskets(spark: SparkSession, folder: str) -> DataFrame:
    return materialize(prepare.distinct_interactions(_orders(spark, folder)), "baskets")


def _dense(spark: SparkSession, folder: str) -> DataFrame:
    return materialize(prepare.distinct_interactions(interactions.event_interactions(spark, folder)), "dense")


def _shown(df: DataFrame, column: str = "sim", places: int = 6) -> DataFrame:
    return df.withColumn(column, F.round(column, places))


# --- interactions, indexes, splits -------------------------------------------------------------


def interactions_raw(spark, folder):
    path = new_path(spark, "ratings-tsv")
    interactions.write_ratings(_orders(spark, folder), path)
    read = interactions.read_ratings(spark, path)
    return read.select("user", "item", "rate", F.unix_timestamp("ts").alias("ts"))


def interactions_preview(spark, folder):
    rates = prepare.max_rate(_orders(spark, folder)).select("user", "item", "rate")
    return topk.preview(rates, ["user", "item"], 5)


def interactions_max_rate(spark, folder):
    return prepare.max_rate(_orders(spark, folder)).select("user", "item", "rate")


def interactions_distinct(spark, folder):
    return prepare.distinct_interactions(_orders(spark, folder))


def interactions_events(spark, folder):
    return prepare.distinct_interactions(interactions.event_interactions(spark, folder))


def user_items_index(spark, folder):
    return prepare.members_index(_orders(spark, folder), "user", "item")


def item_users_index(spark, folder):
    return prepare.members_index(_orders(spark, folder), "item", "user")


def dataset_profile(spark, folder):
    return prepare.dataset_profile(materialize(prepare.distinct_interactions(_orders(spark, folder)), "distinct"))


def dim_scan(spark, folder):
    return dimensions.customer_dimension(spark, folder)


def split_kfold(spark, folder):
    return splits.k_fold(prepare.max_rate(_orders(spark, folder)), FOLDS).select("user", "item", "rate", "fold")


def _leave_n(start: int, stop: int, max_test: int = 0) -> Query:
    def query(spark, folder):
        labelled = splits.leave_n(_rates(spark, folder), start, stop, max_test)
        return labelled.select("user", "item", "rate", "part")

    return query


# --- pair tables -------------------------------------------------------------------------------


def item_cooccurrence(spark, folder):
    return itemcf.cooccurrence(_baskets(spark, folder))


def item_cooccurrence_min_support(spark, folder):
    return itemcf.cooccurrence(_baskets(spark, folder), min_support=3)


def user_cooccurrence(spark, folder):
    return swing.user_cooccurrence(_baskets(spark, folder))


def item_pair_shared_users(spark, folder):
    return swing.shared_users(_baskets(spark, folder))


def swing_quadruples(spark, folder):
    return swing.quadruples(_baskets(spark, folder))


# --- item similarity ---------------------------------------------------------------------------


def itemcf_item_weight(spark, folder):
    return itemcf.item_weight(prepare.max_rate(_orders(spark, folder)))


def itemcf_item_moments(spark, folder):
    moments = itemcf.item_moments(prepare.max_rate(_orders(spark, folder)))
    return _shown(_shown(moments, "mean"), "deviation")


def itemcf_overlap(spark, folder):
    return itemcf.overlap(_rates(spark, folder))


def _cosine_model(rates: DataFrame) -> DataFrame:
    return itemcf.neighbours(itemcf.cosine(rates, best=NEIGHBOURS), NEIGHBOURS, directed=True)


def _product_model(rates: DataFrame) -> DataFrame:
    return itemcf.neighbours(itemcf.raw_product(rates, best=NEIGHBOURS), NEIGHBOURS, directed=True)


def _pearson_model(rates: DataFrame) -> DataFrame:
    return itemcf.neighbours(itemcf.pearson(rates, best=NEIGHBOURS), NEIGHBOURS, directed=True)


def itemcf_pearson_events_topk(spark, folder):
    """Pearson on rates that are not whole numbers."""
    return _shown(_pearson_model(materialize(prepare.max_rate(interactions.event_interactions(spark, folder)), "rates")))


def _swing_model(rates: DataFrame) -> DataFrame:
    return swing.neighbours(swing.both_directions(swing.swing_pairs(rates.select("user", "item"))))


def _topk(model: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: _shown(model(_rates(spark, folder)))


def swing_pairs(spark, folder):
    sums = swing.swing_pairs(_baskets(spark, folder))
    return sums.select("item_i", "item_j", from_units(F.col("units")).alias("sim"))


def swing_min_support(spark, folder):
    sums = swing.swing_pairs(_baskets(spark, folder), min_support=3)
    return sums.select("item_i", "item_j", from_units(F.col("units")).alias("sim"))


def swing_ordered_topk(spark, folder):
    sums = swing.swing_pairs(_baskets(spark, folder), counting="ordered")
    return swing.neighbours(swing.both_directions(sums))


def _rounded_top50(spark, folder):
    sums = swing.rounded(swing.swing_pairs(_baskets(spark, folder), alpha=1.0), 5)
    return swing.neighbours(swing.both_directions(sums), 50)


def swing_alpha1_top50(spark, folder):
    return _rounded_top50(spark, folder)


def swing_neighbor_list(spark, folder):
    return topk.ranked_list(_rounded_top50(spark, folder), "item_i", "item_j", "sim_item_list")


def swing_firstseen_topk(spark, folder):
    placed = materialize(swing.with_first_seen(_rates(spark, folder)), "first-seen")
    return swing.neighbours(swing.first_seen_direction(swing.swing_pairs(placed, per_item=("first",))))


def swing_weighted_topk(spark, folder):
    sums = swing.swing_pairs(_baskets(spark, folder), user_weight="inverse_sqrt")
    return swing.neighbours(swing.both_directions(sums))


def swing_item_weighted_topk(spark, folder):
    """Item weight: one over the square root of the item's users."""
    baskets = _baskets(spark, folder)
    weight = baskets.groupBy("item").agg((F.lit(1.0) / F.sqrt(F.count(F.lit(1)))).alias("weight"))
    weighted = materialize(baskets.join(weight, "item"), "weighted")
    sums = swing.swing_pairs(weighted, per_item=("weight",))
    return swing.neighbours(swing.both_directions(swing.scaled(sums, "weight")))


def swing_dense_topk(spark, folder):
    sums = swing.swing_pairs(_dense(spark, folder))
    return swing.neighbours(swing.both_directions(sums))


# --- model store -------------------------------------------------------------------------------


def sim_model_map(spark, folder):
    """Neighbour maps as text: ``item_j:sim`` in rank order."""
    model = _cosine_model(_rates(spark, folder))
    maps = topk.ranked_map(model, "item_i", "item_j", "sim", "sims")
    entry = F.transform(
        F.map_entries("sims"),
        lambda e: F.concat(e["key"].cast("string"), F.lit(":"), F.round(e["value"] * 1e6).cast("bigint").cast("string")),
    )
    return maps.select("item_i", F.size("sims").alias("n"), F.concat_ws(",", entry).alias("sims"))


def sim_model_roundtrip(spark, folder):
    rates = _rates(spark, folder)
    stored = model_store.compute_or_load(rates, "cosine", 2, {"k": 20}, _cosine_model, new_path(spark, "models"))
    path = new_path(spark, "model-json")
    model_store.save_map_json(stored, path)
    return _shown(model_store.load_map_json(spark, path))


def sim_model_single_key_roundtrip(spark, folder):
    model = _swing_model(_rates(spark, folder))
    path = new_path(spark, "model-lines")
    model_store.save_single_key_json(model, path)
    return model_store.load_single_key_json(spark, path)


# --- recommendations and their quality ---------------------------------------------------------


def _recommend(model: Callable[[DataFrame], DataFrame], exclude_seen: bool = False) -> Query:
    def query(spark, folder):
        rates = _rates(spark, folder)
        similar = materialize(model(rates), "model")
        release_shuffles(spark)
        return recommend(rates, similar, RECOMMENDATIONS, exclude_seen)

    return query


def _held_out(spark, folder, model):
    train, test = splits.train_test(_rates(spark, folder), 1, 10)
    recs = _written_recommendations(train, model)
    return recs, train, test


def _written_recommendations(train: DataFrame, model: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Recommendations; what a step has shuffled goes before the next one is run, so the disk holds that of one step."""
    release_shuffles(train.sparkSession)
    similar = materialize(model(train), "model")
    release_shuffles(train.sparkSession)
    recs = materialize(recommend(train, similar), "recs")
    release_shuffles(train.sparkSession)
    return recs


def _evaluate(model: Callable[[DataFrame], DataFrame]) -> Query:
    def query(spark, folder):
        return ev.evaluate(*_held_out(spark, folder, model), RECOMMENDATIONS)

    return query


def _metric(read: Callable[[DataFrame], DataFrame]) -> Query:
    def query(spark, folder):
        return read(ev.evaluation_counts(*_held_out(spark, folder, _cosine_model)))

    return query


# --- random walk -------------------------------------------------------------------------------


def ppr_edges(spark, folder):
    return walk.edges(prepare.distinct_interactions(_orders(spark, folder)))


def ppr_transition(spark, folder):
    return _shown(walk.transition(_baskets(spark, folder)), "weight", 10)


def ppr_system_matrix(spark, folder):
    return _shown(walk.system_matrix(_baskets(spark, folder)), "value", 10)


def ppr_vertex_index(spark, folder):
    return walk.vertex_index(_baskets(spark, folder))


def _event_baskets(spark, folder):
    return materialize(prepare.distinct_interactions(interactions.event_interactions(spark, folder)), "dense")


def ppr_iterate(spark, folder):
    """Mass of every item's walk: what has settled and what still waits."""
    baskets = _event_baskets(spark, folder)
    return _shown(_shown(walk.mass(walk.item_walks(baskets), baskets), "settled", 8), "waiting", 8)


def ppr_moves(spark, folder):
    """What has settled in items and what waits there after ten double moves from every item, the walk by its definition."""
    baskets = _event_baskets(spark, folder)
    seeds = baskets.select(F.col("item").alias("seed")).distinct().select("seed", F.col("seed").alias("vertex"))
    state = walk.walk(seeds, walk.item_moves(baskets), 1 - walk.ALPHA, walk.ALPHA**2, WALK_ROUNDS)
    return _shown(_shown(state.withColumnRenamed("vertex", "item"), "settled", 9), "waiting", 9)


def ppr_converged(spark, folder):
    """The 100 vertices of highest rank in every item's walk."""
    baskets = _event_baskets(spark, folder)
    ranked = walk.ranks(walk.item_walks(baskets), baskets).withColumnRenamed("rank", "score")
    ranked = ranked.withColumn("_place", F.round("score", 9))
    best = topk.top_k(ranked, "seed", topk.best_first("_place", "vertex"), RECOMMENDATIONS)
    return _shown(best.select("seed", "vertex", "score", "rank"), "score")


def ppr_dense_converged(spark, folder):
    """Ranks of items in every user's walk."""
    baskets = _event_baskets(spark, folder)
    return _shown(walk.walks_of_users(walk.item_walks(baskets), baskets), "rank")


def ppr_residual(spark, folder):
    baskets = _event_baskets(spark, folder)
    return _shown(walk.residual(walk.item_walks(baskets), baskets), "residual", 8)


def _walk_recommendations(baskets: DataFrame) -> DataFrame:
    return walk.recommend_from_walk(walk.walks_of_users(walk.item_walks(baskets), baskets), baskets, RECOMMENDATIONS)


def ppr_recommend_topn(spark, folder):
    return _shown(_walk_recommendations(_event_baskets(spark, folder)), "score")


def recommendations_roundtrip(spark, folder):
    """Recommendations written to the store and read again."""
    path = new_path(spark, "recommendations")
    model_store.save_table(_walk_recommendations(_event_baskets(spark, folder)), path, "user")
    return _shown(spark.read.parquet(path), "score")


def eval_ppr(spark, folder):
    rates = materialize(prepare.max_rate(interactions.event_interactions(spark, folder)), "rates")
    train, test = splits.train_test(rates, 1, 10)
    recs = materialize(_walk_recommendations(train.select("user", "item")), "recs")
    return ev.evaluate(recs, train, test, RECOMMENDATIONS)


# --- walks of all users of the orders graph, by push -------------------------------------------


def ppr_push_recommend(spark, folder):
    """100 items for every customer, with the error that a score can have."""
    return push.recommend_by_push(_baskets(spark, folder), RECOMMENDATIONS, most=PUSH_ROUNDS)


def ppr_push_mass(spark, folder):
    """Mass of every customer's walk: what its ranks account for, and the rest."""
    _, mass = push.push_walks(_baskets(spark, folder), n=1, most=PUSH_ROUNDS)
    share = lambda c: (F.col(c) / F.lit(float(push.MASS))).alias(c)
    return mass.select(F.col("seed").alias("user"), share("units"), share("left"), "at_rest")


def eval_ppr_push(spark, folder):
    train, test = splits.train_test(_rates(spark, folder), 1, 10)
    recs = push.recommend_by_push(train, RECOMMENDATIONS, most=PUSH_ROUNDS)  # reads what the walks have written
    return ev.evaluate(recs, train, test, RECOMMENDATIONS)


# --- files as sources and sinks ----------------------------------------------------------------


def _text(df: DataFrame, path: str, *columns: Column, sep: str = "|") -> str:
    """Write columns as delimited lines; NULL is an empty field."""
    fields = [F.coalesce(c.cast("string"), F.lit("")) for c in columns]
    df.select(F.concat_ws(sep, *fields).alias("value")).write.text(path)
    return path


def dim_users_file(spark, folder):
    """Customers as a demographic file: age and gender made of their number, segment as occupation, name as zip code."""
    customer = spark.read.parquet(f"{folder}/customer.parquet")
    key = F.col("c_custkey")
    fields = [key, 18 + key % 60, F.when(key % 2 == 0, "F").otherwise("M"), F.col("c_mktsegment"), F.col("c_name")]
    return dimensions.read_users(spark, _text(customer, new_path(spark, "users"), *fields))


def dim_lists_file(spark, folder):
    """Nations as genres, segments as occupations, and totals of tables, each from a file of its own."""
    nation, customer = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("nation", "customer"))
    genres = dimensions.read_genres(spark, _text(nation, new_path(spark, "genres"), F.col("n_name"), F.col("n_nationkey")))
    jobs = customer.select("c_mktsegment").distinct()
    jobs = dimensions.read_occupations(spark, _text(jobs, new_path(spark, "jobs"), F.col("c_mktsegment")))
    counted = stack(*[t.agg(F.count(F.lit(1)).alias("n")).select("n", F.lit(x)) for t, x in ((nation, "nations"), (customer, "customers"))])
    totals = dimensions.read_totals(spark, _text(counted.toDF("n", "label"), new_path(spark, "totals"), F.col("n"), F.col("label"), sep=" "))
    kind = lambda k: F.lit(k).alias("kind")
    return stack(
        genres.select(kind("genre"), F.col("genre").alias("name"), F.col("idx").cast("bigint").alias("n")),
        jobs.select(kind("occupation"), "occupation", F.lit(None).cast("bigint")),
        totals.select(kind("total"), "label", "n"),
    )


def dim_items_file(spark, folder):
    """Parts as an item file with a flag per genre, read as the list of their genres."""
    part = spark.read.parquet(f"{folder}/part.parquet")
    flag = lambda i: ((F.col("p_partkey") % 19 == i) | (F.col("p_size") % 19 == i)).cast("int")
    fields = [F.col("p_partkey"), F.col("p_name"), F.lit("01-Jan-1995"), F.lit(""), F.col("p_type"), *[flag(i) for i in range(19)]]
    items = dimensions.read_items(spark, _text(part, new_path(spark, "items"), *fields))
    return items.select("item", "title", "url", F.concat_ws(",", F.col("genres").cast("array<string>")).alias("genres"))


def interactions_ingest(spark, folder):
    """Lines by what is wrong with them, of a file in which some have no item, user, rate or second field."""
    rows = _orders(spark, folder)
    item = F.when(F.col("item") % 50 == 0, F.concat(F.lit("x"), F.col("item"))).otherwise(F.col("item").cast("string"))
    user = F.when(F.col("user") % 77 == 0, "").otherwise(F.col("user").cast("string"))
    rate = F.when(F.col("rate") == 13, "?").otherwise(F.col("rate").cast("string"))
    line = F.concat_ws("\t", user, item, rate, F.unix_timestamp("ts").cast("string"))
    path = new_path(spark, "lines")
    rows.select(F.when(F.col("item") % 61 == 1, user).otherwise(line).alias("value")).write.text(path)
    got = interactions.ingest_ratings(spark, path, new_path(spark, "ingested"))
    found = got.bad.groupBy("problem").agg(F.count(F.lit(1)).alias("n"))
    good = got.good.agg(F.lit("none").alias("problem"), F.count(F.lit(1)).alias("n"))
    told = spark.createDataFrame([("lines", got.lines), ("kept", got.kept), ("rejected", got.rejected)], "problem STRING, n BIGINT")
    return stack(found, good, told)


def _in_file_order(spark, folder):
    """Ratings read from files whose lines are in an order of their own, by a digest."""
    rates = _rates(spark, folder)
    path = new_path(spark, "ordered")
    digest = F.md5(F.concat_ws(":", F.col("user").cast("string"), F.col("item").cast("string")))
    line = F.concat_ws("\t", *[F.col(c).cast("string") for c in ("user", "item", "rate")], F.unix_timestamp("ts").cast("string"))
    ordered = rates.select(line.alias("value"), digest.alias("d")).repartitionByRange("d").sortWithinPartitions("d")
    ordered.select("value").write.text(path)
    return materialize(interactions.read_ratings_in_order(spark, path), "ordered")


def split_leave_n_file_order(spark, folder):
    labelled = splits.leave_n(_in_file_order(spark, folder), 1, 10, order=("position",))
    return labelled.select("user", "item", "rate", "part")


def split_kfold_file_order(spark, folder):
    return splits.k_fold(_in_file_order(spark, folder), FOLDS, ("position",)).select("user", "item", "rate", "fold")


def split_sorted_write(spark, folder):
    """Positions of rows in files that have been written in order of user and item."""
    path = new_path(spark, "sorted")
    splits.write_sorted(_baskets(spark, folder), path)
    return interactions.in_source_order(spark, path, "parquet").select("user", "item", "position")


def dataset_profile_sketches(spark, folder):
    """Distinct users and items from stored sketches of months, and whether they are within four hundredths of the truth."""
    rows = _orders(spark, folder)
    sketches = materialize(prepare.distinct_sketches(rows, F.trunc("ts", "month")), "sketches")
    exact = prepare.dataset_profile(rows).select(F.col("n_users").alias("users"), F.col("n_items").alias("items"))
    told = prepare.profile_of_sketches(sketches).select("n_rows", "n_users", "n_items", F.lit(1).alias("one"))
    both = told.join(exact.withColumn("one", F.lit(1)), "one")
    close = lambda c, x: (F.abs(F.col(c) - F.col(x)) * 100 <= 4 * F.col(x)).alias(f"{x}_close")
    return both.select("n_rows", close("n_users", "users"), close("n_items", "items"))


def recommend_bucketed_roundtrip(spark, folder):
    """Recommendations from a stored model, stored by user and read again, both in buckets."""
    rates = _rates(spark, folder)
    model = bucketed.write_bucketed(_cosine_model(rates), new_path(spark, "model-buckets"), "item_i", "rank")
    path = new_path(spark, "recs-buckets")
    bucketed.write_bucketed(recommend(rates, model, RECOMMENDATIONS), path, "user", "rank")
    return bucketed.open_bucketed(spark, path)


def eval_percent(spark, folder):
    """Metrics of the item model as they are printed."""
    return ev.as_percent(ev.evaluate(*_held_out(spark, folder, _cosine_model), RECOMMENDATIONS))


QUERIES: dict[str, Query] = {
    "interactions_raw": interactions_raw,
    "interactions_preview": interactions_preview,
    "interactions_max_rate": interactions_max_rate,
    "interactions_distinct": interactions_distinct,
    "interactions_events": interactions_events,
    "user_items_index": user_items_index,
    "item_users_index": item_users_index,
    "dataset_profile": dataset_profile,
    "dim_scan": dim_scan,
    "split_kfold": split_kfold,
    "split_leave_n_a": _leave_n(1, 10),
    "split_leave_n_b": _leave_n(11, 20),
    "split_leave_n_capped": _leave_n(1, 10, MAX_TEST),
    "item_cooccurrence": item_cooccurrence,
    "item_cooccurrence_min_support": item_cooccurrence_min_support,
    "user_cooccurrence": user_cooccurrence,
    "item_pair_shared_users": item_pair_shared_users,
    "swing_quadruples": swing_quadruples,
    "itemcf_item_weight": itemcf_item_weight,
    "itemcf_item_moments": itemcf_item_moments,
    "itemcf_overlap": itemcf_overlap,
    "itemcf_cosine_topk": _topk(_cosine_model),
    "itemcf_rawproduct_topk": _topk(_product_model),
    "itemcf_pearson_topk": _topk(_pearson_model),
    "itemcf_pearson_events_topk": itemcf_pearson_events_topk,
    "swing_pairs": swing_pairs,
    "swing_min_support": swing_min_support,
    "swing_topk": lambda spark, folder: _swing_model(_baskets(spark, folder)),
    "swing_ordered_topk": swing_ordered_topk,
    "swing_alpha1_top50": swing_alpha1_top50,
    "swing_neighbor_list": swing_neighbor_list,
    "swing_firstseen_topk": swing_firstseen_topk,
    "swing_weighted_topk": swing_weighted_topk,
    "swing_item_weighted_topk": swing_item_weighted_topk,
    "swing_dense_topk": swing_dense_topk,
    "sim_model_map": sim_model_map,
    "sim_model_roundtrip": sim_model_roundtrip,
    "sim_model_single_key_roundtrip": sim_model_single_key_roundtrip,
    "recommend_itemcf_cosine": _recommend(_cosine_model),
    "recommend_itemcf_pearson": _recommend(_pearson_model),
    "recommend_swing": _recommend(_swing_model),
    "recommend_swing_unseen": _recommend(_swing_model, exclude_seen=True),
    "eval_precision": _metric(lambda counts: ev.precision(counts, RECOMMENDATIONS)),
    "eval_recall": _metric(ev.recall),
    "eval_coverage": _metric(ev.coverage),
    "eval_itemcf_cosine": _evaluate(_cosine_model),
    "eval_itemcf_pearson": _evaluate(_pearson_model),
    "eval_swing": _evaluate(_swing_model),
    "ppr_edges": ppr_edges,
    "ppr_transition": ppr_transition,
    "ppr_system_matrix": ppr_system_matrix,
    "ppr_vertex_index": ppr_vertex_index,
    "ppr_iterate": ppr_iterate,
    "ppr_moves": ppr_moves,
    "ppr_converged": ppr_converged,
    "ppr_dense_converged": ppr_dense_converged,
    "ppr_residual": ppr_residual,
    "ppr_recommend_topn": ppr_recommend_topn,
    "recommendations_roundtrip": recommendations_roundtrip,
    "eval_ppr": eval_ppr,
    "ppr_push_recommend": ppr_push_recommend,
    "ppr_push_mass": ppr_push_mass,
    "eval_ppr_push": eval_ppr_push,
    "dim_users_file": dim_users_file,
    "dim_lists_file": dim_lists_file,
    "dim_items_file": dim_items_file,
    "interactions_ingest": interactions_ingest,
    "split_leave_n_file_order": split_leave_n_file_order,
    "split_kfold_file_order": split_kfold_file_order,
    "split_sorted_write": split_sorted_write,
    "dataset_profile_sketches": dataset_profile_sketches,
    "recommend_bucketed_roundtrip": recommend_bucketed_roundtrip,
    "eval_percent": eval_percent,
}
