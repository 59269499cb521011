"""Readers for interaction tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from affinis.operators.splits import with_position

COLUMNS = ("user", "item", "rate", "ts")


def read_ratings(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated ``user, item, rate, unix seconds`` without a header.

    Fields that are not numbers become NULL instead of failing the job; rows
    without a user or an item cannot be used by any model and are left out.
    """
    text = spark.read.schema("user STRING, item STRING, rate STRING, ts STRING").option("sep", "\t").csv(path)
    return text.select(
        F.col("user").try_cast("bigint").alias("user"),
        F.col("item").try_cast("bigint").alias("item"),
        F.col("rate").try_cast("double").alias("rate"),
        F.timestamp_seconds(F.col("ts").try_cast("bigint")).alias("ts"),
    ).where("user IS NOT NULL AND item IS NOT NULL")


def with_problem(lines: DataFrame) -> DataFrame:
    """Lines of text (``value``) as ratings, with ``problem``: why a line cannot be used, or NULL.

    A rating needs a user and an item. A rate or a time that is no number is a
    problem if something is written there; left empty or out, it is NULL.
    """
    part = F.split("value", "\t", -1)
    field = lambda n: F.when(F.size(part) > n, F.trim(F.get(part, F.lit(n))))
    number = lambda n, kind: field(n).try_cast(kind)
    wrong = lambda n, kind: number(n, kind).isNull() & (F.coalesce(field(n), F.lit("")) != "")
    problem = (
        F.when(F.trim("value") == "", "blank")
        .when(F.size(part) < 2, "fields")
        .when(number(0, "bigint").isNull(), "user")
        .when(number(1, "bigint").isNull(), "item")
        .when(wrong(2, "double"), "rate")
        .when(wrong(3, "bigint"), "ts")
    )
    return lines.select(
        "*",
        number(0, "bigint").alias("user"),
        number(1, "bigint").alias("item"),
        number(2, "double").alias("rate"),
        F.timestamp_seconds(number(3, "bigint")).alias("ts"),
        problem.alias("problem"),
    )


@dataclass
class Ingested:
    """Ratings, the lines that are none with their problem, and how many lines were read, kept and rejected."""

    good: DataFrame
    bad: DataFrame
    lines: int
    kept: int
    rejected: int


def ingest_ratings(spark: SparkSession, path: str, out: str) -> Ingested:
    """Read tab-separated ratings and store them at ``out``, good and bad lines apart; the text is read once.

    Counts are taken while the lines pass, so they are of what has been written.
    """
    counts = Observation()
    bad = F.count_if(F.col("problem").isNotNull())
    rows = with_problem(spark.read.text(path)).withColumn("usable", F.col("problem").isNull())
    rows = rows.observe(counts, F.count(F.lit(1)).alias("lines"), bad.alias("rejected"))
    keep = F.when(~F.col("usable"), F.col("value")).alias("value")
    rows.select(*COLUMNS, keep, "problem", "usable").write.partitionBy("usable").parquet(out)
    read = spark.read.schema("user BIGINT, item BIGINT, rate DOUBLE, ts TIMESTAMP, value STRING, problem STRING, usable BOOLEAN")
    stored, found = read.parquet(out), counts.get
    return Ingested(
        stored.where("usable").select(*COLUMNS),
        stored.where("NOT usable").select("value", "problem"),
        found["lines"],
        found["lines"] - found["rejected"],
        found["rejected"],
    )


def in_source_order(spark: SparkSession, path: str, kind: str = "text") -> DataFrame:
    """Rows of text or parquet files with ``position``, 1-based, in the order of file names and of rows inside of files.

    Inside a file, rows are in order of their block, and of their place in the
    block; a task reads a block from its start to its end. Positions are written once.
    """
    read = spark.read.text(path) if kind == "text" else spark.read.parquet(path)
    at = [F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block")]
    placed = read.select("*", *at).withColumn("_row", F.monotonically_increasing_id())
    return with_position(placed, ("_file", "_block", "_row")).drop("_file", "_block", "_row")


def read_ratings_in_order(spark: SparkSession, path: str) -> DataFrame:
    """``read_ratings`` with ``position``, the number of the line over all files, for splits in the order of the source."""
    rows = with_problem(in_source_order(spark, path))
    return rows.where("user IS NOT NULL AND item IS NOT NULL").select(*COLUMNS, "position")


def write_ratings(interactions: DataFrame, path: str) -> None:
    seconds = F.unix_timestamp(F.col("ts").cast("timestamp"))
    interactions.select("user", "item", "rate", seconds).write.option("sep", "\t").csv(path)


def from_table(df: DataFrame, user: str, item: str, rate: str | None = None, ts: str | None = None) -> DataFrame:
    """Any table as canonical interactions, by column names."""
    return df.select(
        F.col(user).cast("bigint").alias("user"),
        F.col(item).cast("bigint").alias("item"),
        (F.col(rate).cast("double") if rate else F.lit(1.0)).alias("rate"),
        (F.col(ts) if ts else F.lit(None).cast("timestamp")).alias("ts"),
    )


def order_interactions(spark: SparkSession, folder: str) -> DataFrame:
    """Customers and the parts they ordered; the quantity is the rate."""
    orders = spark.read.parquet(f"{folder}/orders.parquet").select("o_orderkey", "o_custkey", "o_orderdate")
    lines = spark.read.parquet(f"{folder}/lineitem.parquet").select("l_orderkey", "l_partkey", "l_quantity")
    bought = orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
    return from_table(bought, "o_custkey", "l_partkey", "l_quantity", "o_orderdate")


def event_interactions(spark: SparkSession, folder: str) -> DataFrame:
    """Users and the key their event names; a dense graph."""
    events = spark.read.parquet(f"{folder}/events.parquet").select("user_id", "props", "value", "ts")
    keyed = events.withColumn("k", F.get_json_object("props", "$.k").try_cast("bigint")).where("k IS NOT NULL")
    return from_table(keyed, "user_id", "k", "value", "ts").withColumn("rate", F.col("rate") + F.lit(0.0))
