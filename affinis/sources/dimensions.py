"""Readers for the tables that describe users and items."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Column layout of the delimited files.
USER_SCHEMA = "user BIGINT, age INT, gender STRING, occupation STRING, zip STRING"
GENRE_SCHEMA = "genre STRING, idx INT"
ITEM_FIELDS = "item BIGINT, title STRING, release STRING, video_release STRING, url STRING"
ITEM_FLAGS = 19


def read_users(spark: SparkSession, path: str) -> DataFrame:
    """Pipe-separated demographics; the zip code is text."""
    return spark.read.schema(USER_SCHEMA).option("sep", "|").csv(path)


def read_genres(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(GENRE_SCHEMA).option("sep", "|").csv(path).where("genre IS NOT NULL")


def read_occupations(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("occupation STRING").csv(path).where("occupation IS NOT NULL")


def read_totals(spark: SparkSession, path: str) -> DataFrame:
    """Lines of ``number label``."""
    return spark.read.schema("n BIGINT, label STRING").option("sep", " ").csv(path)


def read_items(spark: SparkSession, path: str, flags: int = ITEM_FLAGS) -> DataFrame:
    """Pipe-separated items with one 0/1 column per genre, read as an array of the genre numbers that are set."""
    names = [f"flag_{i}" for i in range(flags)]
    schema = ITEM_FIELDS + "".join(f", {name} INT" for name in names)
    set_flags = F.array_compact(F.array(*[F.when(F.col(name) == 1, F.lit(i)) for i, name in enumerate(names)]))
    raw = spark.read.schema(schema).option("sep", "|").csv(path)
    return raw.withColumn("genres", set_flags).drop(*names)


def customer_dimension(spark: SparkSession, folder: str) -> DataFrame:
    """Customers with the name of their nation."""
    customer = spark.read.parquet(f"{folder}/customer.parquet").select("c_custkey", "c_nationkey", "c_mktsegment")
    nation = spark.read.parquet(f"{folder}/nation.parquet").select("n_nationkey", "n_name")
    joined = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.select(F.col("c_custkey").alias("user"), F.col("c_mktsegment").alias("segment"), F.col("n_name").alias("nation"))
