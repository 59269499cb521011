"""From raw documents to a training mix, in stages that are each written and read again.

Every stage works on all documents that the one before it kept. ``documents``
and what lies between the stages have the same columns; the last stage adds
``mix_copy``, the number of the copy of a document in the mix.

Defined cases, of every stage: further columns stay as they are, whatever their
names (a ``mix_copy`` that is already there is replaced); an empty table gives an
empty one; a document without text or with an empty one has no language and goes
in the first stage; NULLs in other columns are kept; equal rows are one document
for the similarity join and each a row of their own elsewhere; a very long text
is handled by its stages as by their operators.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from affinis.llm import decontamination, language_id, mixing, ngram_join, pii
from affinis.llm.common import table, whole_row
from affinis.session import materialize

#: A document whose main language has a smaller proportion has no main language.
LEAST_PROPORTION = 0.5


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a main language; those without letters and those of mixed languages go."""
    names, logs = language_id.learn(docs.where(~language_id.held_out(F.col("doc_id"))))
    guessed = docs.select(whole_row(docs).alias("row"), language_id.guess(names, logs)("text").alias("guess"))
    known = (F.col("guess.lang_pred") != language_id.UNKNOWN) & (F.col("guess.score") >= LEAST_PROPORTION)
    return guessed.where(known).select("row.*")


def join_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest id."""
    return ngram_join.one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no item of the benchmark."""
    return decontamination.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data taken out of their texts."""
    out = pii.redact_personal_data(docs)
    return out.withColumn("n_chars", F.char_length("text").cast("bigint")) if "n_chars" in out.columns else out


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the weighted mix takes them; those that it does not take go."""
    return mixing.mixed_rows(docs)


STAGES = [
    ("language_id", identify_language),
    ("ngram_jaccard_join", join_near_duplicates),
    ("benchmark_decontamination", decontaminate),
    ("pii", redact),
    ("mixing", mix),
]

#: SQL cannot express language inference, the similarity join and edit matching; the tests use brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
