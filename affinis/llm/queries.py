"""The registered queries of this subpackage, each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from affinis.llm import (
    decontamination,
    fill_in_middle,
    language_id,
    license_scan,
    line_dedup,
    mixing,
    ngram_join,
    pii,
    quality,
    secret_scan,
    suffix_dedup,
    term_search,
    token_counts,
)
from affinis.llm.common import table


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of each document under the 50k byte-level vocabulary."""
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    counted = token_counts.count_tokens(table(spark, sf_dir, "documents"), path)
    return counted.withColumn("over_limit", F.col("n_tokens") > 1024)


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in each document."""
    found = pii.find_personal_data(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("pii", lambda s: s["base"])
    count = lambda kind: F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("bigint")
    return found.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in pii.KINDS],
        F.sha2(pii.span_text(base), 256).alias("base_sha256"),
        pii.span_text(F.col("pii")).alias("spans"),
    )


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items contained in documents, with up to six edits in a hundred characters."""
    return decontamination.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the weighted mix takes from each document."""
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in each document."""
    found = secret_scan.scan_secrets(table(spark, sf_dir, "documents"))
    base = [r.kind for r in secret_scan.RULES if r.base]
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")
    of_base = F.filter("spans", lambda s: s["kind"].isin(base))
    return found.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in base],
        F.sha2(secret_scan.span_text(of_base), 256).alias("base_sha256"),
        secret_scan.span_text(F.col("spans")).alias("spans"),
    )


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licenses named in each document."""
    found = license_scan.scan_licenses(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"),
        "score",
    )


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of each document, the base rule, and the verdict of the trees."""
    judged = quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", *quality.COUNTS, "base_failed", "kept")


def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of documents linked by four fifths of their five-word shingles."""
    return ngram_join.similarity_classes(table(spark, sf_dir, "documents"))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of each document without the 50-byte strings of smaller documents."""
    removed = suffix_dedup.removals(table(spark, sf_dir, "documents"))
    return removed.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main language of each document, learned from three quarters of them."""
    docs = table(spark, sf_dir, "documents")
    out = language_id.held_out(F.col("doc_id"))
    names, logs = language_id.learn(docs.where(~out))
    found = language_id.identify(docs.select("doc_id", "text", out.alias("held_out")), names, logs)
    return found.select("doc_id", "held_out", "lang_pred", "score")


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of each document without the lines that ten documents or more share."""
    docs = table(spark, sf_dir, "documents")
    kept = line_dedup.without_lines(docs, line_dedup.line_bitmaps(docs, min_docs=10, min_chars=1))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op12_term_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten documents of highest score for each benchmark item."""
    return term_search.rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document cut at two places and put together again with the middle last."""
    cut = fill_in_middle.fill_in_middle(table(spark, sf_dir, "documents"))
    digest = lambda text, name: F.sha2(text.cast("binary"), 256).alias(name)
    back = fill_in_middle.restored(F.col("output"), F.col("form"))
    return cut.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        digest(F.col("output"), "output_sha256"), digest(back, "restored_sha256"),
    )


QUERIES = {
    "op1_token_counts": op1_token_counts,
    "op2_pii": op2_pii,
    "op3_decontamination": op3_decontamination,
    "op4_mix": op4_mix,
    "op5_secrets": op5_secrets,
    "op6_licenses": op6_licenses,
    "op7_quality": op7_quality,
    "op8_ngram_join": op8_ngram_join,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_language_id": op10_language_id,
    "op11_line_dedup": op11_line_dedup,
    "op12_term_search": op12_term_search,
    "op13_fill_in_middle": op13_fill_in_middle,
}
