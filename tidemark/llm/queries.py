"""One query per operator: production parameters, whole tables, full results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import contamination, embedding_dedup, fim, licence_scan, line_dedup, lm, mixing, near_dedup, quality, suffix_dedup, toxicity, warc, whitening


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: calibrated score of each view and of both, and whether it is kept."""
    return quality.scored(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its near-duplicate class and whether it is the one kept."""
    return near_dedup.near_classes(_table(spark, sf_dir, "documents")).select("row.doc_id", "class_id", "kept")


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its text without its host's boilerplate lines."""
    done = line_dedup.drop_boilerplate(_table(spark, sf_dir, "documents"))
    return done.select("row.doc_id", F.col("clean_text").alias("text"), "n_lines", "n_dropped")


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per page: its record as read back from the archives."""
    done = warc.archived(_table(spark, sf_dir, "pages"))
    return done.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document and passage of 50 words or more that another document repeats."""
    return suffix_dedup.repeated_passages(_table(spark, sf_dir, "documents"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its cell, calibrated probability, and whether it is drawn."""
    done = mixing.mixed(_table(spark, sf_dir, "documents"))
    return done.select("row.doc_id", "source", "lang", "topic", "tokens", F.round("prob", 6).alias("prob"), "sampled")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: toxicity score by compression distance."""
    return toxicity.score_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"), lm.fold(F.col("doc_id"), 3) == 1)


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: exact base score and the filter model's log10 probability."""
    return lm.score_texts(_table(spark, sf_dir, "documents"), lm.fold(F.col("doc_id"), 10) == 0)


def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per vector: its links at cosine 0.9, its component, and whether it is the one kept."""
    return embedding_dedup.classes(_table(spark, sf_dir, "embeddings"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document and benchmark item that it contains."""
    return contamination.contaminated_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: places of licence phrases, and the labels of phrases and covered templates."""
    return licence_scan.digest(licence_scan.scan(_table(spark, sf_dir, "documents")))


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per vector and leading component: the whitened coordinate."""
    return whitening.components(whitening.whiten(_table(spark, sf_dir, "embeddings")))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: how it was cut, and digests of the transformed and of the rebuilt text."""
    done = fim.transform(_table(spark, sf_dir, "documents"))
    again = fim.restored(F.col("output"), F.col("form"))
    digests = [F.sha2(c, 256).alias(name) for c, name in ((F.col("output"), "output_sha256"), (again, "restored_sha256"))]
    return done.select(F.col("key").alias("doc_id"), "n", "form", "prefix_chars", "middle_chars", *digests)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        f.__name__: f
        for f in (
            op1_quality_classifier, op2_near_dedup, op3_line_dedup, op4_warc, op5_suffix_dedup, op6_mixing, op7_toxicity, op8_lm_scoring,
            op9_embedding_dedup, op10_decontamination, op11_license_scan, op12_embedding_whitening, op13_fill_in_middle,
        )
    }
