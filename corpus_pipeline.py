"""The corpus pipeline: five stages from raw documents to a mixed training set.

Each stage takes ``(spark, docs, sf_dir)``, works on all rows it is given and
returns a DataFrame; ``run`` writes each stage's result as Parquet in the
shared folder and reads it back as the next one's input, so a lost executor
costs no more than the running stage. All stages but the last return the
columns of ``documents``; the last adds the sampling probability.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import contamination, line_dedup, mixing, near_dedup, quality
from tidemark.llm.common import col, unpacked, written

#: MinHash classes, the co-trained classifier and raking cannot be said in SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return quality.keep_good(docs, _table(spark, sf_dir, "labels"))


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without their site's boilerplate lines; ``n_chars`` follows the text."""
    done = line_dedup.drop_boilerplate(docs)
    new = {"text": F.col("clean_text"), "n_chars": F.length("clean_text").cast("long")}
    own = [
        F.when(F.col("n_dropped") > 0, new[c]).otherwise(F.col("row").getField(c)).alias(c) if c in new else F.col("row").getField(c).alias(c)
        for c in docs.columns
    ]
    return done.select(*own)


def dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class."""
    return near_dedup.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return contamination.drop_contaminated(docs, _table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents drawn at the raked probabilities, with ``topic`` and ``prob``."""
    drawn = mixing.mixed(docs).filter("sampled")
    extra = [F.col(c) for c in ("topic", "prob") if c not in docs.columns]
    return drawn.select(*unpacked(drawn, "row", docs.columns), *extra)


STAGES = [
    ("quality classifier", classify),
    ("line dedup", drop_lines),
    ("near dedup", dedup),
    ("decontamination", decontaminate),
    ("mixing", mix),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return docs.withColumn("prob", F.round(col("prob"), 6))
