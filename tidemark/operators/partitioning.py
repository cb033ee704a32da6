"""Partitioning operators.

``repartition_by_key`` (R1) hash-partitions on a key, and on a salt beside it
where what follows combines partially; ``throttle`` (R2/K2)
caps the number of concurrent writer tasks for a database sink: by a
round-robin repartition for computed inputs, which keeps upstream stages
fully parallel (``coalesce`` would run the whole upstream stage in ``n``
tasks), and by ``coalesce`` for inputs already written to files.
Round-robin output is deterministic on retry because Spark sorts rows
before a round-robin exchange (``spark.sql.execution.sortBeforeRepartition``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession


def repartition_by_key(df: DataFrame, partitions: int, *keys: str, salt: Column | None = None, salt_name: str = "_salt") -> DataFrame:
    """Hash partitioning on ``keys``; later groupBys/joins on them reuse it.

    A key holding a large share of rows lands in one partition. Where the next
    step combines partially, pass a ``salt``: it becomes the column
    ``salt_name``, rows are dealt by keys and salt, and a groupBy on both needs
    no further exchange.
    """
    if salt is None:
        return df.repartition(partitions, *keys)
    return df.withColumn(salt_name, salt).repartition(partitions, *keys, salt_name)


def throttle(df: DataFrame, writers: int, materialized: bool = False) -> DataFrame:
    """R2/K2: at most ``writers`` concurrent write tasks.

    A computed input is spread round-robin (even sizes; upstream stays fully
    parallel). An input that is already materialized, such as a staging folder
    being exported, is coalesced instead: the same number of writers without
    shuffling the data.
    """
    if writers < 1:
        raise ValueError("writers must be >= 1")
    if materialized:
        return df.coalesce(writers)
    return df.repartition(writers)


def set_shuffle_width(spark: SparkSession, read_partitions: int, factor: int = 2) -> int:
    """Base shuffle width = factor x read partitions; AQE coalesces below it."""
    width = max(1, factor * read_partitions)
    spark.conf.set("spark.sql.shuffle.partitions", str(width))
    return width
