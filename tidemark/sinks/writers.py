"""Staging sinks (K1-K6).

* Parquet staging: every run writes a fresh folder (never appends into a
  previous run's staging, so reruns cannot duplicate rows). Spark's commit
  protocol makes task retries and lost executors safe.
* JDBC staging: append through at most ``writers`` concurrent tasks, with
  batched inserts. A retried task may insert its rows twice; the merge
  deduplicates on the key, so the target is still right.
* Row counts come from ``observe`` on the written plan: one pass, and the
  count is exactly what was written.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.partitioning import throttle
from ..operators.snapshots import COMPRESSION
from ..sources.jdbc import JdbcEndpoint


def counted(df: DataFrame, name: str | None = None) -> tuple[DataFrame, Observation]:
    """K4: attach a row counter that is filled when ``df`` is written."""
    obs = Observation(name or f"rows_{uuid.uuid4().hex[:8]}")
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def write_parquet_staging(df: DataFrame, path: str, max_records_per_file: int | None = None) -> int:
    """K1 (parquet): write ``df`` to a fresh run folder; return the rows written."""
    observed, obs = counted(df)
    writer = observed.write.mode("errorifexists").option("compression", COMPRESSION)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", str(max_records_per_file))
    writer.parquet(path)
    return int(obs.get["rows"])


def write_bucketed_staging(df: DataFrame, path: str, table: str, key: str, buckets: int) -> int:
    """K1: staging bucketed and sorted on ``key``, one file a bucket, as the catalogue table ``table``.

    What joins or groups it by the key later needs no exchange for it. The
    files lie under ``path``, which all executors share. A key with a large
    share of the rows lies in one bucket; leave such a table unbucketed.
    """
    observed, obs = counted(df.repartition(buckets, key))
    observed.write.mode("errorifexists").bucketBy(buckets, key).sortBy(key).option("path", path).option("compression", COMPRESSION).format("parquet").saveAsTable(table)
    return int(obs.get["rows"])


def require_not_null(df: DataFrame, columns) -> DataFrame:
    """K5: the DDL's NOT NULL columns: a NULL fails the load instead of passing silently."""
    return df.withColumns(
        {c: F.coalesce(F.col(c), F.raise_error(F.lit(f"NULL in NOT NULL column {c}")).cast(df.schema[c].dataType)) for c in columns}
    )


def write_jdbc(
    df: DataFrame,
    endpoint: JdbcEndpoint,
    table: str,
    writers: int,
    batch_size: int,
    mode: str = "append",
    column_types: str | None = None,
    truncate: bool = False,
    materialized: bool = False,
) -> int:
    """K1-K3, K6: throttled, batched JDBC write; returns the rows written.

    ``mode="overwrite", truncate=True`` empties an existing table but keeps its
    definition (keys, column types): a fresh staging load per run.
    ``materialized=True`` (the input is a file scan) throttles by coalescing,
    without a shuffle.
    """
    observed, obs = counted(throttle(df, writers, materialized))
    props = endpoint.properties()
    props["batchsize"] = str(batch_size)
    if endpoint.protocol == "mysql":
        props["rewriteBatchedStatements"] = "true"
    writer = observed.write.format("jdbc").option("url", endpoint.jdbc_url()).option("dbtable", table)
    writer = writer.options(**props)
    if column_types:
        writer = writer.option("createTableColumnTypes", column_types)
    if truncate:
        writer = writer.option("truncate", "true")
    writer.mode(mode).save()
    return int(obs.get["rows"])


def conform(df: DataFrame, schema: T.StructType, fill_missing: bool = False) -> DataFrame:
    """K5: select the schema's columns in order and cast them to its types.

    Columns absent from ``df`` raise, unless ``fill_missing`` adds them as
    typed NULLs (the source lacks them); extra columns are dropped (B2).
    """
    cols = []
    for field in schema.fields:
        if field.name in df.columns:
            cols.append(F.col(field.name).cast(field.dataType).alias(field.name))
        elif fill_missing:
            cols.append(F.lit(None).cast(field.dataType).alias(field.name))
        else:
            raise ValueError(f"column {field.name} missing; have {df.columns}")
    return df.select(cols)
