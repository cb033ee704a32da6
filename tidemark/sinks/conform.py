"""K5: a table's definition held in one pass, rows that break it set aside.

A load into a database fails as a whole on the first value that is too long,
of another type or NULL where it must not be. Here one job writes both kinds of
rows: those that fit, cast to the definition, and the others with their reasons
and their values as text, so a load can go on and the rest be mended. The
counts come from the same job (``observe``): the rows are read once.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.snapshots import COMPRESSION
from .schemas import JDBC_COLUMN_TYPES, NOT_NULL, STAGING_SCHEMAS

FITS, REASONS, VALUES = "_fits", "_reasons", "_values"


@dataclass(frozen=True)
class Definition:
    """Columns of a table: types, greatest lengths of text, and those that are NOT NULL."""

    schema: T.StructType
    lengths: Mapping[str, int]
    not_null: Sequence[str]


def definition(table: str) -> Definition:
    """The DDL of a derived table."""
    lengths = {c: int(n) for c, n in re.findall(r"(\w+) VARCHAR\((\d+)\)", JDBC_COLUMN_TYPES.get(table, ""))}
    return Definition(STAGING_SCHEMAS[table], lengths, NOT_NULL[table])


@dataclass(frozen=True)
class Conformed:
    """Where the rows of one load are, and how many there are of each kind."""

    path: str
    schema: T.StructType
    fitting: int
    rejected: int
    broken: dict[tuple[str, str], int]  # (column, rule) -> rows

    def rows(self, spark: SparkSession) -> DataFrame:
        """The rows that fit, as defined."""
        if not self.fitting:
            return spark.createDataFrame([], self.schema)
        return spark.read.schema(self.schema).parquet(f"{self.path}/{FITS}=true")

    def rejects(self, spark: SparkSession) -> DataFrame:
        """``(_reasons, _values)`` of the rows that do not: broken rules as ``column: rule``, the row as JSON text."""
        if not self.rejected:
            return spark.createDataFrame([], f"{REASONS} array<string>, {VALUES} string")
        return spark.read.schema(f"{REASONS} array<string>, {VALUES} string").parquet(f"{self.path}/{FITS}=false")


def broken_rules(df: DataFrame, table: Definition) -> dict[tuple[str, str], Column]:
    """A condition for each rule that a column present in ``df`` can break: ``null``, ``type`` or ``length``."""
    out: dict[tuple[str, str], Column] = {}
    for field in table.schema.fields:
        if field.name not in df.columns:
            continue
        c = F.col(field.name)
        if field.name in table.not_null:
            out[field.name, "null"] = c.isNull()
        if df.schema[field.name].dataType != field.dataType:
            out[field.name, "type"] = c.isNotNull() & c.try_cast(field.dataType).isNull()
        if field.name in table.lengths:
            out[field.name, "length"] = F.coalesce(F.char_length(c.cast("string")) > table.lengths[field.name], F.lit(False))
    return out


def write_conforming(df: DataFrame, path: str, table: Definition, passing: Sequence[str] = ()) -> Conformed:
    """Write ``df`` to a fresh folder, rows that fit apart from the others; columns the table lacks are dropped.

    Columns the source lacks stay absent (the database fills them); ``passing``
    names extra columns to keep.
    """
    rules = broken_rules(df, table)
    fields = [f for f in table.schema.fields if f.name in df.columns]
    reasons = F.array_compact(F.array(*[F.when(broken, f"{c}: {rule}") for (c, rule), broken in rules.items()]).cast("array<string>"))
    judged = df.withColumn(REASONS, reasons)
    counts = {f"r{k}": F.count_if(F.array_contains(REASONS, f"{c}: {rule}")) for k, (c, rule) in enumerate(rules)}
    seen = Observation()
    judged = judged.observe(seen, F.count_if(F.size(REASONS) == 0).alias("fitting"), F.count(F.lit(1)).alias("rows"), *[v.alias(k) for k, v in counts.items()])
    fits = F.size(REASONS) == 0
    values = F.to_json(F.struct(*[F.col(c) for c in df.columns if c not in passing]))
    out = judged.select(
        *[F.when(fits, F.col(f.name).try_cast(f.dataType)).alias(f.name) for f in fields],
        *[F.when(fits, F.col(c)).alias(c) for c in passing],
        F.when(~fits, F.col(REASONS)).alias(REASONS), F.when(~fits, values).alias(VALUES), fits.alias(FITS),
    )
    out.write.mode("errorifexists").option("compression", COMPRESSION).partitionBy(FITS).parquet(path)
    got = seen.get
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in fields] + [df.schema[c] for c in passing])
    broken = {key: got[f"r{k}"] for k, key in enumerate(rules)}
    return Conformed(path, schema, got["fitting"], got["rows"] - got["fitting"], broken)
