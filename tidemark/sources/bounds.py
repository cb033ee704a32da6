"""Key bounds (S2, S3) and range chunking (S4), equal in width or in rows.

The reference reads a source in ``n`` key ranges over ``[min, max]``: the
first range is open below and also takes NULL keys, the last is open above.
The same rule serves three uses here:

* ``chunk_id``: a column expression, so chunk sizes are a plain
  ``groupBy(chunk).count()`` (partial aggregation; no data to the driver);
* ``chunk_predicates``: the WHERE clauses of a JDBC partitioned read, so each
  Spark task reads exactly one chunk;
* ``key_bounds``: the probe, one tiny aggregate row.

Chunk rule: ``n' = max(1, min(n, hi - lo))``, ``stride = (hi - lo) div n'``;
key k falls in ``least(n' - 1, greatest(0, (k - lo) div stride))``; a NULL key
is in chunk 0; ``hi = lo`` gives one chunk; an empty source has no chunk.

Ranges of equal width over sparse or clustered keys hold very different numbers
of rows. ``even_cuts`` takes cut points from a quantile sketch instead (one
aggregate; the sketch is merged map-side), so each chunk holds about the same
number of rows; a key that alone has more than a chunk's rows is a chunk.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import child_session


@dataclass(frozen=True)
class KeyBounds:
    lower: int
    upper: int


def key_bounds(df: DataFrame, key: str) -> KeyBounds | None:
    """MIN and MAX of ``key`` over the query, or None when it is empty.

    An ungrouped MIN/MAX always returns one row; emptiness is a NULL bound,
    not a zero row count.
    """
    row = df.agg(F.min(key).alias("lo"), F.max(key).alias("hi")).first()
    if row is None or row["lo"] is None:
        return None
    return KeyBounds(int(row["lo"]), int(row["hi"]))


def footer_bounds(spark: SparkSession, sources: Mapping[str, tuple[str, str]]) -> dict[str, KeyBounds | None]:
    """S2/A6 for Parquet tables ``{name: (path, key)}``: MIN and MAX from the files' footers, all tables in one job.

    Spark's own aggregate pushdown reads the row groups' statistics and no data
    pages. Files without statistics for the key (written so, or holding NULLs
    only) are scanned instead, again in one job.
    """
    try:
        rows = footer_query(spark, sources).collect()  # a row a table
    except Exception as e:  # raised by the reader for files without statistics
        if "No min/max found" not in str(e):
            raise
        rows = footer_query(spark, sources, pushdown=False).collect()
    return {r["name"]: None if r["lo"] is None else KeyBounds(int(r["lo"]), int(r["hi"])) for r in rows}


def footer_query(spark: SparkSession, sources: Mapping[str, tuple[str, str]], pushdown: bool = True) -> DataFrame:
    """``(name, lo, hi, rows)`` per table, by aggregates that the DSv2 Parquet reader answers from footers."""
    reader = child_session(spark, {"spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": str(pushdown).lower()})
    one = []
    for name, (path, key) in sources.items():
        found = reader.read.parquet(path).agg(F.min(key).alias("lo"), F.max(key).alias("hi"), F.count(F.lit(1)).alias("rows"))
        one.append(found.select(F.lit(name).alias("name"), F.col("lo").cast("bigint"), F.col("hi").cast("bigint"), "rows"))
    return reduce(DataFrame.unionByName, one)


def chunk_plan(lower: int, upper: int, n: int) -> tuple[int, int]:
    """(number of chunks, stride) of the chunk rule for integer bounds."""
    if n < 1:
        raise ValueError("number of chunks must be >= 1")
    span = upper - lower
    chunks = max(1, min(n, span))
    stride = span // chunks if chunks > 1 else max(span, 1)
    return chunks, stride


def _int_div(a: Column, b: Column) -> Column:
    """Exact floor division of bigints (``a - pmod(a, b)`` is a multiple of ``b``)."""
    return ((a - F.pmod(a, b)).cast("decimal(38,0)") / b.cast("decimal(38,0)")).cast("bigint")


def _chunk_expr(key: Column, lower: Column, upper: Column, n: int) -> Column:
    span = upper - lower
    chunks = F.greatest(F.lit(1).cast("bigint"), F.least(F.lit(n).cast("bigint"), span))
    stride = F.when(chunks > 1, _int_div(span, chunks)).otherwise(F.greatest(span, F.lit(1).cast("bigint")))
    raw = _int_div(key - lower, stride)
    return F.coalesce(F.least(chunks - 1, F.greatest(F.lit(0).cast("bigint"), raw)), F.lit(0)).cast("int")


def chunk_id(key: str | Column, lower: int, upper: int, n: int) -> Column:
    """S4 chunk of each row, for known bounds."""
    k = F.col(key) if isinstance(key, str) else key
    return _chunk_expr(k.cast("bigint"), F.lit(lower).cast("bigint"), F.lit(upper).cast("bigint"), n)


def with_chunk_id(df: DataFrame, key: str, n: int, name: str = "chunk") -> DataFrame:
    """S4 chunk of each row; the bounds are scalar subqueries of the same plan."""
    lo = df.select(F.min(key).cast("bigint")).scalar()
    hi = df.select(F.max(key).cast("bigint")).scalar()
    return df.withColumn(name, _chunk_expr(F.col(key).cast("bigint"), lo, hi, n))


def chunk_counts(df: DataFrame, key: str, n: int) -> DataFrame:
    """Rows per chunk (``chunk``, ``rows``); an empty source gives no row."""
    return (
        with_chunk_id(df.select(key), key, n)
        .groupBy("chunk")
        .agg(F.count(F.lit(1)).alias("rows"))
    )


def chunk_predicates(key: str, bounds: KeyBounds | None, n: int) -> list[str]:
    """SQL WHERE clauses, one per chunk, for a JDBC partitioned read.

    The clauses are disjoint and cover every row, NULL keys included. An empty
    source yields a single clause that selects nothing new.
    """
    if bounds is None:
        return ["1 = 0"]
    chunks, stride = chunk_plan(bounds.lower, bounds.upper, n)
    if chunks == 1:
        return ["1 = 1"]
    preds = []
    for i in range(chunks):
        lo = bounds.lower + i * stride
        hi = bounds.lower + (i + 1) * stride
        if i == 0:
            preds.append(f"{key} < {hi} OR {key} IS NULL")
        elif i == chunks - 1:
            preds.append(f"{key} >= {lo}")
        else:
            preds.append(f"{key} >= {lo} AND {key} < {hi}")
    return preds


# ---- chunks of equal row counts -----------------------------------------------------------------

#: One in so many rows is the error of a cut point's rank, at least.
ACCURACY = 1_000_000


def accuracy_for(chunks: int) -> int:
    """The sketch's accuracy: a cut's rank is off by at most a hundredth of a chunk."""
    return max(ACCURACY, 100 * chunks)


def even_cuts(df: DataFrame, key: str | Column, chunks: int) -> list[int]:
    """At most ``chunks - 1`` rising keys that part the rows into chunks of about equal counts.

    Chunk i holds the keys k with ``cuts[i - 1] <= k < cuts[i]``. A NULL key is
    not counted here and lies in chunk 0 like any key below the first cut.
    """
    if chunks < 1:
        raise ValueError("number of chunks must be >= 1")
    k = (F.col(key) if isinstance(key, str) else key).cast("bigint")
    at = F.percentile_approx(k, [i / chunks for i in range(1, chunks)], accuracy_for(chunks)) if chunks > 1 else F.lit(None)
    row = df.agg(F.max(k).alias("hi"), at.alias("cuts")).first()
    # the i-th percentile is the last key of chunk i
    return sorted({c + 1 for c in row["cuts"] or () if c < row["hi"]})


def range_index(value: Column, cuts: list[int]) -> Column:
    """How many of the rising ``cuts`` are at most ``value`` (NULL: none), by binary search in one expression.

    The cuts are one constant array, not a condition each, so the plan does not
    grow with them and a row costs about log2 of their number.
    """
    if not cuts:
        return F.lit(0)
    array = F.from_json(F.lit(json.dumps(cuts)), "array<bigint>")
    steps = F.array(*[F.lit(1 << k) for k in range(len(cuts).bit_length() - 1, -1, -1)])

    def search(v: Column) -> Column:
        return F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.try_element_at(array, at + step) <= v, at + step).otherwise(at))

    return F.element_at(F.transform(F.array(value), search), 1)


def even_chunk_counts(df: DataFrame, key: str, chunks: int) -> DataFrame:
    """Per chunk of ``even_cuts``: ``(chunk, lower, upper, rows)``, the least and greatest key in it and its rows."""
    k = F.col(key).cast("bigint")
    chunk = range_index(k, even_cuts(df, key, chunks)).alias("chunk")
    return df.select(k.alias("k"), chunk).groupBy("chunk").agg(F.min("k").alias("lower"), F.max("k").alias("upper"), F.count(F.lit(1)).alias("rows"))


def cut_predicates(key: str, cuts: list[int]) -> list[str]:
    """SQL WHERE clauses of the chunks between ``cuts``: disjoint, and together every row, NULL keys included."""
    if not cuts:
        return ["1 = 1"]
    middle = [f"{key} >= {a} AND {key} < {b}" for a, b in zip(cuts, cuts[1:])]
    return [f"{key} < {cuts[0]} OR {key} IS NULL", *middle, f"{key} >= {cuts[-1]}"]
