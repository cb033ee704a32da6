"""Line dedup by site-relative frequency (native).

For each host, a line's ratio is the number of the host's pages that contain
it divided by the host's page total. Lines whose ratio exceeds the boilerplate
ratio are dropped from the host's pages.

Defined cases: a line is compared without surrounding spaces, tabs and
carriage returns; blank lines are never boilerplate and stay. A line counts
once per page however often it repeats there. Every row is a page, so
repeated rows count each. A null host is a host of its own. Null text stays
null (the row still counts as a page); a text all of whose lines are dropped
becomes the empty string. An empty table gives an empty result. Columns of
the input are carried as they are, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import col, packed, written

_EDGE = " \t\r"


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _host_key(host: Column) -> Column:
    return F.coalesce(F.concat(F.lit("h"), host.cast("string")), F.lit("null"))


def boilerplate_lines(
    docs: DataFrame, host: str = "source", text: str = "text", ratio: float = 0.1, min_pages: int = 3
) -> DataFrame:
    """``(host_key, lines)``: each host's boilerplate lines.

    A host's list is at most (its distinct lines per page) / ``ratio`` long,
    since every entry is on more than ``ratio`` of its pages, so gathering it
    in a cell is bounded however large the host is. Counting combines rows
    before the shuffle; the page totals come from a scan of one column.
    """
    base = docs.select(_host_key(col(host)).alias("host_key"), col(text).alias("text"))
    pages = base.groupBy("host_key").agg(F.count(F.lit(1)).alias("pages"))
    trimmed = F.transform(_lines(F.col("text")), lambda x: F.btrim(x, F.lit(_EDGE)))
    counts = (
        # explode_outer: with explode, Catalyst infers a filter below that splits every text twice
        base.select("host_key", F.explode_outer(F.array_distinct(trimmed)).alias("line"))
        .filter(F.col("line") != "")
        .groupBy("host_key", "line")
        .agg(F.count(F.lit(1)).alias("on_pages"))
        .filter(F.col("on_pages") >= min_pages)
    )
    return (
        counts.join(pages, "host_key")
        .filter(F.col("on_pages") > F.lit(ratio) * F.col("pages"))
        .groupBy("host_key")
        .agg(F.collect_list("line").alias("lines"))
    )


def drop_boilerplate(
    docs: DataFrame, host: str = "source", text: str = "text", ratio: float = 0.1, min_pages: int = 3
) -> DataFrame:
    """``row`` (the input row as a struct), ``clean_text``, ``n_lines``, ``n_dropped``.

    ``min_pages`` is the least number of pages a line must repeat on, so that a
    host with one or two pages is not emptied. The per-host lists are written
    first, so their size is known when the pages are joined: while below Spark's
    broadcast threshold they are sent to the pages, which are then not shuffled;
    beyond it a sort-merge join whose hot host AQE splits on the page side.
    """
    listed = written(boilerplate_lines(docs, host, text, ratio, min_pages), "boilerplate")
    base = docs.select(packed(docs).alias("row"), _host_key(col(host)).alias("host_key"), col(text).alias("text"))
    joined = base.join(listed, "host_key", "left").withColumn("all_lines", _lines(F.col("text")))
    kept = F.when(F.col("lines").isNull(), F.col("all_lines")).otherwise(
        F.filter("all_lines", lambda x: ~F.array_contains(F.col("lines"), F.btrim(x, F.lit(_EDGE))))
    )
    return joined.withColumn("kept", kept).select(
        "row",
        F.array_join("kept", "\n").alias("clean_text"),
        F.coalesce(F.size("all_lines"), F.lit(0)).cast("long").alias("n_lines"),
        F.when(F.col("all_lines").isNull(), F.lit(0)).otherwise(F.size("all_lines") - F.size("kept")).cast("long").alias("n_dropped"),
    ).withColumn("n_lines", F.greatest("n_lines", F.lit(0).cast("long")))
