"""Driver-check queries and their SQL oracles.

Each query reads the whole source tables of a data folder and runs one
operator (or a whole job's staging step). ``for_check`` turns types whose
text differs between engines into plain values: binary identifiers become
lower-case hex, exact decimals become doubles (after exact computation),
dates and timestamps become ISO text. The oracle SQL (DuckDB dialect)
restates the reference's staging SQL over the same tables and applies the
same conversions.

Merge scenarios split whole tables by a natural criterion: the target is an
earlier load (rows up to a date or a price, some values stale), the staging
what came or changed since (rows from a date or price below that on, customers
with recent orders). The two overlap and neither holds the other, so every
scenario inserts, updates and keeps rows; a test counts all three.

Job rows run a whole job twice (staging written, merged, published) in the
shared work folder and read the target back.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import money
from ..operators.event import (
    ORDER_EVENT_COLUMNS,
    PROFILE_EVENT_COLUMNS,
    customer_event,
    customer_event_nested,
    flatten_nested_events,
    profile_orders,
)
from ..operators.merge import dedup_by_key, read_current, upsert
from ..operators.profile import (
    customer_country,
    customer_profile,
    lineitem_totals,
    order_totals,
)
from ..operators.staging import COPY_KEYS, stage_copy, stage_customer_orders
from ..session import work_path
from ..sinks.conform import definition, write_conforming
from ..sources.bounds import chunk_counts, even_chunk_counts, footer_bounds
from ..sources.tables import ARRIVAL, TableSet, present, with_arrival
from ..sources.tables import SOURCE_PARTITION_KEYS as _SOURCE_KEYS
from .jobs import Run, run_jobs
from .spec import JOB_ORDER, SPECS, JobOptions

# Check parameter: a fixed event time so event rows repeat.
CHECK_EVENT_TIME = 1_700_000_000
# Scenario dates: the earlier load holds rows before OLD_UNTIL, the change set
# rows from NEW_FROM (a year of overlap); "recent activity" starts at RECENT_FROM.
OLD_UNTIL = "1998-01-01"
NEW_FROM = "1997-01-01"
RECENT_FROM = "2001-06-01"
# The earlier load of events knows the orders of the first half year only, so
# that many of its customers have none.
FIRST_ORDERS_UNTIL = "1995-07-01"
# The earlier loads of tables without a date, and their changes: [key column, below, from].
SPLITS = {
    "region": ("name", "F", "AS"), "nation": ("regionkey", 4, 1),
    "supplier": ("acctbal", 5000.0, 2000.0), "part": ("retailprice", 915.0, 905.0),
}
STALE = {"supplier": "acctbal", "part": "retailprice"}
EARLY_BALANCE = 8000.0
# Buckets of the staging tables in the co-partitioned run of W11.
CHECK_BUCKETS = 8


def for_check(df: DataFrame) -> DataFrame:
    """Binary -> lower hex, decimal -> double, date/timestamp -> ISO text."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        t = f.dataType
        if isinstance(t, T.BinaryType):
            c = F.lower(F.hex(c))
        elif isinstance(t, T.DecimalType):
            c = c.cast("double")
        elif isinstance(t, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(t, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        cols.append(c.alias(f.name))
    return df.select(cols)


def partsupp_standin(lineitem: DataFrame) -> DataFrame:
    """A partsupp source derived from lineitem, for data sets without partsupp.

    One row per (part, supplier) pair seen in lineitem: quantity shipped as
    availability and the lowest extended price as supply cost. Partial
    aggregation runs before the shuffle on the pair.
    """
    return lineitem.groupBy(
        F.col("l_partkey").alias("ps_partkey"), F.col("l_suppkey").alias("ps_suppkey")
    ).agg(
        F.sum("l_quantity").cast("int").alias("ps_availqty"),
        money(F.min("l_extendedprice")).alias("ps_supplycost"),
    )


def _tables(spark: SparkSession, sf_dir: str) -> TableSet:
    return TableSet(spark, sf_dir)


def _before(df: DataFrame, col: str, day: str) -> DataFrame:
    return df.where(F.col(col) < F.lit(day).cast("date"))


def _from(df: DataFrame, col: str, day: str) -> DataFrame:
    return df.where(F.col(col) >= F.lit(day).cast("date"))


# ---------------------------------------------------------------------------------------------
# Spark queries
# ---------------------------------------------------------------------------------------------

def _stage(table: str) -> Callable[[SparkSession, str], DataFrame]:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        t = _tables(spark, sf_dir)
        src = partsupp_standin(t["lineitem"]) if table == "partsupp" else t[table]
        return for_check(stage_copy(src, table))

    return q


def q_customer_orders(spark, sf_dir):
    return for_check(stage_customer_orders(_tables(spark, sf_dir)["orders"]))


def q_order_totals(spark, sf_dir):
    return for_check(order_totals(_tables(spark, sf_dir)["orders"]))


def q_lineitem_totals(spark, sf_dir):
    t = _tables(spark, sf_dir)
    return for_check(lineitem_totals(t["lineitem"], t["orders"]))


def q_customer_country(spark, sf_dir):
    t = _tables(spark, sf_dir)
    return for_check(customer_country(t["customer"], t["nation"]))


def _profile(t: TableSet, orders: DataFrame | None = None) -> DataFrame:
    return customer_profile(t["customer"], t["nation"], t["orders"] if orders is None else orders, t["lineitem"])


def q_customer_profile(spark, sf_dir):
    return for_check(_profile(_tables(spark, sf_dir)))


def q_profile_orders(spark, sf_dir):
    t = _tables(spark, sf_dir)
    return for_check(profile_orders(_profile(t), stage_customer_orders(t["orders"])))


def _events(t: TableSet, orders: DataFrame | None = None) -> DataFrame:
    o = t["orders"] if orders is None else orders
    return customer_event(_profile(t, o), stage_customer_orders(o), CHECK_EVENT_TIME)


def q_customer_event(spark, sf_dir):
    return for_check(_events(_tables(spark, sf_dir)))


def q_customer_event_nested(spark, sf_dir):
    t = _tables(spark, sf_dir)
    profile = _profile(t)
    orders = stage_customer_orders(t["orders"])
    events = customer_event_nested(profile, orders, CHECK_EVENT_TIME)
    rows = flatten_nested_events(
        events, present(profile, PROFILE_EVENT_COLUMNS), present(orders, ORDER_EVENT_COLUMNS)
    )
    return for_check(rows)


# Source tables of the check data with their jobs' partition keys.
SOURCE_PARTITION_KEYS = tuple(
    (t, k) for t, k in _SOURCE_KEYS.items() if t != "partsupp"
)


def q_pk_bounds(spark, sf_dir):
    t = _tables(spark, sf_dir)
    found = footer_bounds(spark, {name: (f"{t.root.rstrip('/')}/{name}.parquet", key) for name, key in SOURCE_PARTITION_KEYS})
    rows = [(name, b and b.lower, b and b.upper) for name, b in found.items()]
    return spark.createDataFrame(rows, "table_name string, min_key long, max_key long")


def q_chunk_counts_orders(spark, sf_dir):
    t = _tables(spark, sf_dir)
    return chunk_counts(t["orders"], "o_orderkey", SPECS["orders"].read_partitions)


def q_even_chunks_lineitem(spark, sf_dir):
    """Chunks of equal row counts over a key whose rows bunch."""
    t = _tables(spark, sf_dir)
    return even_chunk_counts(t["lineitem"], "l_orderkey", SPECS["lineitem"].read_partitions)


def _run(spark: SparkSession, sf_dir: str, **options) -> Run:
    """A run of the jobs in a fresh work folder; partsupp, absent from the data, is derived from lineitem."""
    root = work_path(spark)
    options = JobOptions(event_time=CHECK_EVENT_TIME, **options)
    standin = lambda session: partsupp_standin(_tables(session, sf_dir)["lineitem"])
    return Run.create(spark, sf_dir, f"{root}/staging", f"{root}/target", options, overrides={"partsupp": standin}, size_for_input=False)


def q_load_counts(spark, sf_dir):
    """Rows that each job observed while it wrote its staging (K4)."""
    rows = [(r.name, r.rows_staged) for r in run_jobs(_run(spark, sf_dir), parallel=4)]
    return spark.createDataFrame(rows, "table_name string, rows long")


def _job(name: str, co_partition: int | None = None, **options) -> Callable[[SparkSession, str], DataFrame]:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        run = _run(spark, sf_dir, **options)
        run.co_partition = co_partition
        run_jobs(run, [name])
        again = Run(spark, run.tables, run.staging_root, run.target_root, options=run.options, co_partition=co_partition)
        run_jobs(again, [name])
        return for_check(read_current(spark, f"{run.target_root}/{name}"))

    return q


def q_conform_customer_orders(spark, sf_dir):
    """The staged orders that fit their DDL, cast to it (K5)."""
    staged = stage_customer_orders(_tables(spark, sf_dir)["orders"])
    done = write_conforming(staged, f"{work_path(spark)}/conform", definition("customer_orders"))
    return for_check(done.rows(spark))


def q_conform_counts(spark, sf_dir):
    """Rows of the derived tables that fit their DDL, that do not, and by broken rule (K5)."""
    t = _tables(spark, sf_dir)
    staged = {"customer_orders": stage_customer_orders(t["orders"]), "customer_profile": _profile(t)}
    rows = []
    for name, df in staged.items():
        done = write_conforming(df, f"{work_path(spark)}/conform", definition(name))
        rows += [(name, "fitting", done.fitting), (name, "rejected", done.rejected)]
        rows += [(name, f"{column}: {rule}", n) for (column, rule), n in done.broken.items() if n]
    return spark.createDataFrame(rows, "table_name string, kind string, rows long")


def q_upsert_duplicate_keys(spark, sf_dir):
    staged = stage_copy(_tables(spark, sf_dir)["lineitem"], "lineitem")
    return for_check(dedup_by_key(staged, COPY_KEYS["lineitem"]))


def q_upsert_last_arrival(spark, sf_dir):
    """Of lines with one key the last in the source's file (U13 by arrival)."""
    staged = stage_copy(with_arrival(_tables(spark, sf_dir)["lineitem"]), "lineitem", (ARRIVAL,))
    return for_check(dedup_by_key(staged, COPY_KEYS["lineitem"], ARRIVAL))


# ---- merge scenarios ------------------------------------------------------------------------

def _stale(df: DataFrame, column: str, value) -> DataFrame:
    return df.withColumn(column, value.cast(df.schema[column].dataType))


def _recent_customers(t: TableSet) -> DataFrame:
    return _from(t["orders"], "o_orderdate", RECENT_FROM).select(F.col("o_custkey").alias("custkey")).distinct()


def merge_scenario(table: str, t: TableSet) -> tuple[DataFrame, DataFrame, tuple[str, ...], list[str] | None]:
    """(target, staging, keys, target columns) of one merge scenario."""
    if table in SPLITS:
        cur = stage_copy(t[table], table)
        by, below, since = SPLITS[table]
        old = cur.where(F.col(by) < F.lit(below))
        old = _stale(old, STALE[table], F.lit(0.0)) if table in STALE else _stale(old, "name", F.lower("name"))
        return old, cur.where(F.col(by) >= F.lit(since)), COPY_KEYS[table], None
    if table == "customer":
        cur = stage_copy(t["customer"], "customer")
        old = _stale(cur.where(F.col("acctbal") < EARLY_BALANCE), "acctbal", F.lit(0.0))
        return old, cur.join(_recent_customers(t), "custkey", "left_semi"), COPY_KEYS["customer"], None
    if table == "partsupp":
        old = stage_copy(partsupp_standin(_before(t["lineitem"], "l_shipdate", OLD_UNTIL)), "partsupp")
        new = stage_copy(partsupp_standin(_from(t["lineitem"], "l_shipdate", NEW_FROM)), "partsupp")
        return old, new, COPY_KEYS["partsupp"], None
    if table == "orders":
        old = _stale(stage_copy(_before(t["orders"], "o_orderdate", OLD_UNTIL), "orders"), "orderstatus", F.lit("O"))
        new = stage_copy(_from(t["orders"], "o_orderdate", NEW_FROM), "orders")
        return old, new, COPY_KEYS["orders"], None
    if table == "lineitem":
        keys = COPY_KEYS["lineitem"]
        old = stage_copy(_before(t["lineitem"], "l_shipdate", OLD_UNTIL), "lineitem")
        old = _stale(dedup_by_key(old, keys), "linestatus", F.lit("O"))
        new = stage_copy(_from(t["lineitem"], "l_shipdate", NEW_FROM), "lineitem")
        return old, new, keys, None
    spec = SPECS[table]
    if table == "customer_orders":
        old = stage_customer_orders(_before(t["orders"], "o_orderdate", OLD_UNTIL))
        old = _stale(old, "orderstatus", F.lit("O"))
        new = stage_customer_orders(_from(t["orders"], "o_orderdate", NEW_FROM))
    else:
        early = t["customer"].where(F.col("c_acctbal") < EARLY_BALANCE).select(F.col("c_custkey").alias("custkey"))
        if table == "customer_profile":
            old, new = _profile(t, _before(t["orders"], "o_orderdate", OLD_UNTIL)), _profile(t)
        elif table == "customer_event":
            old, new = _events(t, _before(t["orders"], "o_orderdate", FIRST_ORDERS_UNTIL)), _events(t)
        else:
            raise KeyError(table)
        old = old.join(early, "custkey", "left_semi")
        new = new.join(_recent_customers(t), "custkey", "left_semi")
    old = old.select(spec.target_columns(old))
    return old, new, spec.merge_keys, spec.target_columns(new)


def _upsert_query(table: str) -> Callable[[SparkSession, str], DataFrame]:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        target, staging, keys, columns = merge_scenario(table, _tables(spark, sf_dir))
        return for_check(upsert(target, staging, keys, columns))

    return q


UPSERT_TABLES = (
    "region", "nation", "customer", "supplier", "part", "partsupp", "orders", "lineitem",
    "customer_orders", "customer_profile", "customer_event",
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    qs: dict[str, Callable[[SparkSession, str], DataFrame]] = {
        f"stage_{t}": _stage(t)
        for t in ("region", "nation", "customer", "supplier", "part", "partsupp", "orders", "lineitem")
    }
    qs.update(
        customer_orders=q_customer_orders,
        order_totals=q_order_totals,
        lineitem_totals=q_lineitem_totals,
        customer_country=q_customer_country,
        customer_profile=q_customer_profile,
        profile_orders=q_profile_orders,
        customer_event=q_customer_event,
        customer_event_nested=q_customer_event_nested,
        pk_bounds=q_pk_bounds,
        chunk_counts_orders=q_chunk_counts_orders,
        even_chunks_lineitem=q_even_chunks_lineitem,
        load_counts=q_load_counts,
        upsert_duplicate_keys=q_upsert_duplicate_keys,
        upsert_last_arrival=q_upsert_last_arrival,
        conform_customer_orders=q_conform_customer_orders,
        conform_counts=q_conform_counts,
    )
    qs.update({f"upsert_{t}": _upsert_query(t) for t in UPSERT_TABLES})
    qs.update({f"job_{t}": _job(t) for t in JOB_ORDER})
    qs.update(
        job_lineitem_last_arrival=_job("lineitem", last_arrival=True),
        job_customer_orders_quarantine=_job("customer_orders", quarantine=True),
        job_customer_event_copartitioned=_job("customer_event", co_partition=CHECK_BUCKETS),
    )
    return qs
