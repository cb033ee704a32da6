"""Chunks by count, bounds from footers, arrival order, co-partitioned staging, sessions per job, rows set aside."""

import dataclasses
import os
import re
import threading

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.event import CUSTOMER_ID, deal_orders, event_rows
from tidemark.operators.merge import dedup_by_key, read_current
from tidemark.plans import spec as spec_module
from tidemark.plans.jobs import Run, run_jobs, staging_name
from tidemark.plans.spec import SPECS, JobOptions
from tidemark.session import child_session
from tidemark.sinks.conform import Definition, definition, write_conforming
from tidemark.sources.bounds import (
    KeyBounds,
    chunk_counts,
    cut_predicates,
    even_chunk_counts,
    even_cuts,
    footer_bounds,
    footer_query,
    range_index,
)
from tidemark.sources.tables import ARRIVAL, read_table, with_arrival

from .conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


# ---- chunks of equal counts -------------------------------------------------------------------

def test_even_chunks_of_sparse_keys(spark):
    """Keys that bunch: equal widths give one chunk nearly all rows, equal counts do not."""
    keys = spark.range(30_000).select(F.when(F.col("id") < 29_000, F.col("id")).otherwise(F.col("id") * 10**9).alias("k"))
    wide = [r["rows"] for r in chunk_counts(keys, "k", 20).collect()]
    even = even_chunk_counts(keys, "k", 20).collect()
    assert max(wide) > 20_000
    assert len(even) == 20 and sum(r["rows"] for r in even) == 30_000 and max(r["rows"] for r in even) <= 1.5 * 1500
    spans = sorted((r["lower"], r["upper"]) for r in even)
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))


def test_even_chunk_edges(spark):
    empty = spark.createDataFrame([], "k bigint")
    assert even_cuts(empty, "k", 5) == [] and even_chunk_counts(empty, "k", 5).count() == 0
    one = spark.createDataFrame([(3,)] * 9, "k int")
    assert [tuple(r) for r in even_chunk_counts(one, "k", 4).collect()] == [(0, 3, 3, 9)]
    hot = spark.createDataFrame([(7,)] * 50 + [(k,) for k in range(50)] + [(None,)], "k bigint")
    got = {r["chunk"]: r["rows"] for r in even_chunk_counts(hot, "k", 10).collect()}
    assert sum(got.values()) == 101
    cuts = even_cuts(hot, "k", 10)
    assert cuts == sorted(set(cuts))
    by_predicate = [hot.where(F.expr(p)).count() for p in cut_predicates("k", cuts)]
    assert by_predicate == [got.get(i, 0) for i in range(len(cuts) + 1)]
    assert cut_predicates("k", []) == ["1 = 1"]
    with pytest.raises(ValueError):
        even_cuts(one, "k", 0)


def test_range_index_is_a_binary_search_over_one_constant(spark):
    cuts = [k * k - 50 for k in range(1, 300)]
    df = spark.range(-60, 95_000, 37).select(range_index(F.col("id"), cuts).alias("i"), "id")
    import bisect

    assert all(r["i"] == bisect.bisect_right(cuts, r["id"]) for r in df.collect())
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "from_json" not in plan  # folded once, not parsed per row
    assert spark.createDataFrame([(None,)], "v bigint").select(range_index(F.col("v"), cuts)).first()[0] == 0


# ---- footers ----------------------------------------------------------------------------------

def test_bounds_come_from_footers(spark, tmp_root):
    sources = {t: (f"{SF_SMALL}/{t}.parquet", k) for t, k in (("orders", "o_orderkey"), ("customer", "c_custkey"))}
    query = footer_query(spark, sources)
    assert _plan(query).count("PushedAggregation: [MIN(") == 2
    for r in query.collect():
        table = read_table(spark, SF_SMALL, r["name"])
        key = sources[r["name"]][1]
        assert (r["lo"], r["hi"], r["rows"]) == table.agg(F.min(key), F.max(key), F.count("*")).first()
    spark.createDataFrame([], "k bigint").write.parquet(f"{tmp_root}/empty")
    spark.createDataFrame([(None,), (None,)], "k bigint").write.parquet(f"{tmp_root}/nulls")
    spark.createDataFrame([(5,), (None,), (-2,)], "k bigint").write.parquet(f"{tmp_root}/some")
    got = footer_bounds(spark, {n: (f"{tmp_root}/{n}", "k") for n in ("empty", "nulls", "some")})
    assert got == {"empty": None, "nulls": None, "some": KeyBounds(-2, 5)}
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown", "false") == "false"  # the caller's session keeps its settings


# ---- last arrival -----------------------------------------------------------------------------

def test_the_last_row_to_arrive_wins(spark, tmp_root):
    rows = [(k % 50, n, f"v{n}") for n, k in enumerate(range(2000))]
    path = f"{tmp_root}/in"
    spark.createDataFrame(rows[:1500], "k int, n int, v string").coalesce(1).write.parquet(path)
    os.utime([os.path.join(path, f) for f in os.listdir(path) if f.endswith(".parquet")][0], (1, 1))
    later = [(k, -1 - k, "later") for k in range(10)]
    spark.createDataFrame(later, "k int, n int, v string").coalesce(1).write.mode("append").parquet(path)
    got = {r["k"]: (r["n"], r["v"]) for r in dedup_by_key(with_arrival(spark.read.parquet(path)), ["k"], ARRIVAL).collect()}
    want = {k: (n, v) for k, n, v in rows[:1500]} | {k: (n, v) for k, n, v in later}
    assert got == want
    greatest = {r["k"]: r["n"] for r in dedup_by_key(spark.read.parquet(path), ["k"]).collect()}
    assert greatest[3] == max(n for k, n, _ in rows[:1500] if k == 3) and got[3][0] == -4
    only = dedup_by_key(with_arrival(spark.read.parquet(path)).select("k", ARRIVAL), ["k"], ARRIVAL)
    assert only.columns == ["k"] and only.count() == 50
    plan = _plan(dedup_by_key(with_arrival(spark.read.parquet(path)), ["k"], ARRIVAL))
    assert "partial_max_by" in plan and plan.count("Exchange hashpartitioning") == 1


# ---- co-partitioned staging, R1, R3 -----------------------------------------------------------

def _run(spark, root, **kw):
    run = Run.create(spark, SF_SMALL, f"{root}/staging", f"{root}/target", JobOptions(event_time=1, **kw.pop("options", {})), size_for_input=False)
    for k, v in kw.items():
        setattr(run, k, v)
    return run


def test_co_partitioned_staging_joins_without_an_exchange(spark, tmp_root):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        run = _run(spark, tmp_root, co_partition=4)
        run_jobs(run, ["customer_event"])
        profile, orders = (run.tables[staging_name(n)] for n in ("customer_profile", "customer_orders"))
        plan = _plan(event_rows(profile, orders))
        assert "SortMergeJoin" in plan and "Exchange" not in plan and plan.count("Bucketed: true") == 2
        plain = _run(spark, f"{tmp_root}/plain")
        run_jobs(plain, ["customer_event"])
        profile, orders = (plain.tables[staging_name(n)] for n in ("customer_profile", "customer_orders"))
        assert _plan(event_rows(profile, orders)).count("Exchange") >= 3
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    same = [read_current(spark, f"{r}/target/customer_event") for r in (tmp_root, f"{tmp_root}/plain")]
    assert same[0].exceptAll(same[1]).count() == same[1].exceptAll(same[0]).count() == 0


def test_orders_are_dealt_by_transform_key_and_salt(spark):
    """A customer with nearly all orders: its rows lie in many partitions, and the first list level needs no exchange."""
    orders = spark.range(2000).select(
        F.unhex(F.md5(F.when(F.col("id") < 1800, 1).otherwise(F.col("id")).cast("string"))).alias(CUSTOMER_ID),
        F.unhex(F.md5(F.col("id").cast("string"))).alias("order_aggregate_identifier"),
    )
    dealt = deal_orders(orders, 24)
    sizes = [len(p) for p in dealt.rdd.glom().collect()]
    assert len(sizes) == 24 and max(sizes) < 900 and sum(1 for s in sizes if s > 50) >= 8
    profile = orders.select(CUSTOMER_ID).distinct().withColumn("custkey", F.lit(1))
    plan = _plan(event_rows(profile, dealt))
    exchanges = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
    assert sum("_digit" in e for e in exchanges) == 1  # the dealing itself
    a, b = event_rows(profile, dealt), event_rows(profile, orders)
    assert a.exceptAll(b).count() == b.exceptAll(a).count() == 0


def test_two_jobs_at_once_have_their_own_widths(spark, tmp_root, monkeypatch):
    """Both transforms wait for each other, so the jobs do run side by side; each plans with its own width."""
    from tidemark.operators.transforms import TRANSFORMS

    meet, seen = threading.Barrier(2, timeout=60), {}

    def spy(name):
        def fn(df):
            meet.wait()
            seen[name] = _plan(df.groupBy(*df.columns[:1]).count())
            return df

        return fn

    for name, width in (("nation", 6), ("supplier", 11)):
        monkeypatch.setitem(TRANSFORMS, f"spy_{name}", spy(name))
        monkeypatch.setitem(SPECS, name, dataclasses.replace(SPECS[name], transform=f"spy_{name}", read_partitions=width))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    results = run_jobs(_run(spark, tmp_root), ["nation", "supplier"], parallel=2, adjust_shuffle=True)
    widths = {n: set(re.findall(r"hashpartitioning\([^)]*?, (\d+)\)", plan)) for n, plan in seen.items()}
    assert widths == {"nation": {"12"}, "supplier": {"22"}}
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    assert [r.rows_staged for r in results] == [read_table(spark, SF_SMALL, t).count() for t in ("nation", "supplier")]


def test_a_child_session_starts_from_the_settings_of_its_parent(spark):
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    child = child_session(spark, {"spark.sql.shuffle.partitions": "77"})
    assert child.conf.get("spark.sql.session.timeZone") == "UTC"
    assert child.conf.get("spark.sql.adaptive.enabled") == spark.conf.get("spark.sql.adaptive.enabled")
    assert child.conf.get("spark.sql.shuffle.partitions") == "77" != spark.conf.get("spark.sql.shuffle.partitions")


def test_configured_partitions_reach_the_event_job(spark, tmp_root, monkeypatch):
    monkeypatch.setitem(SPECS, "customer_event", dataclasses.replace(SPECS["customer_event"], read_partitions=9))
    dealt = []
    monkeypatch.setattr(spec_module, "deal_orders", lambda df, n, key: dealt.append((n, key)) or deal_orders(df, n, key))
    run_jobs(_run(spark, tmp_root), ["customer_event"], adjust_shuffle=True)
    assert dealt == [(9, CUSTOMER_ID)]
    plain = _run(spark, f"{tmp_root}/plain")
    run_jobs(plain, ["customer_event"])
    same = [read_current(spark, f"{r}/target/customer_event") for r in (tmp_root, f"{tmp_root}/plain")]
    assert same[0].exceptAll(same[1]).count() == same[1].exceptAll(same[0]).count() == 0


# ---- rows set aside ---------------------------------------------------------------------------

def test_rows_that_break_the_definition_are_set_aside(spark, tmp_root):
    table = Definition(
        T.StructType([T.StructField("k", T.LongType()), T.StructField("d", T.DateType()), T.StructField("s", T.StringType()), T.StructField("absent", T.IntegerType())]),
        {"s": 3}, ("k", "s"),
    )
    rows = [("1", "2024-01-01", "abc", 9), ("x", "2024-01-01", "abc", 9), ("2", None, "ab", 9), ("3", "no day", "abcd", 9), (None, "2024-02-30", None, 9), ("4", "2024-02-29", "ééé", 9)]
    df = spark.createDataFrame(rows, "k string, d string, s string, extra int")
    done = write_conforming(df, f"{tmp_root}/c", table)
    good = sorted(map(tuple, done.rows(spark).select("k", F.col("d").cast("string"), "s").collect()))
    assert good == [(1, "2024-01-01", "abc"), (2, None, "ab"), (4, "2024-02-29", "ééé")]
    assert done.rows(spark).columns == ["k", "d", "s"]
    assert (done.fitting, done.rejected) == (3, 3)
    assert done.broken == {("k", "null"): 1, ("k", "type"): 1, ("d", "type"): 2, ("s", "null"): 1, ("s", "length"): 1}
    bad = {tuple(r["_reasons"]): r["_values"] for r in done.rejects(spark).collect()}
    assert set(bad) == {("k: type",), ("d: type", "s: length"), ("k: null", "d: type", "s: null")}
    assert '"s":"abcd"' in bad["d: type", "s: length"]
    none = write_conforming(df.limit(0), f"{tmp_root}/e", table)
    assert (none.fitting, none.rejected, none.rows(spark).count(), none.rejects(spark).count()) == (0, 0, 0, 0)


def test_a_job_goes_on_without_the_rows_set_aside(spark, tmp_root):
    run = _run(spark, tmp_root, options={"quarantine": True})
    (result,) = run_jobs(run, ["customer_orders"])
    orders = read_table(spark, SF_SMALL, "orders")
    long = orders.where(F.length("o_orderpriority") > 10).count()
    assert (result.rows_staged, result.rows_rejected) == (orders.count() - long, long) and long > 0
    assert read_current(spark, f"{tmp_root}/target/customer_orders").count() == result.rows_staged
    assert definition("customer_orders").lengths["orderpriority"] == 10


def test_a_job_by_last_arrival(spark, tmp_root):
    run = _run(spark, tmp_root, options={"last_arrival": True})
    run_jobs(run, ["lineitem"])
    got = read_current(spark, f"{tmp_root}/target/lineitem")
    assert ARRIVAL not in got.columns
    lines = read_table(spark, SF_SMALL, "lineitem").collect()
    want = {(r["l_orderkey"], r["l_linenumber"]): r["l_extendedprice"] for r in lines}
    assert {(r["orderkey"], r["linenumber"]): r["extendedprice"] for r in got.collect()} == want
