import uuid

import pytest
from pyspark.sql import functions as F

from tidemark.operators.partitioning import throttle
from tidemark.sinks.writers import conform, write_jdbc, write_parquet_staging
from tidemark.sinks.schemas import CUSTOMER_EVENT_STAGING
from tidemark.sources.bounds import (
    KeyBounds,
    chunk_counts,
    chunk_id,
    chunk_plan,
    chunk_predicates,
    key_bounds,
)
from tidemark.sources.jdbc import JdbcEndpoint, jdbc_bounds, read_jdbc_query


def test_chunk_counts_sum_to_rows(spark):
    df = spark.range(-5, 1000).withColumnRenamed("id", "k")
    counts = {r["chunk"]: r["rows"] for r in chunk_counts(df, "k", 7).collect()}
    assert sum(counts.values()) == 1005
    assert sorted(counts) == list(range(7))


def test_chunk_edges(spark):
    empty = spark.createDataFrame([], "k bigint")
    assert chunk_counts(empty, "k", 5).count() == 0
    assert key_bounds(empty, "k") is None
    one = spark.createDataFrame([(3,), (3,)], "k bigint")
    assert [tuple(r) for r in chunk_counts(one, "k", 5).collect()] == [(0, 2)]
    with_null = spark.createDataFrame([(None,), (1,), (100,)], "k bigint")
    counts = {r["chunk"]: r["rows"] for r in chunk_counts(with_null, "k", 4).collect()}
    assert counts[0] == 2 and sum(counts.values()) == 3
    assert chunk_plan(0, 3, 50) == (3, 1)


def test_predicates_partition_rows_like_chunk_id(spark):
    df = spark.createDataFrame([(None,)] + [(k,) for k in range(-3, 200, 7)], "k bigint")
    b = key_bounds(df, "k")
    preds = chunk_predicates("k", b, 6)
    ids = df.select("k", chunk_id("k", b.lower, b.upper, 6).alias("c"))
    for i, p in enumerate(preds):
        by_pred = sorted(r[0] for r in df.where(F.expr(p)).select(F.coalesce("k", F.lit(-999))).collect())
        by_id = sorted(r[0] for r in ids.where(f"c = {i}").select(F.coalesce("k", F.lit(-999))).collect())
        assert by_pred == by_id
    assert chunk_predicates("k", None, 6) == ["1 = 0"]
    assert chunk_predicates("k", KeyBounds(4, 4), 6) == ["1 = 1"]


@pytest.fixture()
def derby():
    # Embedded in-memory Derby lives inside the Spark JVM: no server, no port.
    return JdbcEndpoint(protocol="derby", url=f"jdbc:derby:memory:tm{uuid.uuid4().hex[:8]};create=true")


def test_jdbc_partitioned_query_read(spark, derby):
    # Upper-case names: what a database stores for unquoted identifiers in its DDL.
    src = spark.range(0, 500).select(F.col("id").alias("CUSTKEY"), (F.col("id") % 7).alias("NATIONKEY"))
    write_jdbc(src, derby, "CUSTOMER", writers=3, batch_size=100, mode="overwrite")
    query = "SELECT custkey, nationkey FROM CUSTOMER WHERE nationkey <> 3"
    bounds = jdbc_bounds(spark, derby, query, "custkey")
    assert bounds == KeyBounds(0, 499)
    df = read_jdbc_query(spark, derby, query, "custkey", partitions=5)
    assert df.rdd.getNumPartitions() == 5
    assert df.count() == src.where("NATIONKEY <> 3").count()
    empty = read_jdbc_query(spark, derby, "SELECT custkey FROM CUSTOMER WHERE custkey < 0", "custkey", 5)
    assert empty.count() == 0


def test_jdbc_append_counts_rows(spark, derby):
    df = spark.range(0, 123).select(F.col("id").alias("k"))
    assert write_jdbc(df, derby, "T", writers=4, batch_size=10, mode="overwrite") == 123
    assert write_jdbc(df, derby, "T", writers=4, batch_size=10) == 123
    assert spark.read.jdbc(derby.jdbc_url(), "T", properties=derby.properties()).count() == 246


def test_parquet_staging_counts_and_fresh_folder(spark, tmp_root):
    df = spark.range(0, 77)
    assert write_parquet_staging(df, f"{tmp_root}/s/run=1") == 77
    with pytest.raises(Exception):
        write_parquet_staging(df, f"{tmp_root}/s/run=1")


def test_throttle_and_conform(spark):
    df = spark.range(0, 100, numPartitions=8)
    assert throttle(df, 3).rdd.getNumPartitions() == 3
    coalesced = throttle(df, 3, materialized=True)
    assert coalesced.rdd.getNumPartitions() == 3
    assert "Exchange" not in coalesced._jdf.queryExecution().executedPlan().toString()
    ev = spark.createDataFrame([(bytearray(b"x" * 16), 1, "p", "MigEvent", 5)],
                               "customer_aggregate_identifier binary, custkey bigint, event_parameters string, event_type string, event_timestamp bigint")
    with pytest.raises(ValueError):
        conform(ev.drop("event_type"), CUSTOMER_EVENT_STAGING)
    out = conform(ev, CUSTOMER_EVENT_STAGING, fill_missing=True)
    assert out.columns == ["customer_aggregate_identifier", "event_type", "event_timestamp", "event_parameters"]


def test_jobs_from_jdbc_source_to_jdbc_staging(spark, derby, tmp_root):
    """Sources read from a database in key ranges, staging loaded into a
    database: same targets as the parquet run."""
    from tidemark.operators.merge import read_current
    from tidemark.plans.jobs import Run, run_jobs
    from tidemark.plans.spec import JobOptions
    from tidemark.sources.jdbc import jdbc_loader
    from tidemark.sources.tables import read_table

    from .conftest import SF_SMALL

    for t in ("nation", "customer", "orders", "lineitem"):
        df = read_table(spark, SF_SMALL, t)
        upper = df.select([F.col(c).alias(c.upper()) for c in df.columns])
        # TPC-H text columns are VARCHAR (Spark's Derby default would be CLOB)
        text = ", ".join(f"{f.name} VARCHAR(100)" for f in upper.schema.fields if f.dataType.simpleString() == "string")
        write_jdbc(upper, derby, t.upper(), writers=2, batch_size=500, mode="overwrite", column_types=text)
    # staging is a different database than the source, as in the reference
    staging_db = JdbcEndpoint(protocol="derby", url=f"jdbc:derby:memory:st{uuid.uuid4().hex[:8]};create=true")
    opts = JobOptions(event_time=1)
    jobs = ["customer", "customer_event"]
    via_db = Run.create(spark, SF_SMALL, f"{tmp_root}/s1", f"{tmp_root}/t1", opts,
                        loader=jdbc_loader(spark, derby, partitions=4), staging_endpoint=staging_db)
    via_files = Run.create(spark, SF_SMALL, f"{tmp_root}/s2", f"{tmp_root}/t2", opts)
    r1 = run_jobs(via_db, jobs)
    run_jobs(via_files, jobs)
    for name in ("customer", "customer_orders", "customer_profile", "customer_event"):
        a = read_current(spark, f"{tmp_root}/t1/{name}")
        b = read_current(spark, f"{tmp_root}/t2/{name}")
        assert a.count() == b.count() and a.exceptAll(b).count() == 0, name
    event = {r.name: r for r in r1}["customer_event"]
    assert event.rows_exported == event.rows_staged
    staged_event = spark.read.jdbc(staging_db.jdbc_url(), "customer_event", properties=staging_db.properties())
    assert "custkey" not in [c.lower() for c in staged_event.columns]
    # W11 from a staging database (S6): the event job reads the staged profile
    # and orders tables that earlier jobs loaded there. Spark created those
    # Derby tables with quoted lower-case names, so the keys are quoted too.
    from tidemark.plans.jobs import run_job

    def staged(table, key):
        return read_jdbc_query(spark, staging_db, f"SELECT * FROM {table}", f'"{key}"', 3)

    from_db = Run.create(
        spark, SF_SMALL, f"{tmp_root}/s3", f"{tmp_root}/t3", opts,
        overrides={
            "staging.customer_profile": staged("customer_profile", "custkey"),
            "staging.customer_orders": staged("customer_orders", "orderkey"),
        },
    )
    run_job(from_db, "customer_event")
    a = read_current(spark, f"{tmp_root}/t3/customer_event")
    b = read_current(spark, f"{tmp_root}/t2/customer_event")
    assert a.count() == b.count() and a.exceptAll(b).count() == 0
    # a rerun truncates the staging table instead of appending to it
    run_jobs(Run.create(spark, SF_SMALL, f"{tmp_root}/s1", f"{tmp_root}/t1", opts,
                        loader=jdbc_loader(spark, derby, partitions=4), staging_endpoint=staging_db), ["customer"])
    assert spark.read.jdbc(staging_db.jdbc_url(), "customer", properties=staging_db.properties()).count() == \
        read_table(spark, SF_SMALL, "customer").count()


def test_table_without_a_known_key_is_refused(spark, derby):
    from tidemark.sources.jdbc import jdbc_loader

    with pytest.raises(KeyError, match="no partition key"):
        jdbc_loader(spark, derby, partitions=4)("unknown")


def test_not_null_columns_fail_the_load(spark):
    from tidemark.sinks.writers import require_not_null

    df = spark.createDataFrame([(1, "a"), (None, "b")], "k bigint, a string")
    assert require_not_null(df, ["a"]).count() == 2
    with pytest.raises(Exception, match="NOT NULL column k"):
        require_not_null(df, ["k"]).collect()


def test_jdbc_read_by_chunk_size(spark, derby):
    from tidemark.sources.jdbc import chunks_for_rows, read_jdbc_chunked

    src = spark.range(0, 1000).select(F.col("id").alias("K"))
    write_jdbc(src, derby, "C", writers=2, batch_size=500, mode="overwrite")
    df = read_jdbc_chunked(spark, derby, "SELECT k FROM C", "k", chunk_rows=300)
    assert df.rdd.getNumPartitions() == chunks_for_rows(1000, 300) == 4
    sizes = df.rdd.glom().map(len).collect()
    assert sum(sizes) == 1000 and max(sizes) <= 334
    empty = read_jdbc_chunked(spark, derby, "SELECT k FROM C WHERE k < 0", "k", chunk_rows=300)
    assert empty.count() == 0


def test_repartition_by_key_and_shuffle_width(spark):
    from tidemark.operators.partitioning import repartition_by_key, set_shuffle_width

    df = spark.range(0, 200).select((F.col("id") % 10).alias("k"), "id")
    parts = repartition_by_key(df, 4, "k").rdd.glom().map(lambda rows: {r["k"] for r in rows}).collect()
    assert len(parts) == 4
    seen = [k for p in parts for k in p]
    assert sorted(seen) == list(range(10))  # each key in exactly one partition
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        assert set_shuffle_width(spark, 50) == 100  # the reference's 2 x read partitions
        assert spark.conf.get("spark.sql.shuffle.partitions") == "100"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_jdbc_loader_by_chunk_rows(spark, derby):
    from tidemark.sources.jdbc import jdbc_loader

    src = spark.range(0, 900).select(F.col("id").alias("O_ORDERKEY"), (F.col("id") % 5).alias("O_CUSTKEY"))
    write_jdbc(src, derby, "ORDERS", writers=2, batch_size=500, mode="overwrite")
    load = jdbc_loader(spark, derby, partitions=50, chunk_rows=250)
    orders = load("orders")
    assert orders.rdd.getNumPartitions() == 4  # ceil(900 / 250)
    assert orders.count() == 900
    assert jdbc_loader(spark, derby, partitions=3)("orders").rdd.getNumPartitions() == 3
