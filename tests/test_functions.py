from decimal import Decimal

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import (
    aggregate_identifier,
    bit64_text,
    cents_to_money,
    identifier_hex,
    money_cents,
)


def test_aggregate_identifier_known_values(spark):
    df = spark.createDataFrame([(0,), (1,), (-1,), (None,)], "k bigint")
    got = [r[0] for r in df.select(identifier_hex(aggregate_identifier("k"))).collect()]
    assert got == [
        "10eab6008d5642cf42abd2aa41f847cb",
        "9a25b027482b37e047104e2e532cabae",
        "46f04863257ac8040905ea0002183d35",
        None,
    ]


def test_bit64_text_two_complement(spark):
    df = spark.createDataFrame([(5,), (-1,)], "k bigint")
    a, b = [r[0] for r in df.select(bit64_text("k")).collect()]
    assert a == "0" * 61 + "101"
    assert b == "1" * 64


def test_money_cents_matches_exact_decimal_cast(spark):
    values = [
        0.0, 0.01, 0.05, 0.07, 1.005, 0.125, 2.675, -0.125, -3.14159, 123456.789,
        9999999999999.99, 1e9 + 0.015, 84197.04, -0.005, 1.0000001, None,
    ]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    rows = df.select(
        money_cents("x").alias("fast"), (F.col("x").cast("decimal(15,2)") * 100).cast("bigint").alias("exact")
    ).collect()
    for v, r in zip(values, rows):
        assert r["fast"] == r["exact"], v


def test_money_cents_from_decimal_input(spark):
    values = ["12.34", "-0.01", "9999999999999.99", "999999999.99", "1234567.89", "0.00", "-87654321.09"]
    df = spark.createDataFrame(
        [(Decimal(v),) for v in values], T.StructType([T.StructField("x", T.DecimalType(15, 2))])
    )
    got = [r[0] for r in df.select(money_cents("x")).collect()]
    assert got == [int(Decimal(v) * 100) for v in values]


def test_cents_to_money_round_trip(spark):
    df = spark.createDataFrame([(9997,), (-5,), (0,)], "c bigint")
    got = [r[0] for r in df.select(cents_to_money("c")).collect()]
    assert got == [Decimal("99.97"), Decimal("-0.05"), Decimal("0.00")]


def test_size_shuffles_only_raises(spark):
    from tidemark.session import input_bytes, size_shuffles

    before = spark.conf.get("spark.sql.shuffle.partitions")
    split = spark.conf.get("spark.sql.files.maxPartitionBytes")
    advisory = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    try:
        assert size_shuffles(spark, 10 * 1024) == int(before)
        assert spark.conf.get("spark.sql.files.maxPartitionBytes") == split
        assert size_shuffles(spark, 100 * (1 << 40)) == 50_000  # 100 TB: capped
        assert int(spark.conf.get("spark.sql.files.maxPartitionBytes")) == 512 << 20
        assert int(spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")) == 256 << 20
        assert size_shuffles(spark, 1) == 50_000  # never lowered
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", advisory)
    assert input_bytes(spark, "/root/testdata/sf0.001") > 0
