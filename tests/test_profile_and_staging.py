import datetime as dt
from decimal import Decimal

import pytest

from tidemark.operators.profile import customer_profile, lineitem_totals, order_totals
from tidemark.operators.staging import (
    stage_copy,
    stage_customer_orders,
)
from tidemark.sources.tables import MissingKeyColumn

CUSTOMER = "c_custkey bigint, c_name string, c_address string, c_nationkey int, c_phone string, " \
    "c_acctbal double, c_mktsegment string, c_comment string"
ORDERS = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, " \
    "o_orderdate timestamp_ntz, o_orderpriority string, o_clerk string, o_shippriority int, o_comment string"
LINEITEM = "l_orderkey bigint, l_extendedprice double, l_discount double, l_tax double"
NATION = "n_nationkey int, n_name string, n_regionkey int, n_comment string"


def _fixture(spark):
    customer = spark.createDataFrame(
        [
            (1, "Ann", "1 Main St", 0, "11-111", 10.5, "BUILDING", "c1"),
            (2, "Bob", "2 Main St", 99, "22-222", -3.0, "MACHINERY", "c2"),  # nation missing
            (3, "Cid", "3 Main St", 0, "33-333", 0.0, "BUILDING", "c3"),  # no orders
        ],
        CUSTOMER,
    )
    nation = spark.createDataFrame([(0, "BRAZIL", 1, "n0")], NATION)
    d = dt.datetime(1996, 1, 2)
    orders = spark.createDataFrame(
        [
            (10, 1, "F", 100.0, d, "1-URGENT", "clerk1", 0, "o10"),
            (11, 1, "O", 50.25, d, "2-HIGH", "clerk2", 0, "o11"),
            (12, 2, "P", 7.5, d, "3-MEDIUM", "clerk3", 1, "o12"),
        ],
        ORDERS,
    )
    lineitem = spark.createDataFrame(
        [(10, 100.0, 0.05, 0.02), (11, 40.0, 0.1, 0.0), (11, 10.0, 0.0, 0.08), (12, 7.5, 0.0, 0.0), (99, 1.0, 0.0, 0.0)],
        LINEITEM,
    )
    return customer, nation, orders, lineitem


def test_profile_edges(spark):
    customer, nation, orders, lineitem = _fixture(spark)
    rows = {r["custkey"]: r for r in customer_profile(customer, nation, orders, lineitem).collect()}
    ann, bob, cid = rows[1], rows[2], rows[3]
    assert ann["country"] == "BRAZIL"
    assert ann["total_purchase_order"] == Decimal("150.25")
    # net = price - discount + tax, the literal formula: 99.97 + 39.90 + 10.08
    assert ann["total_net_lineitem"] == Decimal("149.95")
    assert ann["total_gross_lineitem"] == Decimal("150.00")
    assert ann["total_discount_lineitem"] == Decimal("0.15")
    assert ann["total_tax_lineitem"] == Decimal("0.10")
    assert bob["country"] is None
    for col in ("total_purchase_order", "total_net_lineitem", "total_gross_lineitem"):
        assert cid[col] == Decimal("0.00")
    assert list(rows[1].asDict()) == [
        "custkey", "customer_aggregate_identifier", "name", "address", "country", "phone",
        "account_balance", "total_purchase_order", "total_net_lineitem", "total_gross_lineitem",
        "total_discount_lineitem", "total_tax_lineitem", "market_segment", "comment",
    ]


def test_net_total_single_line(spark):
    _, _, orders, _ = _fixture(spark)
    li = spark.createDataFrame([(10, 100.0, 0.05, 0.02)], LINEITEM)
    (row,) = lineitem_totals(li, orders).collect()
    assert row["total_net_lineitem"] == Decimal("99.97")


def test_order_totals_not_multiplied_by_lines(spark):
    customer, nation, orders, lineitem = _fixture(spark)
    by = {r["o_custkey"]: r["total_purchase_order"] for r in order_totals(orders).collect()}
    assert by[1] == Decimal("150.25")
    prof = {r["custkey"]: r for r in customer_profile(customer, nation, orders, lineitem).collect()}
    assert prof[1]["total_purchase_order"] == by[1]


def test_stage_copy_renames_and_types(spark):
    _, _, orders, _ = _fixture(spark)
    staged = stage_copy(orders, "orders")
    assert staged.columns == [
        "orderkey", "custkey", "orderstatus", "totalprice", "orderdate", "orderpriority",
        "clerk", "shippriority", "comment",
    ]
    assert staged.schema["totalprice"].dataType == orders.schema["o_totalprice"].dataType


def test_stage_copy_missing_key_raises(spark):
    df = spark.createDataFrame([("x",)], "r_name string")
    with pytest.raises(MissingKeyColumn):
        stage_copy(df, "region")


def test_stage_copy_present_columns_only(spark):
    df = spark.createDataFrame([(1, "AFRICA")], "r_regionkey int, r_name string")
    assert stage_copy(df, "region").columns == ["regionkey", "name"]


def test_customer_orders_schema(spark):
    _, _, orders, _ = _fixture(spark)
    co = stage_customer_orders(orders)
    assert co.columns == [
        "orderkey", "order_aggregate_identifier", "customer_aggregate_identifier", "orderstatus",
        "totalprice", "orderdate", "orderpriority", "clerk", "shippriority", "comment",
    ]
    types = {f.name: f.dataType.simpleString() for f in co.schema.fields}
    assert types["order_aggregate_identifier"] == "binary"
    assert types["totalprice"] == "decimal(15,2)"
    assert types["orderdate"] == "date"
    assert types["shippriority"] == "string"
    r = co.where("orderkey = 10").first()
    assert r["orderdate"] == dt.date(1996, 1, 2)
    assert len(r["order_aggregate_identifier"]) == 16


def test_partsupp_standin(spark):
    from tidemark.plans.checks import partsupp_standin

    li = spark.createDataFrame(
        [(1, 2, 3.0, 10.0), (1, 2, 4.0, 5.5), (1, 3, 1.0, 2.0)],
        "l_partkey bigint, l_suppkey bigint, l_quantity double, l_extendedprice double",
    )
    rows = {(r[0], r[1]): r for r in stage_copy(partsupp_standin(li), "partsupp").collect()}
    assert rows[(1, 2)]["availqty"] == 7 and rows[(1, 2)]["supplycost"] == Decimal("5.50")
    assert len(rows) == 2
