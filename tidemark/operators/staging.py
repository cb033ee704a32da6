"""Staging queries: the eight table copies (P1-P8) and customer_orders.

A copy renames ``<prefix>_<name>`` to ``<name>`` and keeps the source type.
Only the columns present in the source are projected; a missing key column
is an error. Every function returns a lazy DataFrame: Catalyst turns the
projection into a pruned parquet scan (``ReadSchema`` lists only these
columns) and no shuffle is added.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import aggregate_identifier, day, money
from ..sources.tables import present, require

# Source columns of each copy job, in the reference's order.
COPY_COLUMNS: dict[str, tuple[str, ...]] = {
    "region": ("r_regionkey", "r_name", "r_comment"),
    "nation": ("n_nationkey", "n_name", "n_regionkey", "n_comment"),
    "customer": (
        "c_custkey", "c_name", "c_address", "c_nationkey", "c_phone", "c_acctbal",
        "c_mktsegment", "c_comment",
    ),
    "supplier": ("s_suppkey", "s_name", "s_address", "s_nationkey", "s_phone", "s_acctbal", "s_comment"),
    "part": (
        "p_partkey", "p_name", "p_mfgr", "p_brand", "p_type", "p_size", "p_container",
        "p_retailprice", "p_comment",
    ),
    "partsupp": ("ps_partkey", "ps_suppkey", "ps_availqty", "ps_supplycost", "ps_comment"),
    "orders": (
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
        "o_orderpriority", "o_clerk", "o_shippriority", "o_comment",
    ),
    "lineitem": (
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
        "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate", "l_commitdate",
        "l_receiptdate", "l_shipinstruct", "l_shipmode", "l_comment",
    ),
}

# Merge keys of the copy targets (TPC-H natural keys), as staged names.
COPY_KEYS: dict[str, tuple[str, ...]] = {
    "region": ("regionkey",),
    "nation": ("nationkey",),
    "customer": ("custkey",),
    "supplier": ("suppkey",),
    "part": ("partkey",),
    "partsupp": ("partkey", "suppkey"),
    "orders": ("orderkey",),
    "lineitem": ("orderkey", "linenumber"),
}

# customer_orders staging columns, in the reference's order
# (orderkey is staging-only; the target drops it).
CUSTOMER_ORDERS_COLUMNS = (
    "orderkey", "order_aggregate_identifier", "customer_aggregate_identifier", "orderstatus",
    "totalprice", "orderdate", "orderpriority", "clerk", "shippriority", "comment",
)


def staged_name(source_column: str) -> str:
    """``c_custkey`` -> ``custkey``: drop the table prefix."""
    return source_column.split("_", 1)[1]


def stage_copy(df: DataFrame, table: str, extra: tuple[str, ...] = ()) -> DataFrame:
    """Rename the present source columns of ``table`` to staged names; ``extra`` columns pass as they are."""
    columns = COPY_COLUMNS[table]
    prefix = columns[0].split("_", 1)[0] + "_"
    require(df, [prefix + k for k in COPY_KEYS[table]], table)
    return df.select([F.col(c).alias(staged_name(c)) for c in present(df, columns)] + list(extra))


def stage_customer_orders(orders: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """Orders with MD5 identifiers for order and customer, exact money, dates."""
    require(orders, ["o_orderkey", "o_custkey"], "orders")
    derived = {
        "orderkey": F.col("o_orderkey"),
        "order_aggregate_identifier": aggregate_identifier("o_orderkey"),
        "customer_aggregate_identifier": aggregate_identifier("o_custkey"),
        "orderstatus": F.col("o_orderstatus"),
        "totalprice": money("o_totalprice"),
        "orderdate": day("o_orderdate"),
        "orderpriority": F.col("o_orderpriority"),
        "clerk": F.col("o_clerk"),
        "shippriority": F.col("o_shippriority").cast("string"),
        "comment": F.col("o_comment"),
    }
    sources = {
        "orderstatus": "o_orderstatus", "totalprice": "o_totalprice", "orderdate": "o_orderdate",
        "orderpriority": "o_orderpriority", "clerk": "o_clerk", "shippriority": "o_shippriority",
        "comment": "o_comment",
    }
    have = {c.lower() for c in orders.columns}
    keep = [c for c in CUSTOMER_ORDERS_COLUMNS if c not in sources or sources[c] in have]
    return orders.select([derived[c].alias(c) for c in keep] + list(extra))
