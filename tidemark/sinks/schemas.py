"""Staging and target schemas of the derived tables (K5).

Fixed values: column names and types of the reference's DDL, with the
primary key named after the existing identifier column. Integer keys are
``bigint`` (TPC-H keys outgrow INT at large scale factors) and the event
timestamp is ``bigint`` epoch seconds.
"""

from __future__ import annotations

from pyspark.sql import types as T

_money = T.DecimalType(15, 2)


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields])


CUSTOMER_ORDERS_STAGING = _schema(
    ("orderkey", T.LongType()),
    ("order_aggregate_identifier", T.BinaryType()),
    ("customer_aggregate_identifier", T.BinaryType()),
    ("orderstatus", T.StringType()),
    ("totalprice", _money),
    ("orderdate", T.DateType()),
    ("orderpriority", T.StringType()),
    ("clerk", T.StringType()),
    ("shippriority", T.StringType()),
    ("comment", T.StringType()),
)
CUSTOMER_ORDERS_TARGET = T.StructType(CUSTOMER_ORDERS_STAGING.fields[1:])

CUSTOMER_PROFILE_STAGING = _schema(
    ("custkey", T.LongType()),
    ("customer_aggregate_identifier", T.BinaryType()),
    ("name", T.StringType()),
    ("address", T.StringType()),
    ("country", T.StringType()),
    ("phone", T.StringType()),
    ("account_balance", _money),
    ("total_purchase_order", _money),
    ("total_net_lineitem", _money),
    ("total_gross_lineitem", _money),
    ("total_discount_lineitem", _money),
    ("total_tax_lineitem", _money),
    ("market_segment", T.StringType()),
    ("comment", T.StringType()),
)
CUSTOMER_PROFILE_TARGET = T.StructType(CUSTOMER_PROFILE_STAGING.fields[1:])

CUSTOMER_EVENT_STAGING = _schema(
    ("customer_aggregate_identifier", T.BinaryType()),
    ("event_type", T.StringType()),
    ("event_timestamp", T.LongType()),
    ("event_parameters", T.StringType()),
)
CUSTOMER_EVENT_TARGET = CUSTOMER_EVENT_STAGING

# JDBC column types for tables Spark creates (``createTableColumnTypes``).
JDBC_COLUMN_TYPES = {
    "customer_orders": "orderstatus VARCHAR(2), orderpriority VARCHAR(10), clerk VARCHAR(50), "
    "shippriority VARCHAR(10), comment VARCHAR(200)",
    "customer_profile": "name VARCHAR(100), address VARCHAR(100), country VARCHAR(50), "
    "phone VARCHAR(20), market_segment VARCHAR(50), comment VARCHAR(200)",
    "customer_event": "event_type VARCHAR(20)",
}

STAGING_SCHEMAS = {
    "customer_orders": CUSTOMER_ORDERS_STAGING,
    "customer_profile": CUSTOMER_PROFILE_STAGING,
    "customer_event": CUSTOMER_EVENT_STAGING,
}

# The DDL declares every column of the derived tables NOT NULL but the event's document.
NOT_NULL = {
    name: tuple(f.name for f in schema.fields if f.name != "event_parameters") for name, schema in STAGING_SCHEMAS.items()
}
