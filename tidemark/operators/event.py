"""customer_event: profile joined to its orders, nested as a JSON event.

Reference semantics (E1): one event per customer, whose ``event_parameters``
is a JSON array holding the customer's profile as a JSON *string*; in it,
``customer_order`` is an array of JSON strings, one per order. A customer
without orders gets ``"customer_order":["{}"]``. E2 is the documented nested
shape with real objects and hex identifiers.

Scale design. A customer's orders become one cell, whose size is inherent in
the document; past Spark's cell limit the job fails, it never changes shape.
What a hot customer must not do is gather and sort all its orders in one task,
so lists are built in two levels, the same way for every customer: orders are
collected, sorted and encoded per (customer, first hex digit of the order
identifier), uniform because the identifier is an MD5, and the at most 16
sub-lists of a customer are then joined in digit order. Both levels keep the
order of the raw identifier, so the text repeats. W11, whose orders are written
staging, first counts them (``few_orders_each``): where no customer is hot, its
lists are the same and are built in one level, by one exchange.

The profile meets the finished lists in one LEFT JOIN on the customer; the
event is a projection of the joined row. Differing profile rows of one
customer share its event, as an array of documents: the profile rows are
gathered per customer before the join, on the join's own partitioning.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.tables import present, require
from .partitioning import repartition_by_key

# The event's profile and order fields, in the reference's order.
PROFILE_EVENT_COLUMNS = (
    "customer_aggregate_identifier", "custkey", "name", "address", "country", "phone",
    "account_balance", "total_purchase_order", "total_net_lineitem", "total_gross_lineitem",
    "total_discount_lineitem", "total_tax_lineitem", "market_segment",
)
ORDER_EVENT_COLUMNS = (
    "order_aggregate_identifier", "orderstatus", "totalprice", "orderdate", "orderpriority",
    "clerk", "shippriority",
)
EVENT_TYPE = "MigEvent"

#: Orders of one customer that one task may gather and sort; looked for among this many hashes of the customer.
HOT_ORDERS, BUCKETS = 100_000, 4096

DIGIT = "_digit"
CUSTOMER_ID = "customer_aggregate_identifier"
ORDER_ID = "order_aggregate_identifier"

# Fixed value: the reference's column order of the profile ⟕ orders rows.
PROFILE_ORDERS_COLUMNS = (
    "customer_aggregate_identifier", "order_aggregate_identifier", "custkey", "name", "address",
    "country", "phone", "account_balance", "total_purchase_order", "total_net_lineitem",
    "total_gross_lineitem", "total_discount_lineitem", "total_tax_lineitem", "market_segment",
    "orderstatus", "totalprice", "orderdate", "orderpriority", "clerk", "shippriority",
)


def profile_orders(profile: DataFrame, customer_orders: DataFrame) -> DataFrame:
    """Profile LEFT JOIN customer_orders on the customer identifier.

    One row per (customer, order), or one row with NULL order fields for a
    customer without orders. AQE splits a hot customer's side of the join.
    """
    require(profile, [CUSTOMER_ID, "custkey"], "customer_profile")
    require(customer_orders, [CUSTOMER_ID, ORDER_ID], "customer_orders")
    orders = customer_orders.select(CUSTOMER_ID, *present(customer_orders, ORDER_EVENT_COLUMNS))
    rows = profile.select(*present(profile, PROFILE_EVENT_COLUMNS)).join(orders, CUSTOMER_ID, "left")
    return rows.select(*present(rows, PROFILE_ORDERS_COLUMNS))


def _event_time(event_time: int | None) -> Column:
    return F.unix_timestamp() if event_time is None else F.lit(int(event_time)).cast("bigint")


def order_digit() -> Column:
    """First hex digit of the order's identifier: an even salt, as the identifier is an MD5."""
    return F.coalesce(F.substring(F.hex(F.substring(ORDER_ID, 1, 1)), 1, 1), F.lit(""))


def deal_orders(customer_orders: DataFrame, partitions: int, key: str = CUSTOMER_ID) -> DataFrame:
    """R1 for the order side of W11: dealt by the transform's key and the digit by which lists are built.

    The first level of the lists then needs no exchange of its own, and a hot
    customer's orders lie in up to 16 partitions.
    """
    return repartition_by_key(customer_orders, partitions, key, salt=order_digit(), salt_name=DIGIT)


def few_orders_each(customer_orders: DataFrame) -> bool:
    """Whether no customer has more than ``HOT_ORDERS`` orders, by counts per hash of the customer: a number a bucket and task."""
    bucket = F.pmod(F.xxhash64(CUSTOMER_ID), F.lit(BUCKETS)).alias("bucket")
    counts = customer_orders.groupBy(bucket).agg(F.count(F.lit(1)).alias("n"))
    most, rows = counts.agg(F.max("n"), F.sum("n")).first()
    return (most or 0) - (rows or 0) / BUCKETS <= HOT_ORDERS


def _order_lists(orders: DataFrame, keys: list[str], encode: Callable[[Column], Column], name: str, levels: int = 2) -> DataFrame:
    """Per ``keys`` its orders, encoded, in the order of identifier and encoding, built in two levels (or one).

    Exchanges carry the orders' plain fields, about half the bytes of their
    texts; in two levels a text is made where rows are sorted by it and again in
    the whole list.
    """
    order = F.struct(ORDER_ID, *[c for c in present(orders, ORDER_EVENT_COLUMNS) if c != ORDER_ID])
    by_text = lambda o: F.struct(o[ORDER_ID].alias("k"), encode(o).alias("v"), o.alias("o"))
    ranked = lambda c: F.sort_array(F.transform(c, by_text))
    if levels == 1:
        lists = orders.groupBy(*keys).agg(F.collect_list(order).alias("_part"))
        return lists.select(*keys, F.transform(ranked("_part"), lambda x: x["v"]).alias(name))
    digit = F.col(DIGIT) if DIGIT in orders.columns else order_digit().alias(DIGIT)
    parts = orders.groupBy(*keys, digit).agg(F.collect_list(order).alias("_part"))
    parts = parts.withColumn("_part", F.transform(ranked("_part"), lambda x: x["o"]))
    lists = parts.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(F.col(DIGIT).alias("d"), F.col("_part").alias("p")))).alias("_parts"))
    return lists.select(*keys, F.transform(F.flatten(F.transform("_parts", lambda x: x["p"])), encode).alias(name))


def _with_lists(profile: DataFrame, customer_orders: DataFrame, encode: Callable[[Column], Column], name: str, empty: Column, levels: int = 2) -> DataFrame:
    """J5 + A7: one row per customer: ``custkey``, its profile rows ``_profiles`` and its order list."""
    require(profile, [CUSTOMER_ID, "custkey"], "customer_profile")
    require(customer_orders, [CUSTOMER_ID, ORDER_ID], "customer_orders")
    fields = present(profile, PROFILE_EVENT_COLUMNS)
    profiles = profile.groupBy(CUSTOMER_ID).agg(
        F.min("custkey").alias("custkey"), F.collect_list(F.struct(*fields)).alias("_profiles")
    )
    lists = _order_lists(customer_orders, [CUSTOMER_ID], encode, name, levels)
    joined = profiles.join(lists, CUSTOMER_ID, "left")
    return joined.withColumn(name, F.coalesce(name, empty.cast(lists.schema[name].dataType)))


def _order_json(order: Column) -> Column:
    return F.to_json(order)


def event_rows(profile: DataFrame, customer_orders: DataFrame, levels: int = 2) -> DataFrame:
    """W11's staging rows: per customer its profile rows and the encoded list of its orders.

    ``levels=1`` is for orders of which no customer has very many (``few_orders_each``): the same lists by one exchange.
    """
    return _with_lists(profile, customer_orders, _order_json, "customer_order", F.array(F.lit("{}")), levels)


def _events(rows: DataFrame, event_time: int | None, document: Callable[[Column], Column]) -> DataFrame:
    """A8 + F9-F12: the event columns, ``document`` applied to each profile row of a customer."""
    return rows.select(
        CUSTOMER_ID, "custkey",
        F.to_json(F.sort_array(F.transform("_profiles", document))).alias("event_parameters"),
        F.lit(EVENT_TYPE).alias("event_type"), _event_time(event_time).alias("event_timestamp"),
    )


def _profile_fields(rows: DataFrame) -> list[str]:
    return [f for f in rows.schema["_profiles"].dataType.elementType.names if f != "custkey"]


def encode_events(rows: DataFrame, event_time: int | None = None) -> DataFrame:
    """E1 (the reference's transform, A7 + A8): one encoded event per customer.

    Takes ``event_rows``, or flat profile ⟕ orders rows (e.g. joined by a
    source database), whose lists it first builds in the same two levels.
    ``event_time`` fixes ``event_timestamp`` (epoch seconds) so reruns repeat;
    by default it is the query's start time, constant across task retries.
    """
    if "_profiles" not in rows.columns:
        flat = rows
        fields = present(flat, PROFILE_EVENT_COLUMNS)
        documents = _order_lists(flat, fields, _order_json, "customer_order")
        # the list belongs to the profile row here: it travels in the row's struct
        rows = documents.groupBy(CUSTOMER_ID).agg(
            F.min("custkey").alias("custkey"), F.collect_list(F.struct(*fields, "customer_order")).alias("_profiles")
        )
    fields = _profile_fields(rows)
    own = "customer_order" in fields
    fields = [f for f in fields if f != "customer_order"]

    def document(p: Column) -> Column:
        orders = p["customer_order"] if own else F.col("customer_order")
        return F.to_json(F.struct(*[p[f].alias(f) for f in fields], orders.alias("customer_order")))

    return _events(rows, event_time, document)


def customer_event(profile: DataFrame, customer_orders: DataFrame, event_time: int | None = None) -> DataFrame:
    """Encoded events, one per customer."""
    return encode_events(event_rows(profile, customer_orders), event_time)


# ---- E2: the documented nested shape -------------------------------------------------------

def customer_event_nested(profile: DataFrame, customer_orders: DataFrame, event_time: int | None = None) -> DataFrame:
    """Like E1, but ``event_parameters`` nests real objects:
    ``[{..., "customer_orders": [{...}, ...]}]`` with upper-case hex identifiers
    and ``[]`` for a customer without orders."""
    names = present(customer_orders, ORDER_EVENT_COLUMNS)

    def order(o: Column) -> Column:
        return F.struct(*[(F.hex(o[c]) if c == ORDER_ID else o[c]).alias(c) for c in names])

    rows = _with_lists(profile, customer_orders, order, "customer_orders", F.array())
    fields = _profile_fields(rows)

    def document(p: Column) -> Column:
        return F.struct(
            *[(F.hex(p[f]) if f == CUSTOMER_ID else p[f]).alias(f) for f in fields], F.col("customer_orders")
        )

    return _events(rows, event_time, document)


def nested_event_schema(profile_fields: list[str], order_fields: list[str]) -> T.ArrayType:
    """Schema to parse E2 text back (``from_json``), for the fields present."""
    money = T.DecimalType(15, 2)
    types = {
        "customer_aggregate_identifier": T.StringType(), "name": T.StringType(),
        "address": T.StringType(), "country": T.StringType(), "phone": T.StringType(),
        "account_balance": money, "total_purchase_order": money, "total_net_lineitem": money,
        "total_gross_lineitem": money, "total_discount_lineitem": money, "total_tax_lineitem": money,
        "market_segment": T.StringType(),
        "order_aggregate_identifier": T.StringType(), "orderstatus": T.StringType(),
        "totalprice": money, "orderdate": T.DateType(), "orderpriority": T.StringType(),
        "clerk": T.StringType(), "shippriority": T.StringType(),
    }
    order = T.StructType([T.StructField(f, types[f]) for f in order_fields])
    doc = T.StructType(
        [T.StructField(f, types[f]) for f in profile_fields if f != "custkey"]
        + [T.StructField("customer_orders", T.ArrayType(order))]
    )
    return T.ArrayType(doc)


def flatten_nested_events(events: DataFrame, profile_fields: list[str], order_fields: list[str]) -> DataFrame:
    """Parse E2 text and flatten it to one row per (customer, order)."""
    schema = nested_event_schema(profile_fields, order_fields)
    docs = events.select(F.explode(F.from_json("event_parameters", schema)).alias("d"))
    rows = docs.select("d.*").select(
        *[c for c in schema.elementType.names if c != "customer_orders"],
        F.explode_outer("customer_orders").alias("o"),
    )
    keep = [c for c in rows.columns if c != "o"]
    return rows.select(*keep, *[F.col(f"o.{f}").alias(f) for f in order_fields])


__all__ = [
    "EVENT_TYPE",
    "customer_event",
    "customer_event_nested",
    "encode_events",
    "event_rows",
    "flatten_nested_events",
    "profile_orders",
]
