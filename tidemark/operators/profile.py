"""Customer totals and the customer_profile staging query.

Plan, designed for a lineitem of billions of rows:

1. ``lineitem_per_order``: lineitem is aggregated by ``l_orderkey`` first.
   Partial aggregation runs map-side, so the shuffle carries one row per order
   and map task instead of one per line (about 4x less for TPC-H), and the
   shuffle already has the partitioning the join on orderkey needs.
2. orders LEFT JOIN those per-order sums on orderkey (one row per order), then
   one aggregation by customer yields the order total and the four line totals.
   The per-order sums are one row per order, so ``o_totalprice`` is never
   counted once per line.
3. customer LEFT JOIN nation (broadcast by Spark while below its threshold) LEFT
   JOIN the per-customer totals (both sides unique per customer: no skew).

All money is summed as exact integer cents (``money_cents``: fixed-width
longs in codegen rather than BigDecimal buffers); the final columns are
DECIMAL(15,2).
A hot customer is harmless: the per-customer aggregation combines map-side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import MONEY, aggregate_identifier, cents_to_money, money, money_cents

LINE_TOTALS = ("total_net_lineitem", "total_gross_lineitem", "total_discount_lineitem", "total_tax_lineitem")

# customer_profile staging columns, in the reference's order
# (custkey is staging-only; the target drops it).
PROFILE_COLUMNS = (
    "custkey", "customer_aggregate_identifier", "name", "address", "country", "phone",
    "account_balance", "total_purchase_order", "total_net_lineitem", "total_gross_lineitem",
    "total_discount_lineitem", "total_tax_lineitem", "market_segment", "comment",
)


def lineitem_per_order(lineitem: DataFrame) -> DataFrame:
    """Per-order line sums in cents, aggregated before the shuffle on orderkey.

    Only gross, discount and tax are summed: the reference's net total,
    ``SUM(price - discount + tax)``, is exactly ``gross - discount + tax`` in
    integer cents (the literal formula, not TPC-H revenue).
    """
    return lineitem.groupBy(F.col("l_orderkey").alias("orderkey")).agg(
        F.sum(money_cents("l_extendedprice")).alias("gross_cents"),
        F.sum(money_cents("l_discount")).alias("discount_cents"),
        F.sum(money_cents("l_tax")).alias("tax_cents"),
    )


def _line_totals() -> list:
    gross, discount, tax = F.col("gross_cents"), F.col("discount_cents"), F.col("tax_cents")
    return [
        cents_to_money(gross - discount + tax).alias("total_net_lineitem"),
        cents_to_money(gross).alias("total_gross_lineitem"),
        cents_to_money(discount).alias("total_discount_lineitem"),
        cents_to_money(tax).alias("total_tax_lineitem"),
    ]


def _sum_cents() -> list:
    return [F.sum(c).alias(c) for c in ("gross_cents", "discount_cents", "tax_cents")]


def order_totals(orders: DataFrame) -> DataFrame:
    """A1: SUM(o_totalprice) per customer."""
    return orders.groupBy("o_custkey").agg(
        cents_to_money(F.sum(money_cents("o_totalprice"))).alias("total_purchase_order")
    )


def lineitem_totals(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    """A2-A5 over J1 (lineitem INNER JOIN orders), per customer."""
    per_order = lineitem_per_order(lineitem)
    owners = orders.select(F.col("o_orderkey").alias("orderkey"), "o_custkey")
    joined = per_order.join(owners, "orderkey", "inner")
    return joined.groupBy("o_custkey").agg(*_sum_cents()).select("o_custkey", *_line_totals())


def customer_totals(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """A1-A5 in one pass over orders: order total and line totals per customer."""
    per_order = lineitem_per_order(lineitem)
    owners = orders.select(
        F.col("o_orderkey").alias("orderkey"), "o_custkey", money_cents("o_totalprice").alias("price_cents")
    )
    joined = owners.join(per_order, "orderkey", "left")
    sums = joined.groupBy("o_custkey").agg(F.sum("price_cents").alias("price_cents"), *_sum_cents())
    return sums.select(
        "o_custkey", cents_to_money(F.col("price_cents")).alias("total_purchase_order"), *_line_totals()
    )


def customer_country(customer: DataFrame, nation: DataFrame) -> DataFrame:
    """Customer LEFT JOIN nation -> (custkey, country)."""
    nations = nation.select("n_nationkey", F.col("n_name").alias("country"))
    return customer.join(nations, customer["c_nationkey"] == nations["n_nationkey"], "left").select(
        F.col("c_custkey").alias("custkey"), "country"
    )


def customer_profile(
    customer: DataFrame, nation: DataFrame, orders: DataFrame, lineitem: DataFrame
) -> DataFrame:
    """14-column profile per customer with exact totals (0 when none)."""
    totals = customer_totals(orders, lineitem)
    nations = nation.select("n_nationkey", F.col("n_name").alias("country"))
    with_country = customer.join(nations, customer["c_nationkey"] == nations["n_nationkey"], "left")
    joined = with_country.join(totals, with_country["c_custkey"] == totals["o_custkey"], "left")
    have = {c.lower() for c in customer.columns}
    zero = F.lit(0).cast(MONEY)
    exprs = {
        "custkey": F.col("c_custkey"),
        "customer_aggregate_identifier": aggregate_identifier("c_custkey"),
        "name": F.col("c_name"),
        "address": F.col("c_address"),
        "country": F.col("country"),
        "phone": F.col("c_phone"),
        "account_balance": money("c_acctbal"),
        "total_purchase_order": F.coalesce("total_purchase_order", zero),
        **{c: F.coalesce(c, zero) for c in LINE_TOTALS},
        "market_segment": F.col("c_mktsegment"),
        "comment": F.col("c_comment"),
    }
    source = {
        "name": "c_name", "address": "c_address", "phone": "c_phone", "account_balance": "c_acctbal",
        "market_segment": "c_mktsegment", "comment": "c_comment",
    }
    keep = [c for c in PROFILE_COLUMNS if c not in source or source[c] in have]
    return joined.select([exprs[c].alias(c) for c in keep])
