"""Plan-shape guards: the scale properties of the headline operators.

Large inputs are simulated as in ``scripts/show_plans.py``: automatic
broadcasts off. Only a merge that knows its staged row count still broadcasts.
"""

import re

import pytest

from tidemark.operators.event import customer_event, profile_orders
from tidemark.operators.merge import upsert
from tidemark.operators.profile import customer_profile
from tidemark.operators.staging import COPY_KEYS, stage_copy, stage_customer_orders
from tidemark.sources.tables import TableSet

from .conftest import SF_SMALL


@pytest.fixture()
def big(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        yield TableSet(spark, SF_SMALL)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _hash_exchanges(plan: str) -> list[str]:
    return re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)


def test_profile_shuffles_lineitem_once_and_pre_aggregated(big):
    plan = _plan(customer_profile(big["customer"], big["nation"], big["orders"], big["lineitem"]))
    exchanges = _hash_exchanges(plan)
    # lineitem (pre-aggregated), orders, per-customer partial sums, nation join (2), customer
    assert len(exchanges) == 6, exchanges
    assert sum("l_orderkey" in e for e in exchanges) == 1
    li = plan.index("Exchange hashpartitioning(l_orderkey")
    assert "partial_sum" in plan[li:], "lineitem must be partially aggregated before its shuffle"


def test_events_read_the_profile_once(big):
    """One left join: five scans, no document aggregate, no counting pass."""
    profile = customer_profile(big["customer"], big["nation"], big["orders"], big["lineitem"])
    orders = stage_customer_orders(big["orders"])
    for plan in (_plan(customer_event(profile, orders, 1)), _plan(profile_orders(profile, orders))):
        assert plan.count("FileScan") == 5
        assert "LeftAnti" not in plan and "Union" not in plan


def test_no_shuffle_below_a_partial_aggregate(big):
    from tidemark.plans.checks import queries

    plan = _plan(queries()["customer_profile"](big.spark, SF_SMALL))
    # a scan is never repartitioned: every exchange is one an operator requires
    assert "REPARTITION" not in plan


def test_small_delta_merge_never_shuffles_the_target(big):
    li = stage_copy(big["lineitem"], "lineitem")
    target = li.where("shipdate < DATE '1998-01-01'")
    delta = li.where("shipdate >= DATE '2001-01-01'")
    plan = _plan(upsert(target, delta, COPY_KEYS["lineitem"], staged_rows=1000))
    assert "LeftAnti" in plan and "BroadcastHashJoin" in plan
    # only the delta is shuffled: its distinct keys and its dedup
    assert len(_hash_exchanges(plan)) == 2
    large = _plan(upsert(target, delta, COPY_KEYS["lineitem"]))
    assert "SortMergeJoin" in large and len(_hash_exchanges(large)) == 3
    assert "SinglePartition" not in plan + large  # no size check through one task
