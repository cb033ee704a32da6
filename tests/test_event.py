import base64
import json

from pyspark.sql import functions as F

from tidemark.operators.event import (
    customer_event,
    customer_event_nested,
    encode_events,
    flatten_nested_events,
    profile_orders,
)
from tidemark.operators.profile import customer_profile
from tidemark.operators.staging import stage_customer_orders
from tidemark.sources.tables import TableSet

from .conftest import SF_SMALL
from .test_profile_and_staging import _fixture


def _staged(spark):
    customer, nation, orders, lineitem = _fixture(spark)
    return customer_profile(customer, nation, orders, lineitem), stage_customer_orders(orders)


def test_event_shape_and_no_orders(spark):
    profile, orders = _staged(spark)
    events = {r["custkey"]: r for r in customer_event(profile, orders, event_time=42).collect()}
    assert len(events) == 3
    cid = events[3]
    assert cid["event_type"] == "MigEvent" and cid["event_timestamp"] == 42
    (doc,) = [json.loads(s) for s in json.loads(cid["event_parameters"])]
    assert doc["customer_order"] == ["{}"]
    assert "custkey" not in doc and doc["name"] == "Cid"
    (ann,) = [json.loads(s) for s in json.loads(events[1]["event_parameters"])]
    orders_of_ann = [json.loads(s) for s in ann["customer_order"]]
    assert sorted(o["orderstatus"] for o in orders_of_ann) == ["F", "O"]
    assert ann["total_purchase_order"] == 150.25
    assert list(ann)[-1] == "customer_order"
    assert '"total_purchase_order":150.25' in json.loads(events[1]["event_parameters"])[0]


def test_nested_event_no_orders_is_empty_list(spark):
    profile, orders = _staged(spark)
    events = {r["custkey"]: r for r in customer_event_nested(profile, orders, event_time=1).collect()}
    (doc,) = json.loads(events[3]["event_parameters"])
    assert doc["customer_orders"] == []
    (ann,) = json.loads(events[1]["event_parameters"])
    assert len(ann["customer_orders"]) == 2
    assert ann["customer_aggregate_identifier"].isupper()


def test_json_escaping_quotes_and_non_ascii(spark):
    customer, nation, orders, lineitem = _fixture(spark)
    customer = customer.withColumn("c_name", F.when(F.col("c_custkey") == 1, F.lit('O"Brien é\\')).otherwise(F.col("c_name")))
    profile = customer_profile(customer, nation, orders, lineitem)
    ev = customer_event(profile, stage_customer_orders(orders), event_time=1).where("custkey = 1").first()
    (doc,) = [json.loads(s) for s in json.loads(ev["event_parameters"])]
    assert doc["name"] == 'O"Brien é\\'


def test_transform_called_twice_same_output(spark):
    profile, orders = _staged(spark)
    a = sorted(map(tuple, customer_event(profile, orders, 7).collect()))
    b = sorted(map(tuple, customer_event(profile, orders, 7).collect()))
    assert a == b


def test_encode_flat_rows_equals_customer_event(spark):
    profile, orders = _staged(spark)
    flat = profile_orders(profile, orders)
    a = sorted(map(tuple, encode_events(flat, 5).select("custkey", "event_parameters").collect()))
    b = sorted(map(tuple, customer_event(profile, orders, 5).select("custkey", "event_parameters").collect()))
    assert a == b


def test_two_levels_keep_every_order_in_identifier_order(spark):
    """Sub-lists by the identifier's first digit, joined: each customer's event
    holds its orders once, sorted by the raw 16 bytes (not by base64 text)."""
    t = TableSet(spark, SF_SMALL)
    profile = customer_profile(t["customer"], t["nation"], t["orders"], t["lineitem"])
    orders = stage_customer_orders(t["orders"])
    expected = {}
    for r in orders.select("customer_aggregate_identifier", "order_aggregate_identifier").collect():
        expected.setdefault(bytes(r[0]), []).append(bytes(r[1]))
    events = customer_event(profile, orders, event_time=1).collect()
    assert len(events) == profile.count()
    for e in events:
        (doc,) = [json.loads(s) for s in json.loads(e["event_parameters"])]
        ids = [json.loads(o).get("order_aggregate_identifier") for o in doc["customer_order"]]
        raw = [base64.b64decode(i) for i in ids if i is not None]
        assert raw == sorted(expected.get(bytes(e["customer_aggregate_identifier"]), []))


def test_null_order_identifiers_come_first(spark):
    profile, orders = _staged(spark)
    nameless = orders.where("orderstatus = 'O'").withColumn("order_aggregate_identifier", F.lit(None).cast("binary"))
    event = customer_event(profile, orders.unionByName(nameless), 1).where("custkey = 1").first()
    (doc,) = [json.loads(s) for s in json.loads(event["event_parameters"])]
    assert ["order_aggregate_identifier" in json.loads(o) for o in doc["customer_order"]] == [False, True, True]


def test_nested_roundtrip_matches_profile_orders(spark):
    profile, orders = _staged(spark)
    events = customer_event_nested(profile, orders, 1)
    flat = flatten_nested_events(
        events,
        ["customer_aggregate_identifier", "name", "country"],
        ["order_aggregate_identifier", "orderstatus", "totalprice"],
    )
    assert flat.count() == profile_orders(profile, orders).count()


def test_hot_customer_holding_a_third_of_orders(spark):
    """One customer holds a third of all orders: still one event, with every order."""
    t = TableSet(spark, SF_SMALL)
    orders = t["orders"].withColumn(
        "o_custkey", F.when(F.col("o_orderkey") % 3 == 0, F.lit(7)).otherwise(F.col("o_custkey"))
    )
    profile = customer_profile(t["customer"], t["nation"], orders, t["lineitem"])
    staged = stage_customer_orders(orders)
    parsed = F.from_json(F.get_json_object(F.col("event_parameters"), "$[0]"), "customer_order array<string>")
    events = customer_event(profile, staged, event_time=1)
    rows = events.select("custkey", F.size(parsed["customer_order"]).alias("n"), F.col("event_parameters").contains('"{}"').alias("none")).collect()
    assert len(rows) == profile.count() == len({r["custkey"] for r in rows})
    hot = next(r for r in rows if r["custkey"] == 7)
    hot_orders = orders.where("o_custkey = 7").count()
    assert hot["n"] == hot_orders > staged.count() // 3 - 1
    with_orders = {r[0] for r in orders.select("o_custkey").distinct().collect()}
    assert sum(r["n"] for r in rows if r["custkey"] in with_orders) == staged.count()


def test_encoded_event_parses_to_nested_content(spark):
    """E1 (JSON strings inside JSON) and E2 (nested objects) carry the same
    content once identifiers are compared as hex."""
    profile, orders = _staged(spark)
    e1 = {r["custkey"]: r["event_parameters"] for r in customer_event(profile, orders, 1).collect()}
    e2 = {r["custkey"]: r["event_parameters"] for r in customer_event_nested(profile, orders, 1).collect()}
    assert set(e1) == set(e2)

    def hexed(b64):
        return base64.b64decode(b64).hex().upper()

    for custkey in e1:
        (doc1,) = [json.loads(s) for s in json.loads(e1[custkey])]
        (doc2,) = json.loads(e2[custkey])
        orders1 = [json.loads(o) for o in doc1.pop("customer_order") if o != "{}"]
        orders2 = doc2.pop("customer_orders")
        doc1["customer_aggregate_identifier"] = hexed(doc1["customer_aggregate_identifier"])
        for o in orders1:
            o["order_aggregate_identifier"] = hexed(o["order_aggregate_identifier"])
        assert doc1 == doc2
        assert sorted(orders1, key=repr) == sorted(orders2, key=repr)


def test_default_event_time_is_query_time_and_constant(spark):
    import time

    profile, orders = _staged(spark)
    before = int(time.time())
    stamps = {r["event_timestamp"] for r in customer_event(profile, orders).collect()}
    after = int(time.time())
    assert len(stamps) == 1  # one value for the whole query, all tasks
    (stamp,) = stamps
    assert before - 5 <= stamp <= after + 5


def test_differing_profile_rows_of_one_customer_share_one_event(spark):
    profile, orders = _staged(spark)
    twin = profile.where("custkey = 1").withColumn("name", F.lit("Ann B"))
    events = customer_event(profile.unionByName(twin), orders, 1).where("custkey = 1").collect()
    assert len(events) == 1
    docs = [json.loads(s) for s in json.loads(events[0]["event_parameters"])]
    assert sorted(d["name"] for d in docs) == ["Ann", "Ann B"]
    assert all(len(d["customer_order"]) == 2 for d in docs)


def test_lists_of_few_orders_are_built_by_one_exchange(spark, monkeypatch):
    """One level gives the texts of two, for repeated identifiers too, and is taken only where no customer is hot."""
    from tidemark.operators import event
    from tidemark.plans.spec import SPECS, JobOptions

    ids = lambda c: F.unhex(F.md5(c.cast("string")))
    orders = spark.range(400).select(
        ids(F.col("id") % 130).alias("order_aggregate_identifier"), ids(F.col("id") % 7).alias("customer_aggregate_identifier"),
        F.when(F.col("id") % 3 > 0, F.col("id").cast("string")).alias("orderstatus"), (F.col("id") * 5 % 9).cast("decimal(15,2)").alias("totalprice"),
    )
    profile = spark.range(9).select(F.col("id").alias("custkey"), ids(F.col("id")).alias("customer_aggregate_identifier"))
    texts = lambda df: sorted((r["custkey"], r["event_parameters"]) for r in event.encode_events(df, 1).collect())
    exchanges = lambda df: df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")
    staged = {"staging.customer_profile": profile, "staging.customer_orders": orders}
    want = texts(event.event_rows(profile, orders))
    one = SPECS["customer_event"].query(staged, JobOptions())
    monkeypatch.setattr(event, "HOT_ORDERS", 10)
    two = SPECS["customer_event"].query(staged, JobOptions())
    assert texts(one) == texts(two) == want and exchanges(two) == exchanges(one) + 1
