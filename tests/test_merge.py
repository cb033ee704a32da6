import os

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.merge import (
    PublishConflict,
    current_snapshot,
    dedup_by_key,
    merge_into_snapshot,
    publish,
    read_current,
    snapshot,
    snapshot_versions,
    upsert,
)
from tidemark.operators.snapshots import order_of, parts_of, read_parts, read_range

SCHEMA = "k bigint, a string, b double"


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_upsert_insert_update_keep(spark):
    target = spark.createDataFrame([(1, "old", 1.0), (2, "old", 2.0)], SCHEMA)
    staging = spark.createDataFrame([(2, "new", 20.0), (3, "new", 30.0)], SCHEMA)
    assert _rows(upsert(target, staging, ["k"])) == [(1, "old", 1.0), (2, "new", 20.0), (3, "new", 30.0)]


def test_upsert_empty_target_is_staging(spark):
    staging = spark.createDataFrame([(1, "x", 1.0)], SCHEMA)
    assert _rows(upsert(None, staging, ["k"])) == [(1, "x", 1.0)]
    empty = spark.createDataFrame([], SCHEMA)
    assert _rows(upsert(empty, staging, ["k"])) == [(1, "x", 1.0)]


def test_upsert_twice_is_idempotent(spark):
    target = spark.createDataFrame([(1, "old", 1.0), (2, "old", 2.0)], SCHEMA)
    staging = spark.createDataFrame([(2, "new", 20.0), (3, "new", 30.0), (3, "dup", 31.0)], SCHEMA)
    once = upsert(target, staging, ["k"])
    assert _rows(upsert(once, staging, ["k"])) == _rows(once)


def test_duplicate_keys_greatest_remaining_columns_win(spark):
    staging = spark.createDataFrame(
        [(1, "a", 5.0), (1, "b", 1.0), (1, None, 9.0), (2, "z", None), (2, "z", 0.0)], SCHEMA
    )
    assert _rows(dedup_by_key(staging, ["k"])) == [(1, "b", 1.0), (2, "z", 0.0)]


def test_target_columns_drop_staging_only(spark):
    staging = spark.createDataFrame([(1, "x", 1.0)], SCHEMA)
    out = upsert(None, staging, ["a"], columns=["a", "b"])
    assert out.columns == ["a", "b"]


def test_publish_versions_and_reads(spark, tmp_root):
    root = os.path.join(tmp_root, "target")
    assert read_current(spark, root) is None
    s1 = spark.createDataFrame([(1, "a", 1.0)], SCHEMA)
    p1 = merge_into_snapshot(s1, root, ["k"])
    s2 = spark.createDataFrame([(1, "b", 2.0), (2, "c", 3.0)], SCHEMA)
    p2 = merge_into_snapshot(s2, root, ["k"])
    assert p1 != p2 and current_snapshot(spark, root) == p2
    assert snapshot_versions(spark, root) == [1, 2]
    assert _rows(read_current(spark, root)) == [(1, "b", 2.0), (2, "c", 3.0)]
    # the earlier snapshot is untouched
    old = [os.path.join(root, p["folder"]) for p in snapshot(spark, root, 1)["parts"]]
    assert _rows(spark.read.schema(SCHEMA).parquet(*old)) == [(1, "a", 1.0)]


def test_data_without_a_pointer_is_ignored(spark, tmp_root):
    root = os.path.join(tmp_root, "target")
    publish(spark.createDataFrame([(1, "a", 1.0)], SCHEMA), root, ["k"])
    spark.createDataFrame([(9, "z", 9.0)], SCHEMA).write.parquet(os.path.join(root, "data", "failed"))
    assert snapshot_versions(spark, root) == [1]
    assert _rows(read_current(spark, root)) == [(1, "a", 1.0)]
    p = publish(spark.createDataFrame([(5, "e", 5.0)], SCHEMA), root, ["k"])
    assert p.endswith("v00000002.json")
    assert _rows(read_current(spark, root)) == [(5, "e", 5.0)]


def test_second_publisher_on_one_base_fails(spark, tmp_root):
    root = os.path.join(tmp_root, "target")
    df = spark.createDataFrame([(1, "a", 1.0)], SCHEMA)
    publish(df, root, ["k"])
    publish(spark.createDataFrame([(2, "b", 2.0)], SCHEMA), root, ["k"], base=1)
    with pytest.raises(PublishConflict):  # stale base: the target is at version 2 by now
        publish(df, root, ["k"], base=1)
    assert snapshot_versions(spark, root) == [1, 2]
    assert _rows(read_current(spark, root)) == [(2, "b", 2.0)]


def test_pointer_created_meanwhile_is_a_conflict(spark, tmp_root, monkeypatch):
    """Two publishers that both saw version 1 as the newest: one pointer is created, the other fails."""
    import tidemark.operators.snapshots as snapshots

    root = os.path.join(tmp_root, "target")
    df = spark.createDataFrame([(1, "a", 1.0)], SCHEMA)
    publish(df, root, ["k"])
    publish(spark.createDataFrame([(2, "b", 2.0)], SCHEMA), root, ["k"])
    monkeypatch.setattr(snapshots, "snapshot_versions", lambda *_: [1])
    with pytest.raises(PublishConflict):
        publish(df, root, ["k"], base=1)
    monkeypatch.undo()
    assert _rows(read_current(spark, root)) == [(2, "b", 2.0)]


def test_null_merge_key_fails(spark, tmp_root):
    target = spark.createDataFrame([(1, "a", 1.0)], SCHEMA)
    staging = spark.createDataFrame([(None, "x", 1.0), (2, "b", 2.0)], SCHEMA)
    with pytest.raises(Exception, match="NULL merge key k"):
        upsert(target, staging, ["k"]).collect()
    with pytest.raises(Exception, match="NULL merge key k"):
        merge_into_snapshot(staging, os.path.join(tmp_root, "t"), ["k"])
    assert snapshot_versions(spark, os.path.join(tmp_root, "t")) == []


def _folders(spark, root, version):
    return [p.folder for p in parts_of(snapshot(spark, root, version))]


def _listing(root, folders):
    return {p: sorted(os.listdir(os.path.join(root, p))) for p in folders}


def _holds(spark, root, part_rows):
    """A version's parts own rising ranges, hold what their pointer says, and have no more than their share of rows."""
    pointer = snapshot(spark, root, snapshot_versions(spark, root)[-1])
    parts = parts_of(pointer)
    assert not parts or parts[0].lower is None
    assert all(a.greatest < b.lower <= b.least for a, b in zip(parts, parts[1:]))
    _, value = order_of(T.StructType.fromJson(pointer["schema"]), pointer["keys"])
    for p in parts:
        got = read_parts(spark, root, pointer, [p]).agg(F.count("*"), F.min(value), F.max(value)).first()
        assert tuple(got) == (p.rows, p.least, p.greatest) and p.rows <= 2 * part_rows


def test_a_delta_rewrites_its_key_range_only(spark, tmp_root):
    """1 % of the key range: at most 2 % of the parts are written anew, the others' files stay."""
    root = os.path.join(tmp_root, "target")
    old = spark.range(400_000).select(F.col("id").alias("k"), F.lit("old").alias("a"), F.col("id").cast("double").alias("b"))
    merge_into_snapshot(old, root, ["k"], part_rows=2000)
    before = _folders(spark, root, 1)
    files = _listing(root, before)
    delta = old.where("k >= 200000 and k < 204000 and k % 10 = 0").withColumn("a", F.lit("new"))
    merge_into_snapshot(delta, root, ["k"], staged_rows=400)
    after = _folders(spark, root, 2)
    assert len(before) == 200 and 0 < len(set(after) - set(before)) <= 4 and len(set(before) - set(after)) <= 4
    assert _listing(root, before) == files
    new = read_current(spark, root)
    assert new.count() == 400_000 and new.where("a = 'new'").count() == 400
    assert new.where("a = 'new'").select("k").exceptAll(delta.select("k")).count() == 0
    near = read_range(spark, root, 201_000, 201_999)
    assert near.count() == 1000 and len(near.inputFiles()) < 8
    with pytest.raises(ValueError, match="keyed on"):
        merge_into_snapshot(spark.createDataFrame([(1, "b", 2.0)], SCHEMA), root, ["a"])


def test_rows_beside_full_parts_are_added_without_reading_them(spark, tmp_root):
    root = os.path.join(tmp_root, "target")
    rows = lambda lo, hi: spark.range(lo, hi).select(F.col("id").alias("k"), F.lit("x").alias("a"), F.lit(0.0).alias("b"))
    merge_into_snapshot(rows(1000, 2000), root, ["k"], part_rows=100)
    before = _folders(spark, root, 1)
    assert len(before) == 10
    merge_into_snapshot(rows(5000, 5350), root, ["k"])  # a load of new keys: 350 rows are 4 parts
    assert _folders(spark, root, 2)[:10] == before and len(_folders(spark, root, 2)) == 14
    merge_into_snapshot(rows(0, 60), root, ["k"])
    assert _folders(spark, root, 3)[1:11] == before
    merge_into_snapshot(rows(60, 90), root, ["k"])  # joins the part below, which is not full
    assert len(_folders(spark, root, 4)) == 15 and _folders(spark, root, 4)[1:11] == before
    merge_into_snapshot(rows(1450, 1451), root, ["k"])
    assert len(set(_folders(spark, root, 5)) - set(_folders(spark, root, 4))) == 1
    assert read_current(spark, root).count() == 1000 + 350 + 90
    _holds(spark, root, 100)


def test_writers_follow_the_bytes(spark, tmp_root):
    """16 parts, 200 shuffle partitions: AQE deals them to many tasks, and no file is far above the stated size."""
    root = os.path.join(tmp_root, "target")
    wide = spark.range(160_000).select(F.col("id").alias("k"), F.sha2(F.col("id").cast("string"), 512).alias("a"))
    size = 128 << 10
    conf = {"spark.sql.shuffle.partitions": "200", "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(size), "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false"}
    was = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        publish(wide.repartition(32), root, ["k"], part_rows=10_000)
    finally:
        for k, v in was.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    folders = _folders(spark, root, 1)
    files = [os.path.join(root, p, f) for p in folders for f in os.listdir(os.path.join(root, p)) if f.endswith(".parquet")]
    writers = {os.path.basename(f).split("-")[1] for f in files}
    assert len(folders) == 16 and len(writers) > 64
    assert max(map(os.path.getsize, files)) < 2 * size
    _holds(spark, root, 10_000)


def test_identifier_keys_are_parted_by_hash(spark, tmp_root):
    root = os.path.join(tmp_root, "target")
    rows = spark.range(20_000).select(F.unhex(F.md5(F.col("id").cast("string"))).alias("k"), F.col("id").alias("n"))
    merge_into_snapshot(rows, root, ["k"], part_rows=100)
    before = _folders(spark, root, 1)
    assert 180 <= len(before) <= 220
    merge_into_snapshot(rows.where("n < 5").withColumn("n", -F.col("n")), root, ["k"])
    assert len(set(_folders(spark, root, 2)) - set(before)) <= 5
    assert read_current(spark, root).count() == 20_000
    _holds(spark, root, 100)
    with pytest.raises(ValueError, match="not ordered"):
        read_range(spark, root, 0, 1)


def test_a_hot_first_key_is_one_part(spark, tmp_root):
    """A value that a third of the rows share cannot be cut: one part, written by many tasks."""
    root = os.path.join(tmp_root, "target")
    rows = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).cast("int").alias("p"), F.col("id").alias("s"), F.lit(1).alias("q"))
    merge_into_snapshot(rows, root, ["p", "s"], part_rows=200)
    assert max(p.rows for p in parts_of(snapshot(spark, root, 1))) >= 1000
    merge_into_snapshot(rows.where("p = 7").withColumn("q", F.lit(2)), root, ["p", "s"])
    assert read_current(spark, root).groupBy("q").count().orderBy("q").collect()[1]["count"] == rows.where("p = 7").count()
    assert read_current(spark, root).count() == 3000


_loads = st.lists(st.lists(st.integers(-30, 60), max_size=25), min_size=1, max_size=5)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(loads=_loads)
def test_any_loads_end_as_the_last_row_of_each_key(spark, tmp_root, loads):
    import uuid

    root, model = os.path.join(tmp_root, uuid.uuid4().hex), {}
    for number, keys in enumerate(loads):
        merge_into_snapshot(spark.createDataFrame([(k, "x", float(number)) for k in keys], SCHEMA), root, ["k"], part_rows=6)
        model |= {k: (k, "x", float(number)) for k in keys}
        assert _rows(read_current(spark, root)) == sorted(model.values(), key=repr)
        _holds(spark, root, 6)


def test_empty_staging_publishes_the_same_rows(spark, tmp_root):
    root = os.path.join(tmp_root, "target")
    empty = spark.createDataFrame([], SCHEMA)
    merge_into_snapshot(empty, root, ["k"])
    assert _rows(read_current(spark, root)) == []
    merge_into_snapshot(spark.createDataFrame([(1, "a", 1.0)], SCHEMA), root, ["k"])
    merge_into_snapshot(empty, root, ["k"])
    assert _rows(read_current(spark, root)) == [(1, "a", 1.0)]


_rows_st = st.lists(
    st.tuples(st.integers(0, 6), st.sampled_from(["a", "b", "c", None]), st.integers(-2, 2).map(float)),
    max_size=12,
)


def _model_upsert(target, staging):
    """Reference model: target rows keyed by k, staging rows applied by key;
    among staging duplicates the greatest (a, b) wins, NULLs lowest."""
    def order(row):
        return tuple((v is not None, v if v is not None else 0) for v in row[1:])

    best = {}
    for r in staging:
        if r[0] not in best or order(r) > order(best[r[0]]):
            best[r[0]] = r
    out = [r for r in target if r[0] not in best]
    return sorted(out + list(best.values()), key=repr)


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(target=_rows_st, staging=_rows_st)
def test_upsert_matches_model(spark, target, staging):
    target = list({r[0]: r for r in target}.values())  # a target is unique per key
    t = spark.createDataFrame(target, SCHEMA)
    s = spark.createDataFrame(staging, SCHEMA)
    assert _rows(upsert(t, s, ["k"])) == _model_upsert(target, staging)


def test_every_merge_scenario_inserts_updates_and_keeps(spark):
    from tidemark.plans.checks import UPSERT_TABLES, merge_scenario
    from tidemark.sources.tables import TableSet

    from .conftest import SF_SMALL

    t = TableSet(spark, SF_SMALL)
    for table in UPSERT_TABLES:
        target, staging, keys, _ = merge_scenario(table, t)
        old, new = target.select(*keys).distinct(), staging.select(*keys).distinct()
        counts = (new.join(old, list(keys), "left_anti").count(), new.join(old, list(keys), "left_semi").count(), old.join(new, list(keys), "left_anti").count())
        assert min(counts) > 0, (table, counts)
    target, staging, keys, _ = merge_scenario("customer_event", t)
    kept = target.join(staging, list(keys), "left_anti")
    assert kept.where(kept.event_parameters.contains("{}")).count() > 0  # customers without orders among them


def test_prune_snapshots_keeps_newest(spark, tmp_root):
    from tidemark.operators.merge import prune_snapshots

    root = os.path.join(tmp_root, "target")
    merge_into_snapshot(spark.createDataFrame([(k, "a", 0.0) for k in range(50)], SCHEMA), root, ["k"], part_rows=12)
    for i in range(3):
        merge_into_snapshot(spark.createDataFrame([(1, "b", float(i))], SCHEMA), root, ["k"])
    deleted = prune_snapshots(spark, root, keep=2)
    assert [os.path.basename(p) for p in deleted] == ["v00000001.json", "v00000002.json"]
    assert snapshot_versions(spark, root) == [3, 4]
    # parts that version 1 wrote and no merge touched are still referred to
    assert read_current(spark, root).count() == 50
    assert _rows(read_current(spark, root).where("k = 1")) == [(1, "b", 2.0)]
    assert prune_snapshots(spark, root, keep=2) == []


def test_a_merge_deals_rows_once(spark, tmp_root, monkeypatch):
    """Rows and columns lie as ``upsert`` alone gives them, by one exchange, and a swollen key takes the other way."""
    from tidemark.operators import merge

    taken = []
    by_part = merge._upsert_by_part
    monkeypatch.setattr(merge, "_upsert_by_part", lambda *a: taken.append(by_part(*a)) or taken[-1])
    first = spark.createDataFrame([(f"a{k % 5}", k % 700, k % 3, float(k)) for k in range(1500)], "s string, k long, n int, v double")
    second = spark.createDataFrame([(None, k, k % 3, float(-k)) for k in range(300, 1100) for _ in range(2)], "s string, k long, n int, v double")
    for arrival in (None, "v"):
        for part_rows in (20, 10_000):
            root, columns, want = os.path.join(tmp_root, f"by-{arrival}-{part_rows}"), ["s", "k", "n"] if arrival else None, None
            for staged in (first, second):
                want = upsert(want, staged, ["k", "n"], columns, arrival=arrival)
                merge_into_snapshot(staged, root, ["k", "n"], columns, part_rows=part_rows, arrival=arrival)
                got = read_current(spark, root)
                assert got.columns == want.columns and _rows(got) == _rows(want)
    assert len(taken) == 8
    for df in taken:
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 1 and "Join" not in plan
    hot = first.unionByName(spark.createDataFrame([("h", 7, 1, float(k)) for k in range(200)], first.schema))
    merge_into_snapshot(hot, os.path.join(tmp_root, "hot"), ["k", "n"], part_rows=20)
    assert len(taken) == 8 and _rows(read_current(spark, os.path.join(tmp_root, "hot"))) == _rows(upsert(None, hot, ["k", "n"]))
