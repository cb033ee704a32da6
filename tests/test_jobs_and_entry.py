import math
import sys

import duckdb
import pytest

from tidemark.operators.merge import read_current
from tidemark.operators.transforms import apply_transform, get_transform, identity
from tidemark.plans.jobs import Run, run_jobs
from tidemark.plans.spec import JobOptions, ordered

from .conftest import ROOT, SF_SMALL

sys.path.insert(0, ROOT)
import __spark_entry__ as E  # noqa: E402


def test_transform_registry(spark):
    from tidemark.operators.transforms import register

    assert get_transform(None) is identity
    with pytest.raises(KeyError):
        get_transform("nope")
    df = spark.range(3)
    assert apply_transform(df, None).count() == 3
    register("evens", lambda d: d.where("id % 2 = 0"))
    assert apply_transform(df, "evens").count() == 2


def test_job_order_pulls_dependencies():
    assert ordered(["customer_event"]) == ["customer_orders", "customer_profile", "customer_event"]


def test_all_jobs_end_to_end_and_rerun(spark, tmp_root):
    from tidemark.plans.checks import partsupp_standin
    from tidemark.sources.tables import read_table

    li = read_table(spark, SF_SMALL, "lineitem")
    opts = JobOptions(event_time=1)
    run = Run.create(spark, SF_SMALL, f"{tmp_root}/staging", f"{tmp_root}/target", opts,
                     overrides={"partsupp": partsupp_standin(li)})
    results = run_jobs(run, parallel=4)
    assert [r.name for r in results] == list(ordered())
    counts = {r.name: read_current(spark, f"{tmp_root}/target/{r.name}").count() for r in results}
    customers = read_table(spark, SF_SMALL, "customer").count()
    assert counts["customer_profile"] == customers
    assert counts["customer_event"] == customers
    assert counts["orders"] == read_table(spark, SF_SMALL, "orders").count()
    # lineitem's natural key repeats in this data: the target holds one row per key
    assert counts["lineitem"] == li.select("l_orderkey", "l_linenumber").distinct().count()
    assert results[-1].rows_staged == customers
    assert "custkey" not in read_current(spark, f"{tmp_root}/target/customer_event").columns
    # a second run over the same sources leaves every target unchanged
    run2 = Run.create(spark, SF_SMALL, f"{tmp_root}/staging", f"{tmp_root}/target", opts,
                      overrides={"partsupp": partsupp_standin(li)})
    run2.keep_snapshots = 1
    for r in run_jobs(run2, ["customer_event", "lineitem"]):
        after = read_current(spark, f"{tmp_root}/target/{r.name}")
        assert after.count() == counts[r.name]
    from tidemark.operators.merge import snapshot_versions

    assert snapshot_versions(spark, f"{tmp_root}/target/lineitem") == [2]
    # one transform by name: the event job has no encoding of its own
    from tidemark.plans.spec import SPECS

    assert SPECS["customer_event"].transform == "customer_event"


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == E.entry(spark).columns


def _norm(rows):
    out = []
    for r in rows:
        out.append(tuple(round(v, 6) if isinstance(v, float) and not math.isnan(v) else v for v in r))
    return sorted(out, key=repr)


def test_every_query_has_oracle_and_matches_at_small_scale(spark):
    from tidemark.plans import checks, oracles

    qs, sqls = checks.queries(), oracles.oracle_sql()
    assert set(qs) == set(sqls)
    assert set(qs) <= set(E.queries()) and set(sqls) <= set(E.oracle_sql())
    con = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem".split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    for name, q in qs.items():
        df = q(spark, SF_SMALL)
        rel = con.sql(sqls[name])
        assert sorted(df.columns) == sorted(rel.columns), name
        order = [rel.columns.index(c) for c in df.columns]
        duck = [tuple(r[i] for i in order) for r in rel.fetchall()]
        assert _norm(map(tuple, df.collect())) == _norm(duck), name


def test_dependent_job_alone_names_its_dependency(spark, tmp_root):
    from tidemark.plans.jobs import run_job

    run = Run.create(spark, SF_SMALL, f"{tmp_root}/s", f"{tmp_root}/t", JobOptions(event_time=1))
    with pytest.raises(KeyError, match="customer_profile"):
        run_job(run, "customer_event")


def test_command_line_runs_jobs(spark, tmp_root, capsys):
    import json

    from tidemark.__main__ import main
    from tidemark.operators.merge import snapshot_versions

    args = ["nation", "region", "--source", SF_SMALL, "--staging-root", f"{tmp_root}/s",
            "--target-root", f"{tmp_root}/t", "--parallel", "2", "--keep-snapshots", "1"]
    main(args)
    main(args)
    lines = [json.loads(line) for line in capsys.readouterr().out.splitlines() if line.startswith("{")]
    assert [r["name"] for r in lines] == ["region", "nation", "region", "nation"]
    assert snapshot_versions(spark, f"{tmp_root}/t/nation") == [2]
    assert lines[1]["rows_staged"] == 25


def test_transform_gets_the_options_it_names(spark):
    from tidemark.operators.transforms import register

    register("stamp", lambda d, event_time=None: d.selectExpr("id", f"{event_time} AS t"))
    assert apply_transform(spark.range(1), "stamp", event_time=7, other=1).first()["t"] == 7


def test_customer_without_a_nation_fails_the_load(spark, tmp_root):
    from tidemark.plans.jobs import run_job
    from tidemark.sources.tables import read_table

    none = read_table(spark, SF_SMALL, "nation").limit(0)
    run = Run.create(spark, SF_SMALL, f"{tmp_root}/s", f"{tmp_root}/t", JobOptions(event_time=1), overrides={"nation": none})
    with pytest.raises(Exception, match="NOT NULL column country"):
        run_job(run, "customer_profile")
