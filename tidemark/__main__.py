"""Command line: run migration jobs (``spark-submit -m`` style entry point).

    python -m tidemark customer customer_event --source /data/tpch
    python -m tidemark orders --source-jdbc jdbc:postgresql://host:5432/tpch --source-schema tpch \\
        --staging-jdbc jdbc:mysql://host:3306/staging

Dependencies are pulled in (customer_event runs after customer_profile and
customer_orders). Folders default to the session's ``spark.checkpoint.dir``.
Credentials come from the environment variables named by ``--user-env`` and
``--password-env``, never from the command line.
"""

from __future__ import annotations

import argparse
import json
import logging
import os

from pyspark.sql import SparkSession

from .plans.jobs import Run, run_jobs
from .plans.spec import JOB_ORDER, JobOptions
from .sources.jdbc import JdbcEndpoint, jdbc_loader


def _endpoint(url: str | None, user_env: str | None, password_env: str | None) -> JdbcEndpoint | None:
    if not url:
        return None
    protocol = url.split(":", 2)[1]
    return JdbcEndpoint(
        protocol=protocol,
        url=url,
        user=os.environ.get(user_env) if user_env else None,
        password=os.environ.get(password_env) if password_env else None,
    )


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="tidemark", description=__doc__.splitlines()[0])
    ap.add_argument("jobs", nargs="+", choices=JOB_ORDER, help="jobs to run")
    ap.add_argument("--source", default="", help="folder of <table>.parquet sources")
    ap.add_argument("--source-jdbc", help="JDBC URL of the source database")
    ap.add_argument("--source-schema", help="schema of the source tables, e.g. tpch")
    ap.add_argument("--read-partitions", type=int, default=50, help="key-range chunks per JDBC table")
    ap.add_argument("--chunk-rows", type=int, help="rows per JDBC chunk (instead of --read-partitions)")
    ap.add_argument("--staging-jdbc", help="also load staged rows into this database")
    ap.add_argument("--staging-root", required=True, help="staging folder, shared by all executors")
    ap.add_argument("--target-root", required=True, help="target snapshot folder, shared by all executors")
    ap.add_argument("--adjust-shuffle", action="store_true", help="each job's own shuffle width and transform partitions, by its read partitions")
    ap.add_argument("--last-arrival", action="store_true", help="of staged rows with one key keep the last of the source's files")
    ap.add_argument("--quarantine", action="store_true", help="set rows aside that break a derived table's DDL")
    ap.add_argument("--co-partition", type=int, metavar="BUCKETS", help="bucket the staging tables that customer_event joins")
    ap.add_argument("--parallel", type=int, default=1, help="independent jobs submitted at once")
    ap.add_argument("--keep-snapshots", type=int, help="committed target snapshots kept per table")
    ap.add_argument("--event-time", type=int, help="fixed event_timestamp (epoch seconds)")
    ap.add_argument("--user-env", help="environment variable holding the database user")
    ap.add_argument("--password-env", help="environment variable holding the database password")
    args = ap.parse_args(argv)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(message)s")

    spark = SparkSession.builder.appName("tidemark").getOrCreate()
    source_db = _endpoint(args.source_jdbc, args.user_env, args.password_env)
    loader = (
        jdbc_loader(spark, source_db, args.read_partitions, args.source_schema, chunk_rows=args.chunk_rows)
        if source_db
        else None
    )
    run = Run.create(
        spark,
        args.source,
        args.staging_root,
        args.target_root,
        JobOptions(event_time=args.event_time, last_arrival=args.last_arrival, quarantine=args.quarantine),
        loader=loader,
        staging_endpoint=_endpoint(args.staging_jdbc, args.user_env, args.password_env),
    )
    run.keep_snapshots = args.keep_snapshots
    run.co_partition = args.co_partition
    for result in run_jobs(run, args.jobs, parallel=args.parallel, adjust_shuffle=args.adjust_shuffle):
        print(json.dumps(result.__dict__))


if __name__ == "__main__":
    main()
