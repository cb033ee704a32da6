"""Run migration jobs end to end.

One job: staging query -> optional transform -> fresh staging folder (row count
observed while writing) -> read back (this cuts the lineage; a lost executor
recomputes from the staging files, not from the sources) -> upsert into the
target's current snapshot -> publish a new snapshot.

Staging and target folders are named by the caller and must be shared by all
executors.
"""

from __future__ import annotations

import logging
import threading
import time
import uuid
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession

from ..operators.merge import merge_into_snapshot, prune_snapshots
from ..operators.partitioning import set_shuffle_width
from ..operators.transforms import apply_transform
from ..session import child_session, input_bytes, size_shuffles
from ..sinks.conform import definition, write_conforming
from ..sinks.schemas import JDBC_COLUMN_TYPES, NOT_NULL, STAGING_SCHEMAS
from ..sinks.writers import conform, require_not_null, write_bucketed_staging, write_jdbc, write_parquet_staging
from ..sources.jdbc import JdbcEndpoint
from ..sources.tables import ARRIVAL, SOURCE_TABLES, Loader, Maker, TableSet, present
from .spec import SPECS, TRANSFORM_KEY, JobOptions, TableSpec, ordered

log = logging.getLogger("tidemark.jobs")

#: Staging tables that W11 joins on its transform key.
CO_PARTITIONED = ("customer_profile", "customer_orders")


@dataclass
class JobResult:
    name: str
    staging_path: str
    rows_staged: int
    snapshot_path: str
    rows_exported: int | None = None
    rows_rejected: int | None = None


@dataclass
class Run:
    """Shared state of one run over several jobs."""

    spark: SparkSession
    tables: TableSet
    staging_root: str
    target_root: str
    run_id: str = field(default_factory=lambda: uuid.uuid4().hex[:12])
    options: JobOptions = field(default_factory=JobOptions)
    results: dict[str, JobResult] = field(default_factory=dict)
    # Optional staging database (the reference's MySQL staging): each job's
    # staged rows are also loaded there, throttled and batched.
    staging_endpoint: JdbcEndpoint | None = None
    # Committed target snapshots kept per table after a publish (None: all).
    keep_snapshots: int | None = None
    # Buckets of the staging tables that W11 joins (None: plain staging folders).
    co_partition: int | None = None
    # Guards ``tables`` and ``results`` when jobs run concurrently.
    lock: threading.Lock = field(default_factory=threading.Lock, repr=False, compare=False)

    @classmethod
    def create(
        cls,
        spark: SparkSession,
        source_root: str,
        staging_root: str,
        target_root: str,
        options: JobOptions | None = None,
        overrides: dict[str, DataFrame | Maker] | None = None,
        loader: Loader | None = None,
        staging_endpoint: JdbcEndpoint | None = None,
        size_for_input: bool = True,
    ) -> "Run":
        """``loader`` reads sources from elsewhere than parquet under
        ``source_root`` (e.g. ``sources.jdbc.jdbc_loader``). With
        ``size_for_input`` the shuffle width is raised to fit the size of the
        parquet sources (``session.size_shuffles``)."""
        if size_for_input and loader is None and source_root:
            read = [t for t in SOURCE_TABLES if t not in (overrides or {})]
            size_shuffles(spark, input_bytes(spark, *(f"{source_root.rstrip('/')}/{t}.parquet" for t in read)))
        return cls(
            spark=spark,
            tables=TableSet(spark, source_root, overrides, loader),
            staging_endpoint=staging_endpoint,
            staging_root=staging_root,
            target_root=target_root,
            options=options or JobOptions(),
        )


def staging_name(job: str) -> str:
    return f"staging.{job}"


def staging_dataframe(spec: TableSpec, tables: TableSet, options: JobOptions) -> DataFrame:
    df = spec.query(tables, options)
    df = apply_transform(df, spec.transform, event_time=options.event_time)
    if options.quarantine and spec.name in STAGING_SCHEMAS:
        return df
    # the DDL's NOT NULL: all columns of a derived table that the source gives, a copied table's keys
    return require_not_null(df, present(df, NOT_NULL.get(spec.name, spec.merge_keys)))


def _stage(run: Run, spec: TableSpec, df: DataFrame, path: str) -> tuple[int, int | None, Maker]:
    """Write a job's staging: (rows, rows set aside, how a session reads it back)."""
    passing = [c for c in (*spec.target_drops, ARRIVAL) if c in df.columns]
    if run.options.quarantine and spec.name in STAGING_SCHEMAS:
        known = {f.name for f in STAGING_SCHEMAS[spec.name].fields}
        done = write_conforming(df, path, definition(spec.name), [c for c in passing if c not in known])
        return done.fitting, done.rejected, done.rows
    if run.co_partition and spec.name in CO_PARTITIONED:
        table = f"tidemark_{spec.name}_{run.run_id}"
        rows = write_bucketed_staging(df, path, table, TRANSFORM_KEY, run.co_partition)
        return rows, None, lambda spark: spark.table(table)
    return write_parquet_staging(df, path), None, lambda spark: spark.read.parquet(path)


def run_job(run: Run, name: str, adjust_shuffle: bool = False) -> JobResult:
    """Run one job. With ``adjust_shuffle`` the job has a session of its own,
    whose shuffle width is twice its read partitions (R3), and its transform's
    input is dealt to its read partitions by the transform key (R1)."""
    spec = SPECS[name]
    started = time.perf_counter()
    spark, options = run.spark, run.options
    if adjust_shuffle:
        spark = child_session(run.spark)
        set_shuffle_width(spark, spec.read_partitions)
        options = replace(options, partitions=spec.read_partitions if spec.transform_key else None)
    options = replace(options, last_arrival=options.last_arrival and spec.arrives)
    with run.lock:
        tables = run.tables.in_session(spark) if adjust_shuffle else run.tables
    staging_path = f"{run.staging_root.rstrip('/')}/{name}/run={run.run_id}"
    rows, rejected, read = _stage(run, spec, staging_dataframe(spec, tables, options), staging_path)
    log.info("%s: staged %d rows to %s", name, rows, staging_path)
    staged = read(spark)
    # Later jobs (customer_event) read this job's staging output; it lives in
    # its own namespace so a copy job never shadows the source table it copied.
    with run.lock:
        run.tables = run.tables.with_table(staging_name(name), read)
    target_root = f"{run.target_root.rstrip('/')}/{name}"
    snapshot = merge_into_snapshot(
        staged, target_root, spec.merge_keys, spec.target_columns(staged), staged_rows=rows,
        arrival=ARRIVAL if ARRIVAL in staged.columns else None,
    )
    if run.keep_snapshots:
        prune_snapshots(run.spark, target_root, run.keep_snapshots)
    exported = export_staging_jdbc(run, name, run.staging_endpoint) if run.staging_endpoint else None
    result = JobResult(name, staging_path, rows, snapshot, exported, rejected)
    with run.lock:
        run.results[name] = result
    log.info("%s: published %s in %.1fs", name, snapshot, time.perf_counter() - started)
    return result


def export_staging_jdbc(run: Run, name: str, endpoint: JdbcEndpoint, table: str | None = None) -> int:
    """K1-K3, K5, K6: load a job's staged rows into a staging database.

    Reads the run's staging files (not the sources again), conforms derived
    tables to their DDL columns (dropping e.g. ``custkey`` from events),
    truncates the table so reruns never duplicate rows, and writes through
    ``write_partitions`` concurrent connections in ``batch_size`` batches.
    """
    spec = SPECS[name]
    staged = run.tables[staging_name(name)].drop(ARRIVAL)
    schema = STAGING_SCHEMAS.get(name)
    df = conform(staged, schema, fill_missing=True) if schema is not None else staged
    # VARCHAR sizes of the DDL; not on Derby, whose Spark dialect binds a NULL
    # string as CLOB, which Derby will not store in a VARCHAR column.
    types = JDBC_COLUMN_TYPES.get(name) if endpoint.protocol != "derby" else None
    return write_jdbc(
        df, endpoint, table or name, writers=spec.write_partitions, batch_size=spec.batch_size,
        mode="overwrite", column_types=types, truncate=True, materialized=True,
    )


def run_jobs(run: Run, names: list[str] | None = None, parallel: int = 1, adjust_shuffle: bool = False) -> list[JobResult]:
    """Run jobs in dependency order (customer_event after profile and orders).

    With ``parallel > 1`` up to that many independent jobs are submitted at
    once from driver threads; Spark schedules their stages side by side (set
    ``spark.scheduler.mode=FAIR`` to share executors evenly), so small tables
    do not leave the cluster idle. A job starts only after its dependencies
    have published. Results come back in dependency order either way.
    ``adjust_shuffle`` gives each job a session with its own shuffle width
    (``run_job``), so jobs of different widths also run side by side.
    """
    order = ordered(names)
    if parallel <= 1:
        return [run_job(run, n, adjust_shuffle) for n in order]
    done: set[str] = set()
    pending = list(order)
    running = {}
    with ThreadPoolExecutor(max_workers=parallel, thread_name_prefix="tidemark-job") as pool:
        while pending or running:
            ready = [n for n in pending if all(d in done for d in SPECS[n].depends_on)]
            for n in ready[: parallel - len(running)]:
                pending.remove(n)
                running[pool.submit(run_job, run, n, adjust_shuffle)] = n
            if not running:
                raise RuntimeError(f"jobs {pending} wait for dependencies that are not scheduled")
            finished, _ = wait(running, return_when=FIRST_COMPLETED)
            for fut in finished:
                fut.result()  # re-raise a failed job
                done.add(running.pop(fut))
    return [run.results[n] for n in order]
