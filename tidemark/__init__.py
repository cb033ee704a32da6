"""tidemark: table migration and reshaping as Spark DataFrame jobs.

The main entry points, importable from the package root::

    from tidemark import Run, run_jobs, customer_profile, customer_event, upsert
"""

from .operators.event import customer_event, customer_event_nested, encode_events, profile_orders
from .operators.merge import dedup_by_key, merge_into_snapshot, prune_snapshots, publish, read_current, upsert
from .operators.profile import customer_profile, customer_totals
from .operators.staging import stage_copy, stage_customer_orders
from .plans.jobs import Run, run_job, run_jobs
from .plans.spec import SPECS, JobOptions, TableSpec
from .sources.tables import TableSet

__version__ = "0.1.0"

__all__ = [
    "JobOptions",
    "Run",
    "SPECS",
    "TableSet",
    "TableSpec",
    "customer_event",
    "customer_event_nested",
    "customer_profile",
    "customer_totals",
    "dedup_by_key",
    "encode_events",
    "merge_into_snapshot",
    "profile_orders",
    "prune_snapshots",
    "publish",
    "read_current",
    "run_job",
    "run_jobs",
    "stage_copy",
    "stage_customer_orders",
    "upsert",
]
