"""Job specifications: one frozen ``TableSpec`` per migration job.

A spec names the staging query (a function of the source tables), the key
the source is chunked on, the target's merge keys, the columns the target
drops, an optional transform, and the tuning values of the reference's
configs (read/write partitions, JDBC batch size).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from ..operators.event import deal_orders, event_rows, few_orders_each
from ..operators.profile import customer_profile
from ..operators.staging import COPY_KEYS, stage_copy, stage_customer_orders
from ..sources.tables import ARRIVAL, with_arrival

Query = Callable[[Mapping[str, DataFrame], "JobOptions"], DataFrame]


@dataclass(frozen=True)
class JobOptions:
    """Per-run values.

    ``event_time``: a fixed one makes reruns repeat. ``last_arrival``: among
    staged rows of one key the last to arrive in the source's files wins (copy
    jobs and customer_orders), not the greatest. ``quarantine``: rows that break
    a derived table's DDL are set aside instead of failing the job.
    ``partitions``: how many partitions the transform's input is dealt to by the
    job's ``transform_key``; set by the runner.
    """

    event_time: int | None = None
    last_arrival: bool = False
    quarantine: bool = False
    partitions: int | None = None


@dataclass(frozen=True)
class TableSpec:
    name: str
    query: Query
    partition_key: str
    merge_keys: tuple[str, ...]
    target_drops: tuple[str, ...] = ()
    transform: str | None = None
    transform_key: str | None = None
    arrives: bool = False  # one source row a staged row: the source's arrival order can decide
    read_partitions: int = 50
    write_partitions: int = 20
    batch_size: int = 1000
    depends_on: tuple[str, ...] = field(default=())

    def target_columns(self, staged: DataFrame) -> list[str]:
        """The staging columns the target keeps."""
        return [c for c in staged.columns if c not in self.target_drops]


def _copy(table: str) -> Query:
    def query(t: Mapping[str, DataFrame], opts: JobOptions) -> DataFrame:
        return stage_copy(with_arrival(t[table]), table, (ARRIVAL,)) if opts.last_arrival else stage_copy(t[table], table)

    return query


def _customer_orders(t: Mapping[str, DataFrame], opts: JobOptions) -> DataFrame:
    return stage_customer_orders(with_arrival(t["orders"]), (ARRIVAL,)) if opts.last_arrival else stage_customer_orders(t["orders"])


def _customer_profile(t: Mapping[str, DataFrame], _opts: JobOptions) -> DataFrame:
    return customer_profile(t["customer"], t["nation"], t["orders"], t["lineitem"])


def _customer_event(t: Mapping[str, DataFrame], opts: JobOptions) -> DataFrame:
    # Reads the staging outputs of customer_profile and customer_orders; the
    # job's transform encodes the rows.
    profile, orders = t["staging.customer_profile"], t["staging.customer_orders"]
    if opts.partitions:
        return event_rows(profile, deal_orders(orders, opts.partitions, TRANSFORM_KEY))
    return event_rows(profile, orders, levels=1 if few_orders_each(orders) else 2)


# Fixed value: the transform key that all of the reference's job configs name.
TRANSFORM_KEY = "customer_aggregate_identifier"

# Partition keys and tuning values of the reference's job configs.
_COPY_PARTITION_KEY = {
    "region": "regionkey", "nation": "nationkey", "customer": "custkey", "supplier": "suppkey",
    "part": "partkey", "partsupp": "partkey", "orders": "orderkey", "lineitem": "orderkey",
}

SPECS: dict[str, TableSpec] = {
    **{
        table: TableSpec(
            name=table,
            query=_copy(table),
            partition_key=key,
            merge_keys=COPY_KEYS[table],
            arrives=table != "partsupp",
            read_partitions=50,
            write_partitions=10,
            batch_size=10_000,
        )
        for table, key in _COPY_PARTITION_KEY.items()
    },
    "customer_orders": TableSpec(
        name="customer_orders",
        query=_customer_orders,
        partition_key="orderkey",
        merge_keys=("order_aggregate_identifier",),
        arrives=True,
        target_drops=("orderkey",),
        read_partitions=50,
        write_partitions=10,
        batch_size=10_000,
    ),
    "customer_profile": TableSpec(
        name="customer_profile",
        query=_customer_profile,
        partition_key="custkey",
        merge_keys=("customer_aggregate_identifier",),
        target_drops=("custkey",),
        read_partitions=50,
        write_partitions=10,
        batch_size=10_000,
    ),
    "customer_event": TableSpec(
        name="customer_event",
        query=_customer_event,
        partition_key="custkey",
        merge_keys=("customer_aggregate_identifier",),
        target_drops=("custkey",),
        transform="customer_event",
        transform_key=TRANSFORM_KEY,
        read_partitions=500,
        write_partitions=50,
        batch_size=10_000,
        depends_on=("customer_profile", "customer_orders"),
    ),
}

JOB_ORDER = (
    "region", "nation", "customer", "supplier", "part", "partsupp", "orders", "lineitem",
    "customer_orders", "customer_profile", "customer_event",
)


def ordered(names: list[str] | None = None) -> list[str]:
    """Job names in dependency order (dependencies are pulled in)."""
    wanted = set(names or JOB_ORDER)
    changed = True
    while changed:
        changed = False
        for n in list(wanted):
            for dep in SPECS[n].depends_on:
                if dep not in wanted:
                    wanted.add(dep)
                    changed = True
    return [n for n in JOB_ORDER if n in wanted]
