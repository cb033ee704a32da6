"""Keyed merge (upsert) of a staging table into a target.

``INSERT ... ON DUPLICATE KEY UPDATE`` semantics: a new key is inserted, an
existing key takes every column of the staging row, a target-only row stays.
Nothing is deleted. Merge keys are NOT NULL, as in the DDL: a NULL key fails
the job.

Spark plan: staging is reduced to one row per key with ``max(struct(...))``
(a partial aggregate, so even a key holding a third of the rows is combined
map-side before the shuffle), then ``target LEFT ANTI staged keys`` keeps the
untouched rows and ``unionByName`` appends the staged rows. Both join sides
are unique per key, so there is no skew. No job runs while the plan is built:
a caller that knows the staged row count (a job observed it while writing
staging) passes it, and keys of fixed width that are few enough bytes are then
broadcast; otherwise the join is left to ``autoBroadcastJoinThreshold`` and AQE.

``merge_into_snapshot`` publishes the result (U14): see ``snapshots``. There old
and staged rows are dealt once, by the part they will lie in and a hash of the
key, and are merged and written where they lie; ``upsert``'s exchanges by key and
the writers' by part are not paid. Only where one key swells its share to several
parts' rows is ``upsert`` taken, whose partial aggregates combine such a key
map-side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.bounds import range_index
from ..sources.tables import require
from .snapshots import (
    HASH_PART_ROWS,
    PART,
    PART_ROWS,
    VALUE,
    Part,
    PublishConflict,
    commit,
    current_snapshot,
    inner_cuts,
    new_layout,
    order_of,
    parts_of,
    plan_changes,
    pointer_for,
    prune_snapshots,
    read_current,
    read_parts,
    snapshot,
    snapshot_versions,
    staged_per_part,
    write_parts,
)

__all__ = [
    "PublishConflict", "current_snapshot", "dedup_by_key", "merge_into_snapshot", "prune_snapshots",
    "publish", "read_current", "snapshot", "snapshot_versions", "upsert",
]

#: Staged keys are broadcast up to this many bytes: rows observed x bytes a key takes.
BROADCAST_KEY_BYTES = 32 << 20
STAGED, SLOT = "_staged", "_slot"
#: A part's rows are dealt to up to this many tasks, fewer where the parts alone are many times the shuffle width.
SLOTS, SHARES = 8, 16
#: Rows that one task may merge, in parts; past it a key is hot and the merge combines map-side.
SWOLLEN = 4
_ROW_BYTES = 16  # of a broadcast row, beside 8 for each column


def dedup_by_key(staging: DataFrame, keys: Sequence[str], arrival: str | None = None) -> DataFrame:
    """One row per key, the same one in every run.

    Among duplicates the row that is greatest on the remaining columns (in
    column order, NULLs lowest) wins. With ``arrival``, a column that orders
    rows as they came (``sources.tables.with_arrival``), the last to arrive
    wins, as when a database applies them one after another; the column itself
    is dropped. Both are partial aggregates: a hot key is combined map-side.
    """
    keys = list(keys)
    require(staging, keys, "staging")
    kept = [c for c in staging.columns if c != arrival]
    others = [c for c in kept if c not in keys]
    if not others:
        return staging.select(*kept).dropDuplicates(keys)
    row = F.struct(*others)
    best = staging.groupBy(*keys).agg((F.max(row) if arrival is None else F.max_by(row, F.col(arrival))).alias("_row"))
    return best.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in others]).select(*kept)


def _not_null(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Fail, when the rows are computed, on a NULL in a merge key."""
    checked = {k: F.coalesce(F.col(k), F.raise_error(F.lit(f"NULL merge key {k}")).cast(df.schema[k].dataType)) for k in keys}
    return df.withColumns(checked)


def _key_bytes(schema: T.StructType) -> int | None:
    """Bytes of a broadcast row of these columns, None where a type's width has no bound."""
    fixed = (T.IntegralType, T.FractionalType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)
    if not all(isinstance(f.dataType, fixed) for f in schema.fields):
        return None
    return _ROW_BYTES + sum(24 if isinstance(f.dataType, T.DecimalType) else 8 for f in schema.fields)


def _target_columns(
    target: DataFrame | None, staging: DataFrame, keys: Sequence[str], columns: Sequence[str] | None, arrival: str | None
) -> list[str]:
    if columns is None:
        columns = target.columns if target is not None else staging.columns
    columns = [c for c in columns if c != arrival]
    missing = [k for k in keys if k not in columns]
    if missing:
        raise ValueError(f"merge keys {missing} are not target columns {columns}")
    return columns


def _few_keys(changed: DataFrame, staged_rows: int | None) -> bool:
    """Whether keys of this many staged rows are few enough bytes to broadcast."""
    width = _key_bytes(changed.schema)
    return staged_rows is not None and width is not None and staged_rows * width <= BROADCAST_KEY_BYTES


def upsert(
    target: DataFrame | None,
    staging: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str] | None = None,
    deduplicate: bool = True,
    staged_rows: int | None = None,
    arrival: str | None = None,
) -> DataFrame:
    """Merge ``staging`` into ``target`` on ``keys``.

    ``columns`` is the target column list (P12: staging-only columns such as
    ``orderkey`` are dropped); by default the target's columns, else staging's.
    ``staged_rows``, where known, bounds the staged keys: fixed-width keys of
    up to ``BROADCAST_KEY_BYTES`` in all are broadcast. ``arrival``: see
    ``dedup_by_key``.
    """
    keys = list(keys)
    columns = _target_columns(target, staging, keys, columns, arrival)
    staged = _not_null(staging.select(*columns, *([arrival] if arrival else [])), keys)
    if deduplicate or arrival:
        staged = dedup_by_key(staged, keys, arrival)
    if target is None:
        return staged
    changed = staged.select(*keys)
    if _few_keys(changed, staged_rows):
        changed = F.broadcast(changed)
    kept = target.select(*columns).join(changed, keys, "left_anti")
    return kept.unionByName(staged)


def _slot(keys: Sequence[str], slots: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(slots)).cast("int")


def _upsert_by_part(
    target: DataFrame | None,
    staging: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str] | None,
    part: Column | None,
    slots: int,
    staged_rows: int | None = None,
    arrival: str | None = None,
) -> DataFrame:
    """``upsert`` with one exchange: old and staged rows are dealt by ``part``, a function of the keys, and a slot, and merged there.

    Without ``part`` there is one: Spark drops a constant from a grouping, and
    would deal the rows again by what is left.

    Of a key's rows a staged one goes before the target's, and among staged
    ones ``dedup_by_key``'s rule holds. Where the staged keys are few, target
    rows that they replace are dropped before the exchange. The result has the
    column ``PART`` beside the target's.
    """
    columns = _target_columns(target, staging, keys, columns, arrival)
    others = [c for c in columns if c not in keys]
    result = columns if target is None else [*keys, *others]  # as upsert's join gives them
    order = [arrival] if arrival else []
    rows = _not_null(staging.select(*columns, *order), keys)
    if target is not None:
        old = target.select(*columns)
        changed = rows.select(*keys)
        if _few_keys(changed, staged_rows):
            old = old.join(F.broadcast(changed), keys, "left_anti")
        old = old.withColumns({c: F.lit(None).cast(rows.schema[c].dataType) for c in order})
        rows = old.withColumn(STAGED, F.lit(0)).unionByName(rows.withColumn(STAGED, F.lit(1)))
        first = [STAGED]
    else:
        first = []
    share = {SLOT: _slot(keys, slots)} if part is None else {PART: part, SLOT: _slot(keys, slots)}
    dealt = rows.withColumns(share).repartition(*share)
    if others:
        row = F.struct(*first, *others)
        best = F.max(row) if arrival is None else F.max_by(row, F.struct(*first, arrival))
        merged = dealt.groupBy(*share, *keys).agg(best.alias("_row"))
        merged = merged.select(*share, *keys, *[F.col(f"_row.{c}").alias(c) for c in others])
    else:
        merged = dealt.select(*share, *keys).distinct()
    return merged.select(*result, F.lit(0).alias(PART) if part is None else PART)


def _slots(values: DataFrame, layout: Sequence[Part]) -> int:
    """Tasks that a new part's rows are dealt to: shares of the work stay many times the shuffle width, so that these are even."""
    width = int(values.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    fresh = max(1, sum(p.folder is None for p in layout))
    return min(SLOTS, -(-SHARES * width // fresh))


def _swollen(values: DataFrame, keys: Sequence[str], part: Column, slots: int) -> int:
    """Rows of the largest share (part and slot) of ``values``: two numbers a share are shuffled."""
    shares = values.groupBy(part.alias(PART), _slot(keys, slots).alias(SLOT)).agg(F.count(F.lit(1)).alias("n"))
    return shares.agg(F.max("n")).first()[0] or 0


def merge_into_snapshot(
    staging: DataFrame,
    root: str,
    keys: Sequence[str],
    columns: Sequence[str] | None = None,
    staged_rows: int | None = None,
    part_rows: int | None = None,
    arrival: str | None = None,
) -> str:
    """Upsert ``staging`` into the current version under ``root`` and publish.

    ``staging`` is read three or four times (parts, cut points, shares, merge):
    pass a written table. ``part_rows``, the rows of a part, counts when the target is
    first published; later merges keep it.
    """
    spark = staging.sparkSession
    keys = list(keys)
    base = max(snapshot_versions(spark, root), default=0)
    order, value = order_of(staging.schema, keys)
    if base:
        pointer = snapshot(spark, root, base)
        if pointer["keys"] != keys or pointer["order"] != order:
            raise ValueError(f"{root} is keyed on {pointer['keys']} by {pointer['order']}, not on {keys} by {order}")
        part_rows, parts = pointer["part_rows"], parts_of(pointer)
    else:
        part_rows, parts = part_rows or (PART_ROWS if order == "range" else HASH_PART_ROWS), []
    parts = parts or [Part(None, None, None, 0, None)]

    staged_values = _not_null(staging.select(*keys), keys).select(*keys, value.alias(VALUE))
    staged_in = staged_per_part(staged_values, parts)
    changes = plan_changes(parts, staged_in, part_rows)
    target = read_parts(spark, root, pointer, [parts[c.index] for c in changes if c.read]) if base else None
    if not changes:
        merged, done = target if base else upsert(None, staging, keys, columns, arrival=arrival), [p for p in parts if p.folder]
    else:
        values = staged_values
        if target is not None:
            values = values.unionByName(target.select(*keys, value.alias(VALUE)))
        index = range_index(F.col(VALUE), [p.lower for p in parts[1:]])
        layout = new_layout(parts, changes, inner_cuts(values.withColumn(PART, index), changes))
        part, slots = range_index(value, [p.lower for p in layout[1:]]), _slots(values, layout)
        rows, most = sum(n for n, _, _ in staged_in.values()) + sum(parts[c.index].rows for c in changes if c.read), SWOLLEN * part_rows
        if rows <= most or _swollen(values, keys, part, slots) <= most:
            part = part if len(layout) > 1 else None
            merged = _upsert_by_part(target, staging, keys, columns, part, slots, staged_rows, arrival)
        else:
            merged = upsert(target, staging, keys, columns, staged_rows=staged_rows, arrival=arrival)
        done = write_parts(merged, root, value, layout)
    return commit(spark, root, base, pointer_for(merged.drop(PART).schema, keys, order, part_rows, done))


def publish(df: DataFrame, root: str, keys: Sequence[str], base: int | None = None, part_rows: int | None = None) -> str:
    """Write all of ``df`` as the version after ``base`` (default: the current one); returns the pointer's path.

    ``df`` has one row per key; it is read up to three times.
    """
    spark = df.sparkSession
    keys = list(keys)
    if base is None:
        base = max(snapshot_versions(spark, root), default=0)
    order, value = order_of(df.schema, keys)
    part_rows = part_rows or (PART_ROWS if order == "range" else HASH_PART_ROWS)
    whole = [Part(None, None, None, 0, None)]
    values = df.select(value.alias(VALUE))
    changes = plan_changes(whole, staged_per_part(values, whole), part_rows)
    layout = new_layout(whole, changes, inner_cuts(values.withColumn(PART, F.lit(0)), changes))
    return commit(spark, root, base, pointer_for(df.schema, keys, order, part_rows, write_parts(df, root, value, layout)))
