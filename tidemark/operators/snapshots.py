"""Target snapshots cut into key ranges, published by compare-and-set.

A target's rows lie in parts, one folder each. A part owns a range of the
order value: the first merge key where that is a whole number or a date (loads
then touch few parts), else a 64-bit hash of the merge key (an MD5 identifier
has no useful order; its parts are cut finer instead). A snapshot is a pointer
file ``vNNNNNNNN.json``: the parts in order, each with the lower end of its
range, the least and greatest value it holds, its rows and its folder.

A merge counts its staged rows per part (one aggregate, a row per part) and
plans from the pointer alone:

* a part without a staged key in its range stays where it is;
* staged rows beside all values of a full part become parts of their own, and
  that part is not read either;
* any other part is read, merged and rewritten, cut anew where it has grown to
  more than ``part_rows`` twice over. Cut points come from ``approx_percentile``.

A merge deals rows by part and slot before it combines them, and its tasks write
what they hold (``merge``). Other rows are dealt to writers by ``REBALANCE`` on the
part: AQE splits a large part over as many tasks as its bytes ask for and lets
small parts share one, so the number of writers follows the bytes and a file holds
at most about ``spark.sql.adaptive.advisoryPartitionSizeInBytes`` of shuffled rows.

The pointer is created last and never overwritten, as the version after the
one the merge was based on: a half-written run is never seen, nothing that is
being read changes, and of two publishers on one base the second fails
(``PublishConflict``) and must merge again. This needs a file system whose
create-without-overwrite is exclusive (HDFS; not plain S3).
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Sequence
from dataclasses import asdict, dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.bounds import accuracy_for, range_index

FORMAT = 2
COMPRESSION = "zstd"  # of staging and target files
PART_ROWS = 1_000_000
#: Parts by hash are cut finer: a delta's keys lie all over them.
HASH_PART_ROWS = PART_ROWS // 8
PART, VALUE = "_part", "_order_value"


class PublishConflict(RuntimeError):
    """The target moved on since the version this merge was based on."""


@dataclass(frozen=True)
class Part:
    """Rows whose order value is at least ``lower`` (None: no lower end) and below the next part's."""

    lower: int | None
    least: int | None
    greatest: int | None
    rows: int
    folder: str | None


@dataclass(frozen=True)
class Change:
    """What a merge does to the part ``index``: read it or not, and write ``pieces`` new parts from ``lower`` on."""

    index: int
    read: bool
    pieces: int
    lower: int | None
    after: bool = True  # the new parts come after the old one (which is kept), else before it


def order_of(schema: T.StructType, keys: Sequence[str]) -> tuple[str, Column]:
    """("range" or "hash", the order value of a row as a bigint)."""
    kind = schema[keys[0]].dataType
    if isinstance(kind, T.IntegralType):
        return "range", F.col(keys[0]).cast("bigint")
    if isinstance(kind, T.DateType):
        return "range", F.unix_date(F.col(keys[0])).cast("bigint")
    return "hash", F.xxhash64(*keys)


def plan_changes(parts: Sequence[Part], staged: dict[int, tuple[int, int, int]], part_rows: int) -> list[Change]:
    """The changes for staged rows ``{part: (rows, least, greatest)}``; other parts stay."""
    out = []
    for index, (rows, least, greatest) in sorted(staged.items()):
        part = parts[index]
        beside = part.rows > 0 and (least > part.greatest or greatest < part.least)
        if beside and part.rows + rows > part_rows and 2 * part.rows > part_rows:
            after = least > part.greatest
            out.append(Change(index, False, _pieces(rows, part_rows), least if after else part.lower, after))
        else:
            out.append(Change(index, part.rows > 0, _pieces(part.rows + rows, part_rows), part.lower))
    return out


def _pieces(rows: int, part_rows: int) -> int:
    return -(-rows // part_rows) if rows > 2 * part_rows else 1


def new_layout(parts: Sequence[Part], changes: Sequence[Change], cuts: dict[int, list[int]]) -> list[Part]:
    """The parts after the changes, in order; new ones have no folder yet. ``cuts`` has a changed part's inner cut points."""
    by_index = {c.index: c for c in changes}
    out: list[Part] = []
    for index, part in enumerate(parts):
        change = by_index.get(index)
        if change is None:
            out.append(part)
            continue
        inner = [c for c in sorted(set(cuts.get(index, ()))) if change.lower is None or c > change.lower]
        fresh = [Part(lower, None, None, 0, None) for lower in (change.lower, *inner)]
        if change.read or not part.rows:
            out += fresh
        elif change.after:
            out += [part, *fresh]
        else:
            out += [*fresh, replace(part, lower=part.least)]
    return out


# ---- files --------------------------------------------------------------------------------------

_VERSION = re.compile(r"^v(\d{8})\.json$")


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark._jsc.hadoopConfiguration()), hpath


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, hpath = _fs(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(hpath)] if fs.exists(hpath) else []


def _pointer_path(root: str, version: int) -> str:
    return f"{root.rstrip('/')}/v{version:08d}.json"


def snapshot_versions(spark: SparkSession, root: str) -> list[int]:
    """Published versions under ``root``."""
    return sorted(int(m.group(1)) for n in _names(spark, root) if (m := _VERSION.match(n)))


def snapshot(spark: SparkSession, root: str, version: int) -> dict:
    """A version's pointer: ``keys``, ``order``, ``part_rows``, ``schema`` and ``parts`` (folders below ``root``)."""
    fs, hpath = _fs(spark, _pointer_path(root, version))
    stream = fs.open(hpath)
    try:
        found = json.loads(bytes(stream.readAllBytes()).decode())
    finally:
        stream.close()
    if found.get("format") != FORMAT:
        raise ValueError(f"{hpath} is of another format; load the target anew")
    return found


def parts_of(pointer: dict) -> list[Part]:
    return [Part(**p) for p in pointer["parts"]]


def read_parts(spark: SparkSession, root: str, pointer: dict, parts: Sequence[Part]) -> DataFrame:
    """The rows of some parts of a version."""
    schema = T.StructType.fromJson(pointer["schema"])
    paths = [f"{root.rstrip('/')}/{p.folder}" for p in parts if p.folder]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def current_snapshot(spark: SparkSession, root: str) -> str | None:
    versions = snapshot_versions(spark, root)
    return _pointer_path(root, versions[-1]) if versions else None


def read_current(spark: SparkSession, root: str) -> DataFrame | None:
    versions = snapshot_versions(spark, root)
    if not versions:
        return None
    pointer = snapshot(spark, root, versions[-1])
    return read_parts(spark, root, pointer, parts_of(pointer))


def read_range(spark: SparkSession, root: str, least: int, greatest: int) -> DataFrame | None:
    """The current rows whose first key lies in [least, greatest]; other parts are not read."""
    versions = snapshot_versions(spark, root)
    if not versions:
        return None
    pointer = snapshot(spark, root, versions[-1])
    if pointer["order"] != "range":
        raise ValueError(f"{root} is not ordered by its key")
    near = [p for p in parts_of(pointer) if p.rows and p.least <= greatest and p.greatest >= least]
    rows = read_parts(spark, root, pointer, near)
    _, value = order_of(rows.schema, pointer["keys"])
    return rows.where(value.between(least, greatest))


def commit(spark: SparkSession, root: str, base: int, pointer: dict) -> str:
    """Create the pointer of version ``base + 1``, or fail if someone else has."""
    versions = snapshot_versions(spark, root)
    path = _pointer_path(root, base + 1)
    if versions and versions[-1] != base:
        raise PublishConflict(f"{root} is at version {versions[-1]}, this merge was based on {base}")
    fs, hpath = _fs(spark, path)
    try:
        out = fs.create(hpath, False)
    except Exception as e:  # a Java exception: only an existing pointer is a conflict
        if fs.exists(hpath):
            raise PublishConflict(f"{path} was published meanwhile") from e
        raise
    out.write(bytearray(json.dumps(pointer).encode()))
    out.close()
    return path


def pointer_for(schema: T.StructType, keys: Sequence[str], order: str, part_rows: int, parts: Sequence[Part]) -> dict:
    plain = T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields])
    return {"format": FORMAT, "keys": list(keys), "order": order, "part_rows": part_rows, "schema": plain.jsonValue(), "parts": [asdict(p) for p in parts]}


def staged_per_part(values: DataFrame, parts: Sequence[Part]) -> dict[int, tuple[int, int, int]]:
    """{part: (rows, least, greatest)} of the column ``VALUE``: a row per part at most."""
    index = range_index(F.col(VALUE), [p.lower for p in parts[1:]])
    found = values.groupBy(index.alias(PART)).agg(F.count(F.lit(1)).alias("n"), F.min(VALUE).alias("lo"), F.max(VALUE).alias("hi"))
    return {r[PART]: (r["n"], r["lo"], r["hi"]) for r in found.collect()}


def inner_cuts(values: DataFrame, changes: Sequence[Change]) -> dict[int, list[int]]:
    """Cut points of the changed parts that become several, from ``values``: the old part (``PART``) and order value of its rows to be."""
    several = {c.index: c.pieces for c in changes if c.pieces > 1}
    if not several:
        return {}
    most = max(several.values())
    grid = most if set(several.values()) == {most} else 4 * most
    at = F.percentile_approx(VALUE, [k / grid for k in range(1, grid)], accuracy_for(grid))
    found = values.groupBy(PART).agg(at.alias("cuts"))
    out = {}
    for r in found.collect():
        pieces = several.get(r[PART], 1)
        ends = [r["cuts"][round(j * grid / pieces) - 1] for j in range(1, pieces)]
        out[r[PART]] = [min(end + 1, 2**63 - 1) for end in ends]  # a percentile ends its piece
    return out


def write_parts(df: DataFrame, root: str, order: Column, layout: Sequence[Part]) -> list[Part]:
    """Write ``df``'s rows into the layout's new parts; the whole layout, complete. With the column ``PART``, rows are dealt already."""
    spark = df.sparkSession
    data = f"data/{uuid.uuid4().hex}"
    path = f"{root.rstrip('/')}/{data}"
    index = range_index(order, [p.lower for p in layout[1:]])
    dealt = df if PART in df.columns else df.withColumn(PART, index).hint("rebalance", F.col(PART))
    dealt.write.partitionBy(PART).option("compression", COMPRESSION).parquet(path)
    schema = T.StructType([*df.drop(PART).schema.fields, T.StructField(PART, T.IntegerType())])
    back = spark.read.schema(schema).parquet(path)
    found = {r[PART]: r for r in back.groupBy(PART).agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("lo"), F.max(order).alias("hi")).collect()}
    out = []
    for k, part in enumerate(layout):
        if k in found:
            if part.folder:
                raise RuntimeError(f"rows were dealt to part {k}, which the merge did not read")
            r = found[k]
            out.append(replace(part, least=r["lo"], greatest=r["hi"], rows=r["n"], folder=f"{data}/{PART}={k}"))
        elif part.folder:
            out.append(part)
    if out:
        out[0] = replace(out[0], lower=None)
    return out


def prune_snapshots(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Forget versions older than the newest ``keep`` and delete the part
    folders only they refer to; returns the deleted pointers.

    Folders of failed or running publishers, which no pointer names, are left.
    Keep at least two, so readers still on the previous version finish.
    """
    if keep < 1:
        raise ValueError("keep at least one snapshot")
    versions = snapshot_versions(spark, root)
    old, kept = versions[:-keep], versions[-keep:]
    folders = lambda vs: {p.folder for v in vs for p in parts_of(snapshot(spark, root, v)) if p.folder}
    gone = folders(old) - folders(kept)
    deleted = []
    for v in old:
        fs, hpath = _fs(spark, _pointer_path(root, v))
        fs.delete(hpath, False)
        deleted.append(_pointer_path(root, v))
    for p in sorted(gone):
        fs, hpath = _fs(spark, f"{root.rstrip('/')}/{p}")
        fs.delete(hpath, True)
    return deleted
