"""Helpers the operators share: column packing, written cuts, and components."""

from __future__ import annotations

import io
import uuid
import zipfile
from pathlib import Path

import numpy as np
import zstandard
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import ensure_checkpoint_dir


def col(name: str) -> Column:
    """A top-level column whose name may hold dots."""
    return F.col("`" + name.replace("`", "``") + "`")


def packed(df: DataFrame) -> Column:
    """All columns of a row as one struct, so working names cannot clash with them."""
    return F.struct(*[col(c) for c in df.columns])


def unpacked(df: DataFrame, struct: str, columns: list[str]) -> list[Column]:
    """The packed columns again, by their own names."""
    return [F.col(struct).getField(c).alias(c) for c in columns]


def bound(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row.

    A column used inside a higher-order function's lambda is otherwise
    computed again for every element.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint folder of the session."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/tidemark-llm/{name}-{uuid.uuid4().hex}"


def planes_packed(*arrays: np.ndarray) -> bytes:
    """Arrays of one length, byte plane by byte plane, compressed: high bytes of small numbers cost nothing."""
    planes = b"".join(np.ascontiguousarray(a).view(np.uint8).reshape(len(a), -1).T.tobytes() for a in arrays)
    return zstandard.ZstdCompressor(level=1).compress(planes)


def planes_unpacked(blob: bytes, *kinds: type) -> list[np.ndarray]:
    sizes = [np.dtype(k).itemsize for k in kinds]
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    n, at, out = len(raw) // sum(sizes), 0, []
    for kind, size in zip(kinds, sizes):
        out.append(np.ascontiguousarray(raw[at : at + n * size].reshape(size, n).T).view(kind).ravel())
        at += n * size
    return out


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package: a zip of its sources, laid in
    the shared folder and added to the session (once an application), as
    ``spark-submit --py-files`` would."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    top = Path(__file__).resolve().parents[1]
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        for f in sorted(top.rglob("*.py")):
            z.writestr(zipfile.ZipInfo(str(f.relative_to(top.parent))), f.read_bytes())
    uri = shared_path(spark, "package") + "/tidemark-package.zip"
    store, path = fs.FileSystem.from_uri(uri)
    store.create_dir(path.rpartition("/")[0])
    with store.open_output_stream(path) as out:
        out.write(buffer.getvalue())
    spark.sparkContext.addPyFile(uri)
    _shipped.add(app)


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write ``df`` to the shared folder and read it back."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """Connected components of an undirected edge list: ``(id, component)``.

    ``component`` is the smallest id reachable. Nodes without an edge do not
    appear. Each round sends every node the smallest label among itself and
    its neighbours, then jumps to that label's own label, so a chain of length
    n settles in about log n rounds. Both steps are joins and a ``min`` with
    map-side partial aggregation: a hub's edges are combined before the
    shuffle. Every round is written to the shared folder.
    """
    both = edges.select(F.col(a).alias("id"), F.col(b).alias("other"))
    both = both.unionByName(both.select(F.col("other").alias("id"), F.col("id").alias("other"))).distinct()
    both = written(both, "edges")
    labels = written(both.groupBy("id").agg(F.least(F.min("other"), F.col("id")).alias("label")), "labels")
    for _ in range(max_rounds):
        near = both.join(labels.select(F.col("id").alias("other"), "label"), "other").groupBy("id").agg(F.min("label").alias("near"))
        hooked = labels.join(near, "id").select("id", "label", F.least("label", "near").alias("next"))
        jump = labels.select(F.col("id").alias("next"), F.col("label").alias("far"))
        moved = hooked.join(jump, "next", "left").select("id", F.col("label").alias("old"), F.least("next", F.coalesce("far", "next")).alias("label"))
        moved = written(moved, "labels")
        labels = moved.select("id", "label")
        if moved.filter(F.col("old") != F.col("label")).isEmpty():
            return labels.select("id", F.col("label").alias("component"))
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
