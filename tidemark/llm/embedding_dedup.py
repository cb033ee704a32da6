"""Embedding near-dedup by PCA-ordered tiled comparison.

Vectors are scaled to length one and turned onto the principal axes of all of
them (eigenvectors of the second moments, added up over the whole table), the
axis of most variance first. A rotation keeps products, so a pair's cosine is
the sum over axes, and after the first k axes the rest of it is at most the
product of both vectors' suffix norms. Pairs are compared in tiles: the leading
axes are added up first, a pair stops as soon as its sum plus that bound is
below the threshold, and only the pairs that reach the end are linked.

Tiles: a link means a distance of at most sqrt(2 - 2t) in every direction, so
on each of the first three axes linked vectors lie in the same or in adjoining
cells of that width. A cell is cut into blocks of at most about ``BLOCK``
vectors by hash; a tile is a pair of blocks of adjoining cells. Every block has
a box: its least and greatest value on ``BOX_AXES`` leading axes and its
largest suffix norm. Tiles whose boxes bound the cosine below the threshold are
dropped before any vector moves. A tile gets the vectors as they came, in their
own precision, and turns them itself. The product is symmetric: each pair of
blocks is compared once, some rows at a time; where more than a tenth of the
pairs are still open their sums go on as a matrix product, else pair by pair in
portions, so a dense cluster needs no more memory than a sparse one. A tile
returns a count of links per vector and a spanning set of its links, never its
pairs. Equal vectors are one vector with a multiplicity before anything is
compared.

The last word on a pair has the cosine of the vectors themselves in double
precision: pairs within 1e-9 of the threshold are computed again without the
rotation.

Defined cases: vectors that are null, empty, zero or hold null or non-finite
components link with nothing. Vectors of different lengths link with nothing.
Repeated rows (equal ids) are vectors of their own; a null id takes part, and
a component with no other id is named null.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import col, components, ship_package, written

THRESHOLD = 0.9
BLOCK = 2048
CELL_AXES = 3
BOX_AXES = 8
STEPS = (8, 16, 32)  # leading axes after which pairs may stop
ROWS = 256  # of a tile compared at a time
PAIRS = 16_384  # open pairs whose sums go on at a time
CLOSE = 1e-9  # from the threshold: computed again without the rotation


def _rows(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), dim)


def _unit(x: np.ndarray) -> np.ndarray:
    # by the largest component first: squares of very large or small ones stay finite
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def principal_axes(vectors: DataFrame) -> dict[int, np.ndarray]:
    """Per vector length: the axes as columns, most variance first, from all of ``vectors(vec, dim)``."""

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            dims = batch.column(1).to_numpy()
            for dim in np.unique(dims):
                own = _unit(_rows(batch.column(0).filter(pa.array(dims == dim)), int(dim)))
                total[int(dim)] = total.get(int(dim), 0) + own.T @ own
        for dim, m in total.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(dim * dim, dim, np.int32)), pa.array(np.arange(dim * dim, dtype=np.int32)), pa.array(m.ravel())], names=["dim", "at", "value"])

    sums = vectors.select("vec", "dim").mapInArrow(moments, "dim int, at int, value double").groupBy("dim", "at").agg(F.sum("value").alias("value"))
    got = sums.toArrow()  # dim * dim numbers for each length of vector that occurs
    out = {}
    dims, at, value = (got[x].to_numpy() for x in ("dim", "at", "value"))
    for dim in np.unique(dims):
        m = np.zeros(dim * dim)
        m[at[dims == dim]] = value[dims == dim]
        _, axes = np.linalg.eigh(m.reshape(dim, dim))
        out[int(dim)] = np.ascontiguousarray(axes[:, ::-1])
    return out


def _linked(a: np.ndarray, b: np.ndarray, ra: np.ndarray, rb: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of linked rows of two blocks; ``ra``, ``rb``: the unit rows on the principal axes."""
    dim = ra.shape[1]
    cuts = [*(c for c in STEPS if c < dim), dim]
    rest = {k: tuple(np.sqrt(np.maximum((r[:, k:] ** 2).sum(axis=1), 0)) for r in (ra, rb)) for k in cuts}
    out_i, out_j = [np.zeros(0, np.int32)], [np.zeros(0, np.int32)]
    for start in range(0, len(ra), ROWS):
        own = ra[start : start + ROWS]
        sums = np.zeros((len(own), len(rb)))
        alive = np.ones(sums.shape, bool)
        for lo, hi in zip([0, *cuts], cuts):
            bound = lambda i, j: rest[hi][0][start + i] * rest[hi][1][j]  # noqa: B023, E731
            if alive.mean() > 0.1:
                sums += own[:, lo:hi] @ rb[:, lo:hi].T
                alive &= sums + np.outer(rest[hi][0][start : start + ROWS], rest[hi][1]) >= threshold - CLOSE
                continue
            i, j = np.nonzero(alive)
            for at in range(0, len(i), PAIRS):
                x, y = i[at : at + PAIRS], j[at : at + PAIRS]
                part = sums[x, y] + np.einsum("ij,ij->i", own[x, lo:hi], rb[y, lo:hi])
                sums[x, y] = part
                alive[x, y] = part + bound(x, y) >= threshold - CLOSE
        i, j = np.nonzero(alive)
        part = sums[i, j]
        close = np.flatnonzero(np.abs(part - threshold) <= CLOSE)
        for at in range(0, len(close), PAIRS):
            k = close[at : at + PAIRS]
            x, y = a[start + i[k]], b[j[k]]
            part[k] = (x * y).sum(axis=1) / (np.sqrt((x * x).sum(axis=1)) * np.sqrt((y * y).sum(axis=1)))
        ok = part >= threshold
        out_i.append((start + i[ok]).astype(np.int32))
        out_j.append(j[ok].astype(np.int32))
    return np.concatenate(out_i), np.concatenate(out_j)


def _spanning(i: np.ndarray, j: np.ndarray, n: int) -> np.ndarray:
    """Smallest reachable node per node, by repeated minimum over links."""
    label = np.arange(n)
    while True:
        new = label.copy()
        np.minimum.at(new, i, label[j])
        np.minimum.at(new, j, label[i])
        new = new[new]
        if (new == label).all():
            return label
        label = new


def classes(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", threshold: float = THRESHOLD) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` per row."""
    spark = vectors.sparkSession
    ship_package(spark)
    single = vectors.select(col(embedding)).schema[0].dataType == T.ArrayType(T.FloatType())
    vec_type = "array<float>" if single else "array<double>"  # floats are doubles already: half the bytes to move
    raw = col(embedding).cast(vec_type)
    fine = F.coalesce(
        (F.size(raw) > 0) & ~F.exists(raw, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf"))) & F.exists(raw, lambda x: x != 0), F.lit(False)
    )
    rows = vectors.select(col(vec_id).alias("vec_id"), F.when(fine, raw).alias("vec"))
    # -0.0 and 0.0 are one number: equal vectors get equal keys
    key = F.md5(F.array_join(F.transform("vec", lambda x: (x.cast("double") + F.lit(0.0)).cast("string")), ",").cast("binary"))
    rows = rows.withColumn("key", F.unhex(key))
    each = rows.filter("key is not null").groupBy("key").agg(F.first("vec").alias("vec"), F.count(F.lit(1)).alias("copies"))
    each = written(each.withColumn("dim", F.size("vec")), "vectors")
    axes = spark.sparkContext.broadcast(principal_axes(each))
    width = math.sqrt(max(2 - 2 * threshold, 0)) + 1e-6

    def turn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column(2).to_numpy()
            for dim in np.unique(dims):
                own = batch.filter(pa.array(dims == dim))
                turned = _unit(_rows(own.column(1), int(dim))) @ axes.value[int(dim)]
                lead = np.zeros((own.num_rows, BOX_AXES))
                n = min(BOX_AXES, int(dim))
                lead[:, :n] = turned[:, :n]
                rest = np.sqrt((turned[:, n:] ** 2).sum(axis=1))
                cells = np.floor(lead[:, :CELL_AXES] / width).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [*own.columns, *(pa.array(cells[:, k]) for k in range(CELL_AXES)), *(pa.array(lead[:, k]) for k in range(BOX_AXES)), pa.array(rest)],
                    names=["key", "vec", "dim", "copies", "c0", "c1", "c2", *(f"l{k}" for k in range(BOX_AXES)), "rest"],
                )

    lead = ", ".join(f"l{k} double" for k in range(BOX_AXES))
    out = f"key binary, vec {vec_type}, dim int, copies long, c0 int, c1 int, c2 int, {lead}, rest double"
    turned = written(each.select("key", "vec", "dim", "copies").mapInArrow(turn, out), "turned")
    cell = ["dim", "c0", "c1", "c2"]
    blocks = turned.groupBy(*cell).agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    block = F.pmod(F.hash("key"), F.col("blocks"))
    members = turned.join(blocks, cell).withColumn("name", F.concat_ws(".", *cell, block))
    sides = [f(f"l{k}").alias(f"{f.__name__}{k}") for k in range(BOX_AXES) for f in (F.min, F.max)]
    # a row per block: what follows up to the tiles moves no vector
    boxes = written(members.groupBy("name", *cell).agg(*sides, F.max("rest").alias("rest")), "boxes")
    near = F.explode(F.array(*[F.struct(*(F.lit(d).alias(f"d{k}") for k, d in enumerate(x))) for x in np.ndindex(3, 3, 3)]))
    inner = [x for x in boxes.columns if x not in cell]
    around = boxes.withColumn("s", near).select("dim", *inner, *[(F.col(f"c{k}") + F.col(f"s.d{k}") - 1).alias(f"c{k}") for k in range(CELL_AXES)])
    others = boxes.select(*cell, *[F.col(x).alias(f"o_{x}") for x in inner])
    tiles = around.join(others, cell).filter(F.col("name") <= F.col("o_name"))
    corners = [F.greatest(*[F.col(f"{p}{k}") * F.col(f"o_{q}{k}") for p in ("min", "max") for q in ("min", "max")]) for k in range(BOX_AXES)]
    most = reduce(lambda x, y: x + y, corners) + F.col("rest") * F.col("o_rest")
    tiles = written(tiles.filter(most >= threshold - CLOSE).select("name", F.col("o_name").alias("other")).distinct(), "tile-pairs")
    members = members.select("name", "key", "vec", "dim", "copies")
    left = members.join(tiles, "name").select("name", "other", F.lit(0).alias("side"), "key", "vec", "dim", "copies")
    right = members.withColumnRenamed("name", "other").join(tiles.filter("name != other"), "other").select("name", "other", F.lit(1).alias("side"), "key", "vec", "dim", "copies")

    # one row per tile and side part: a tile is gathered whole, and is at most two blocks
    def compare(tile: pa.Table) -> pa.Table:
        side = tile["side"].to_numpy()
        dim = int(tile["dim"][0].as_py())
        vec = _rows(tile["vec"].combine_chunks(), dim)
        own = _unit(vec) @ axes.value[dim]
        copies = tile["copies"].to_numpy()
        a = np.flatnonzero(side == 0)
        b = np.flatnonzero(side == 1)
        within = not len(b)
        b = a if within else b
        i, j = _linked(vec[a], vec[b], own[a], own[b], threshold)
        if within:
            other = i != j
            i, j = i[other], j[other]
        i, j = a[i], b[j]
        links = np.bincount(i, copies[j], len(side))
        if not within:
            links += np.bincount(j, copies[i], len(side))
        label = _spanning(i, j, len(side))
        at = np.flatnonzero(links > 0)
        keys = tile["key"].combine_chunks()
        return pa.table({"key": keys.take(pa.array(at)), "links": pa.array(links[at].astype(np.int64)), "to": keys.take(pa.array(label[at]))})

    found = left.unionByName(right).groupBy("name", "other").applyInArrow(compare, "key binary, links long, to binary")
    found = written(found, "links")
    comp = components(found.filter("key != to").select(F.col("key").alias("a"), F.col("to").alias("b")))
    links = found.groupBy("key").agg(F.sum("links").alias("links"))
    named_rows = rows.filter("key is not null").groupBy("key").agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("copies"))
    placed = named_rows.join(comp.withColumnRenamed("id", "key"), "key", "left").withColumn("component", F.coalesce("component", "key"))
    smallest = placed.groupBy("component").agg(F.min("least").alias("component_id"))
    placed = placed.join(smallest, "component").join(links, "key", "left").select("key", "component_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    done = rows.select("vec_id", "key").join(placed, "key", "left")
    done = done.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.when(F.col("key").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id")
    )
    return done.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
