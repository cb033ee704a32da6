"""MinHash near-dedup by improved consistent weighted sampling (ICWS).

A text is a weighted set of five-word shingles: weight = count in the text
times a damped inverse document frequency, 1 + ln(N / df) / ln(N + 1), of its own
exact df over all documents. Blocks of texts send their distinct shingles and
counts, by hash bucket, to be added up. Where the shingles in two texts or more
are at most ``FREQUENT``, they are broadcast, and all others have df = 1. Where
they are more, nothing is broadcast: each bucket sends every block the
frequencies of the block's shingles, and the block's texts meet them there; a
text carries its frequencies on to the comparisons. Both ways weigh alike.

ICWS draws 64 samples (shingle, level) of which two texts share each with
probability equal to their weighted Jaccard similarity; 16 bands of 4 make candidates (0.9998 found at similarity 0.8).

Candidates are verified by exact weighted Jaccard >= 0.8 of whole texts:
first every member of a band bucket against the bucket's smallest member (a
star, linear in the bucket), then connected components, then the members that
are still outside their bucket's first component against all its members, in
tiles that return only joining links. So no link between different components
of a bucket is lost, and no pairs of a bucket are emitted.

Defined cases: equal texts are one class whatever their length; null texts are
each a class of their own; texts of fewer than five words have no shingle and
are classed with equal texts only. A class is named by its smallest doc_id
(null where every id is null); the kept row is the one with the smallest
(doc_id, text) and, of rows equal in both, one. Empty tables give empty results.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import tokens
from .common import col, components, packed, planes_packed, planes_unpacked, ship_package, unpacked, written

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 16, 4
TILE = 256
FREQUENT = 2_000_000
LIKELY = 5.0  # expected draws below the first bound of a text's smallest draw
BLOCK = 8 << 20  # bytes of text whose shingles are counted together
BUCKET = 12 << 20  # bytes of text for each bucket of shingles
_BITS = np.uint64(48)
_SLOTS = 1 << 16


def _sets(piece: tokens.Piece) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of a piece's texts, by text and hash: (text, 48-bit hash, count)."""
    h, at = tokens.ngrams(piece, SHINGLE)
    key = np.sort((h >> np.uint64(16)) | (piece.doc[at].astype(np.uint64) << np.uint64(48)))
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    count = np.diff(np.append(first, len(key)))
    key = key[first]
    return (key >> np.uint64(48)).astype(np.int64), key & np.uint64((1 << 48) - 1), count


def _damped(df: np.ndarray | int, n_docs: int) -> np.ndarray:
    n = max(n_docs, 1)
    return (1 + np.log(n / np.clip(df, 1, n)) / math.log(n + 1.0)).astype(np.float32)


class Weights:
    """Inverse document frequencies: of the frequent shingles each its own, of all others one; exact where ``least`` is 2."""

    def __init__(self, h: np.ndarray, df: np.ndarray, least: int, n_docs: int):
        self.h, self.idf, self.rest = h, _damped(df, n_docs), _damped(least // 2, n_docs)
        self.least, self.n_docs = least, n_docs

    def of(self, h: np.ndarray) -> np.ndarray:
        out = np.full(len(h), self.rest, np.float32)
        if len(self.h):
            at = np.minimum(np.searchsorted(self.h, h), len(self.h) - 1)
            known = self.h[at] == h
            out[known] = self.idf[at[known]]
        return out

    def own(self, df: np.ndarray) -> np.ndarray:
        """The weights of shingles whose frequencies are at hand."""
        return _damped(df, self.n_docs)

    def bare(self) -> Weights:
        """Without the table, for texts that carry their frequencies."""
        return Weights(self.h[:0], self.idf[:0], 2, self.n_docs)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[pa.RecordBatch]]]:
    """A task's rows ``(key, text)`` in numbered blocks of about ``BLOCK`` bytes; the same rows in the same order give the same blocks."""
    block, held, size = TaskContext.get().partitionId() << 32, [], 0
    for batch in batches:
        _, offsets = tokens.text_buffers(batch.column(1))
        ends, lo = offsets - offsets[0] + 32 * np.arange(len(offsets)), 0
        while lo < batch.num_rows:
            hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] + BLOCK - size, "right")) - 1)
            held.append(batch.slice(lo, hi - lo))
            size += int(ends[hi] - ends[lo])
            lo = hi
            if size >= BLOCK:
                yield block, held
                block, held, size = block + 1, [], 0
    if held:
        yield block, held


def _shingle_counts(bits: int):
    """A row per block of texts and bucket: the distinct shingles and how many of the block's texts hold each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, held in _blocks(batches):
            h, n = np.unique(np.concatenate([_sets(piece)[1] for part in held for piece in tokens.pieces(part.column(1))]), return_counts=True)
            bucket = (h >> (_BITS - np.uint64(bits))).astype(np.int32)
            cuts = np.append(np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])), len(h)) if len(h) else np.zeros(1, np.int64)
            blobs = [planes_packed(np.diff(h[a:b], prepend=np.uint64(0)), n[a:b].astype(np.uint32)) for a, b in zip(cuts[:-1], cuts[1:])]
            columns = [pa.array([block] * len(blobs), pa.int64()), pa.array(bucket[cuts[:-1]]), pa.array(blobs, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["block", "bucket", "blob"])

    return run


def _added(group: pa.Table) -> pa.Table:
    """All blocks' counts of one bucket: its shingles in two texts or more, by the power of two that their
    frequency reaches, and for every block the frequencies of its shingles."""
    parts = [planes_unpacked(x, np.uint64, np.uint32) for x in group["blob"].to_pylist()]
    ends = np.cumsum([len(d) for d, _ in parts])
    h, at = np.unique(np.concatenate([np.cumsum(d, dtype=np.uint64) for d, _ in parts]), return_inverse=True)
    df = np.bincount(at, np.concatenate([n for _, n in parts])).astype(np.int64)
    power = np.frexp(df)[1] - 1
    out = [(int(p), int((power == p).sum()), None, None, planes_packed(h[power == p], df[power == p])) for p in np.unique(power) if p > 0]
    for block, bucket, own in zip(group["block"].to_pylist(), group["bucket"].to_pylist(), np.split(at, ends[:-1])):
        out.append((None, None, block, bucket, planes_packed(df[own].astype(np.uint32))))
    names, kinds = ("power", "n", "block", "bucket", "blob"), (pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.binary())
    return pa.table({name: pa.array(values, kind) for name, kind, values in zip(names, kinds, zip(*out))})


def _counted(texts: DataFrame, n_docs: int, frequent: int | None = None) -> tuple[Weights, DataFrame]:
    """The weights, exact where their table holds all shingles in two texts or more, and every block's
    frequencies ``(block, bucket, blob)``, for ``texts(key, text)``."""
    size = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    bits = max(1, math.ceil(math.log2(max(1, size / BUCKET))))  # buckets of bounded size: their number follows the input
    counts = texts.mapInArrow(_shingle_counts(bits), "block long, bucket int, blob binary")
    added = counts.groupBy("bucket").applyInArrow(_added, "power int, n long, block long, bucket int, blob binary")
    found = written(added, "shingle-frequencies")
    per = {r["power"]: r["n"] for r in found.filter("power > 0").groupBy("power").agg(F.sum("n").alias("n")).collect()}  # at most 63 rows
    power, left = max(per, default=0) + 1, FREQUENT if frequent is None else frequent
    while power > 1 and per.get(power - 1, 0) <= left:
        power -= 1
        left -= per.get(power, 0)
    own = [planes_unpacked(r["blob"], np.uint64, np.int64) for r in found.filter(F.col("power") >= power).select("blob").toLocalIterator()]  # FREQUENT entries at most
    h, df = (np.concatenate([np.zeros(0, k), *x]) for k, x in zip((np.uint64, np.int64), zip(*own) if own else ((), ())))
    order = np.argsort(h)
    return Weights(h[order], df[order], 1 << power, n_docs), found.filter("block is not null").select("block", "bucket", "blob")


def document_frequencies(docs: DataFrame, text: str = "text", frequent: int | None = None) -> Weights:
    """The weights of the shingles in most documents, each its own (at most ``frequent``); ``near_classes`` weighs
    the others by their own frequencies too."""
    return _counted(docs.select(F.lit(None).cast("binary").alias("key"), col(text).alias("text")), docs.count(), frequent)[0]


class Sampler:
    """ICWS with 64 samples; the draws of a shingle come from seeded tables by its hash.

    A sample is the shingle of a text's smallest draw. That is below
    ``LIKELY`` / the text's weight but once in e ** ``LIKELY`` samples, and a
    shingle's draw is above a bound that one table holds, so most shingles are
    ruled out by one comparison; where no draw is that small, all are computed.
    """

    def __init__(self, samples: int = BANDS * ROWS, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.r = rng.gamma(2.0, 1.0, _SLOTS).astype(np.float32)
        self.inv_r = (1 / self.r).astype(np.float32)
        self.log_c = np.log(rng.gamma(2.0, 1.0, _SLOTS)).astype(np.float32) + np.float32(64)
        self.beta = rng.uniform(0, 1, _SLOTS).astype(np.float32)
        self.odd = rng.integers(1, 2**63, samples, dtype=np.uint64) | np.uint64(1)
        self.least = self.log_c - self.r - np.float32(1e-3)  # no draw is below this less its shingle's log weight; the last term: rounding

    def sample(self, h: np.ndarray, weight: np.ndarray, first: np.ndarray) -> np.ndarray:
        """(texts, samples) codes; ``first`` has each text's first shingle (none empty)."""
        log_w = np.log(weight).astype(np.float32)
        out = np.empty((len(first), len(self.odd)), np.uint64)
        edges = np.append(first, len(h))
        likely = np.float32(64) + np.log(LIKELY / np.add.reduceat(weight, first)).astype(np.float32)
        bound, enough = log_w + np.repeat(likely, np.diff(edges)), _ordered(likely) << np.uint64(32)
        place, least, small = np.empty(len(h), np.uint64), np.empty(len(h), np.float32), np.empty(len(h), bool)
        slot = place.view(np.int64)
        for k, odd in enumerate(self.odd):
            np.right_shift(np.multiply(h, odd, out=place), np.uint64(48), out=place)
            np.less_equal(np.take(self.least, slot, out=least, mode="clip"), bound, out=small)
            at = np.flatnonzero(small)
            cuts = np.searchsorted(at, edges)
            some = np.flatnonzero(cuts[1:] > cuts[:-1])
            best = np.full(len(first), np.uint64(2**64 - 1))
            if len(some):
                best[some] = np.minimum.reduceat(self._draws(slot, log_w, at), cuts[some])
            for text in np.flatnonzero(best >= enough):
                best[text] = self._draws(slot, log_w, np.arange(edges[text], edges[text + 1])).min()
            won = (best & np.uint64(0xFFFFFFFF)).astype(np.int64)
            level = np.floor(log_w[won] * self.inv_r[slot[won]] + self.beta[slot[won]]).astype(np.int64).astype(np.uint64)
            out[:, k] = tokens.mix(h[won] * np.uint64(0x9E3779B97F4A7C15) + level)
        return out

    def _draws(self, slot: np.ndarray, log_w: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The draws of the shingles ``at``, each with its place, as one number."""
        slot = slot[at]
        r, beta = self.r[slot], self.beta[slot]
        a = self.log_c[slot] - r * (np.floor(log_w[at] * self.inv_r[slot] + beta) - beta + np.float32(1))
        return (_ordered(a) << np.uint64(32)) | at.astype(np.uint64)


def _ordered(a: np.ndarray) -> np.ndarray:
    """The bits of numbers above zero: they sort as the numbers do."""
    return np.maximum(a, np.float32(0)).view(np.uint32).astype(np.uint64)


def _band_keys(codes: np.ndarray) -> np.ndarray:
    out = np.empty((len(codes), BANDS), np.uint64)
    for b in range(BANDS):
        key = np.full(len(codes), b + 1, np.uint64)
        for k in range(ROWS):
            key = tokens.mix(key * np.uint64(0xC2B2AE3D27D4EB4F) + codes[:, b * ROWS + k])
        out[:, b] = key
    return out.view(np.int64)


def band_keys(spark: SparkSession, texts: DataFrame, idf: Weights) -> DataFrame:
    """``(key, bucket)`` for ``texts(key, text)``: 16 bucket keys a text, the band mixed in."""
    shared = spark.sparkContext.broadcast(idf)  # at most FREQUENT shingles

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler, table = Sampler(), shared.value
        for batch in batches:
            for piece in tokens.pieces(batch.column(1)):
                doc, h, count = _sets(piece)
                if not len(doc):
                    continue
                first = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
                weight = count * table.of(h)
                keys = _band_keys(sampler.sample(h, weight, first))
                own = batch.column(0).take(pa.array(np.repeat(piece.lo + doc[first], BANDS)))
                yield pa.RecordBatch.from_arrays([own, pa.array(keys.ravel())], names=["key", "bucket"])

    return texts.mapInArrow(run, "key binary, bucket long")


def _text_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per block: its keys and texts, compressed."""
    for block, held in _blocks(batches):
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, held[0].schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
            for part in held:
                out.write_batch(part)
        yield pa.RecordBatch.from_arrays([pa.array([block]), pa.array([sink.getvalue().to_pybytes()], pa.binary())], names=["block", "blob"])


def weighted_bands(texts: DataFrame, frequencies: DataFrame, idf: Weights) -> DataFrame:
    """``(key, buckets, df)`` for ``texts(key, text)``: like ``band_keys``, every shingle weighed by its own
    frequency, as counted over the same blocks; ``df``: the frequencies in the order of the text's shingles."""
    names = ["key", "buckets", "df"]

    def run(block: pa.Table, counted: pa.Table) -> pa.Table:
        parts = [pa.ipc.open_stream(b) for b in block["blob"].to_pylist()]
        pieces = [(batch, piece, _sets(piece)) for part in parts for batch in part for piece in tokens.pieces(batch.column(1))]
        known, at = np.unique(np.concatenate([np.zeros(0, np.uint64), *[h for _, _, (_, h, _) in pieces]]), return_inverse=True)
        blobs = counted.sort_by("bucket")["blob"].to_pylist()  # buckets are ranges of the hash
        df = np.concatenate([np.zeros(0, np.uint32), *[planes_unpacked(b, np.uint32)[0] for b in blobs]])
        if len(df) != len(known):
            raise RuntimeError("the texts came in another order than when their shingles were counted")
        sampler, out, ends = Sampler(), [], np.cumsum([len(h) for _, _, (_, h, _) in pieces])
        for (batch, piece, (doc, h, count)), own in zip(pieces, np.split(df[at], ends[:-1])):
            if not len(doc):
                continue
            first = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
            keys = _band_keys(sampler.sample(h, count * idf.own(own), first))
            buckets = pa.ListArray.from_arrays(pa.array(np.arange(len(keys) + 1) * BANDS, pa.int32()), pa.array(keys.ravel()))
            packs = pa.array([planes_packed(x) for x in np.split(own, first[1:])], pa.binary())
            out.append(pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(piece.lo + doc[first])).cast(pa.binary()), buckets, packs], names=names))
        return pa.Table.from_batches(out, pa.schema(list(zip(names, (pa.binary(), pa.list_(pa.int64()), pa.binary())))))

    blocks = texts.mapInArrow(_text_blocks, "block long, blob binary")
    return blocks.groupBy("block").cogroup(frequencies.groupBy("block")).applyInArrow(run, "key binary, buckets array<long>, df binary")


def _vectors(text: pa.Array, df: pa.Array, table: Weights) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Every text's shingles and weights, in order, worked out for a piece of texts at a time."""
    for piece in tokens.pieces(text):
        doc, h, count = _sets(piece)
        own = df.slice(piece.lo, piece.hi - piece.lo)
        weight = table.of(h) if own.null_count else table.own(np.concatenate([planes_unpacked(x, np.uint32)[0] for x in own.to_pylist()]))
        weight = count * weight.astype(np.float64)
        cuts = np.searchsorted(doc, np.arange(piece.hi - piece.lo + 1))
        for lo, hi in zip(cuts[:-1], cuts[1:]):
            yield h[lo:hi], weight[lo:hi]


def _weighted(text: pa.Array, table: Weights) -> tuple[np.ndarray, np.ndarray]:
    return next(_vectors(text, pa.nulls(1, pa.binary()), table))


def weighted_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    (ha, wa), (hb, wb) = a, b
    if not len(ha) or not len(hb):
        return 0.0
    at = np.minimum(np.searchsorted(hb, ha), len(hb) - 1)
    same = hb[at] == ha
    low = np.minimum(wa[same], wb[at[same]]).sum()
    return float(low / (wa.sum() + wb.sum() - low))


def similarities(spark: SparkSession, pairs: DataFrame, texts: DataFrame, idf: Weights) -> DataFrame:
    """``(centre, key, similarity)`` for ``pairs(centre, key)`` and ``texts(key, text, df)``.

    A centre's text meets its partners' texts in sorted partitions and is
    streamed past them; a centre with many partners is split into groups of
    about 256, each of which gets the centre's text once.
    """
    shared = spark.sparkContext.broadcast(idf)
    groups = pairs.groupBy("centre").agg(F.ceil(F.count(F.lit(1)) / 256).cast("int").alias("groups"))
    members = (
        pairs.join(groups, "centre")
        .withColumn("part", F.pmod(F.hash("key"), F.col("groups")))
        .join(texts, "key")
        .select("centre", "part", F.lit(1).alias("kind"), "key", "text", "df")
    )
    centres = (
        groups.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)))
        .join(texts.withColumnRenamed("key", "centre"), "centre")
        .select("centre", "part", F.lit(0).alias("kind"), F.col("centre").alias("key"), "text", "df")
    )
    dealt = centres.unionByName(members)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = dealt.repartition(parts, "centre", "part").sortWithinPartitions("centre", "part", "kind")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, centre, own = shared.value, None, None
        for batch in batches:
            out: list[tuple[bytes, bytes, float]] = []
            names = [batch.column(k).to_pylist() for k in (0, 2, 3)]
            for name, kind, key, vector in zip(*names, _vectors(batch.column(4), batch.column(5), table)):
                if kind == 0:
                    centre, own = name, vector
                else:
                    out.append((centre, key, weighted_jaccard(own, vector)))
            if out:
                c, k, s = zip(*out)
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()), pa.array(k, pa.binary()), pa.array(s)], names=["centre", "key", "similarity"])

    return dealt.mapInArrow(run, "centre binary, key binary, similarity double")


def _apart(in_bucket: DataFrame, comp: DataFrame) -> DataFrame:
    """``(bucket, key, comp, apart, members)`` of the buckets that still hold more than one component;
    ``apart``: outside the component of the bucket's smallest member."""
    label = comp.withColumnRenamed("id", "key").withColumnRenamed("component", "comp")
    centre = comp.select(F.col("id").alias("centre"), F.col("component").alias("centre_comp"))
    placed = in_bucket.join(label, "key", "left").join(centre, "centre", "left").select(
        "bucket", "key", F.coalesce("comp", "key").alias("comp"), F.coalesce("centre_comp", "centre").alias("centre_comp")
    )
    placed = placed.withColumn("apart", F.col("comp") != F.col("centre_comp"))
    open_ = placed.groupBy("bucket").agg(F.max("apart").alias("open"), F.count(F.lit(1)).alias("members")).filter("open").drop("open")
    return written(placed.join(open_, "bucket").select("bucket", "key", "comp", "apart", "members"), "apart")


def _tile_links(spark: SparkSession, placed: DataFrame, texts: DataFrame, idf: Weights, threshold: float) -> DataFrame:
    """``(a, b)``: links between different components of a bucket, from all its members that are apart against all its members.

    A bucket is cut into blocks of about ``TILE`` members; a tile holds the
    apart members of one block and all members of another (of the same one:
    each text once), compares them exactly (weighted sets as sparse columns of
    a matrix product) and returns only links that join something, at most one a
    member.
    """
    shared = spark.sparkContext.broadcast(idf)
    placed = placed.withColumn("blocks", F.ceil(F.col("members") / TILE).cast("int"))
    placed = placed.withColumn("own", F.pmod(F.hash("key"), F.col("blocks"))).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    left = placed.filter("apart and own != other").select("bucket", F.col("own").alias("i"), F.col("other").alias("j"), F.lit(True).alias("left"), F.lit(False).alias("right"), "key", "comp")
    both = (F.col("apart") & (F.col("own") == F.col("other"))).alias("left")
    right = placed.select("bucket", F.col("other").alias("i"), F.col("own").alias("j"), both, F.lit(True).alias("right"), "key", "comp")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = left.unionByName(right).join(texts, "key").select("bucket", "i", "j", "left", "right", "key", "comp", "text", "df")
    dealt = dealt.repartition(parts, "bucket", "i", "j").sortWithinPartitions("bucket", "i", "j", "key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, tile, members = shared.value, None, []

        def close() -> list[tuple[bytes, bytes]]:
            return _links_of(members, threshold)

        for batch in batches:
            out: list[tuple[bytes, bytes]] = []
            names = [batch.column(k).to_pylist() for k in range(7)]
            for bucket, i, j, *member, vector in zip(*names, _vectors(batch.column(7), batch.column(8), table)):
                if (bucket, i, j) != tile:
                    out += close()
                    tile, members = (bucket, i, j), []
                members.append((*member, vector))
            if out:
                yield _link_batch(out)
        if out := close():
            yield _link_batch(out)

    return dealt.mapInArrow(run, "a binary, b binary")


def _link_batch(links: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
    a, b = zip(*links)
    return pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])


def _links_of(members: list[tuple], threshold: float) -> list[tuple[bytes, bytes]]:
    """Joining links of one tile's ``(left, right, key, component, vector)``: every left member against every right member of another component."""
    left, right = [m for m in members if m[0]], [m for m in members if m[1]]
    if not left or len({m[3] for m in members}) < 2:
        return []
    parent: dict[bytes, bytes] = {}

    def root(x: bytes) -> bytes:
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    # all right members' shingles in one sorted list: (hash, member, weight)
    h = np.concatenate([m[4][0] for m in right])
    w = np.concatenate([m[4][1] for m in right])
    who = np.repeat(np.arange(len(right)), [len(m[4][0]) for m in right])
    order = np.argsort(h, kind="stable")
    h, w, who = h[order], w[order], who[order]
    total = np.array([m[4][1].sum() for m in right])
    out = []
    for _, _, key, comp, (own, weight) in left:
        lo, hi = np.searchsorted(h, own), np.searchsorted(h, own, "right")
        runs = hi - lo
        at = np.repeat(lo - np.cumsum(runs) + runs, runs) + np.arange(runs.sum())
        low = np.bincount(who[at], np.minimum(w[at], np.repeat(weight, runs)), len(right))
        similar = low >= threshold * (total + weight.sum() - low)
        for i in np.flatnonzero(similar):
            a, b = root(comp), root(right[i][3])
            if a != b:
                parent[a] = b
                out.append((key, right[i][2]))
    return out


def near_classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``row`` (input row as a struct), ``class_id``, ``kept``."""
    spark = docs.sparkSession
    ship_package(spark)
    key = F.unhex(F.md5(col(text).cast("binary")))
    texts = docs.select(key.alias("key"), col(text).alias("text")).filter(F.col("text").isNotNull())
    idf, frequencies = _counted(texts, docs.count())
    drawn = None
    if idf.least > 2:  # more shingles in two texts or more than are broadcast
        idf = idf.bare()
        drawn = written(weighted_bands(texts, frequencies, idf), "drawn")
        bands = drawn.select("key", F.explode("buckets").alias("bucket"))
    else:
        bands = band_keys(spark, texts, idf)
    bands = written(bands.distinct(), "bands")

    buckets = bands.groupBy("bucket").agg(F.min("key").alias("centre"), F.count(F.lit(1)).alias("members")).filter("members > 1")
    in_bucket = written(bands.join(buckets.select("bucket", "centre"), "bucket"), "buckets")
    star = in_bucket.filter("key != centre").select("centre", "key").distinct()
    near = in_bucket.select("key").distinct()
    own = texts.join(near, "key", "left_semi").groupBy("key").agg(F.first("text").alias("text"))
    if drawn is None:
        own = own.withColumn("df", F.lit(None).cast("binary"))
    else:
        own = own.join(drawn.groupBy("key").agg(F.first("df").alias("df")), "key")
    own = written(own, "candidates")
    tested = written(similarities(spark, star, own, idf), "star")
    links = tested.filter(F.col("similarity") >= threshold).select(F.col("centre").alias("a"), F.col("key").alias("b"))

    links = written(links, "links")
    comp = components(links)
    rest = _tile_links(spark, _apart(in_bucket, comp), own, idf, threshold)
    comp = components(links.unionByName(written(rest, "tiles")))

    rows = docs.select(packed(docs).alias("row"), key.alias("key"), col(doc_id).alias("id"))
    named = rows.filter(F.col("key").isNotNull()).groupBy("key", "id").agg(F.count(F.lit(1)).alias("copies"))
    named = named.join(comp.withColumnRenamed("id", "key"), "key", "left").withColumn("comp", F.coalesce("component", "key"))
    first = F.min(F.struct(F.col("id").isNull().alias("none"), F.col("id").alias("id"), F.col("key").alias("key"))).alias("first")
    classes = named.groupBy("comp").agg(first)
    named = named.join(classes, "comp").select(
        F.col("key").alias("key2"), F.col("id").alias("id2"), F.col("first.id").alias("class_id"),
        ((F.col("first.key") == F.col("key")) & F.col("first.id").eqNullSafe(F.col("id"))).alias("first_of_class"),
    )
    joined = rows.join(named, (F.col("key") == F.col("key2")) & F.col("id").eqNullSafe(F.col("id2")), "left")
    return joined.select(
        "row", "key", F.when(F.col("key").isNull(), F.col("id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("first_of_class", F.lit(True)).alias("kept"),
    )


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each class (every null text is a class)."""
    classed = near_classes(docs, doc_id, text).filter("kept")
    alone = classed.filter(F.col("key").isNull())
    once = classed.filter(F.col("key").isNotNull()).dropDuplicates(["key"])
    return alone.unionByName(once).select(*unpacked(alone, "row", docs.columns))
