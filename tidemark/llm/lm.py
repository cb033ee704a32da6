"""Language-model scoring with a log-frequency Bloom filter.

The model is a bigram model over the training documents' tokens: words (runs
of bytes other than space and 0x09-0x0D, A-Z lower-cased), then one end.

Every pair (u, w) seen in training, once or more often, is put into a Bloom
filter at the levels 1, 2, ... up to the last whose least count (1, 2, 3, 4, 6,
8, 12, ...: powers of the root of 2, rounded up) does not exceed its own: its
quantised log-frequency. Probes go up level by level until one fails; the last
level that holds gives the count back, rounded down. The probability is
Dirichlet smoothing over the base model,

    P(w | u) = (c(u, w) + MU * P0(w)) / (c(u) + MU)
    P0(w)    = (c(w) + 0.1) / (N + 0.1 (V + 1))

where c(u), c(w), N and V are exact and c(u, w) is the filter's answer, at most
c(u) and c(w). P0 alone gives the base score.

Exact word counts without a table of all words anywhere: documents are cut into
blocks of some megabytes; a block sends its distinct words and counts to the
words' hash buckets, which add them up over all blocks and answer each block
with its own words' totals.

The filter is built and read in different stages. A block's distinct pairs are
written once, by the pair's hash: part, segment and key. To build, the training
counts of a segment are added up in one group, which writes its bits; a pair's
hash deals it, so a common context lies in all segments, and a segment is of
bounded size because their number follows the input. To read, the parts, some
segments each and so bounded too, are broadcast one after the other, and each
is probed by the keys of that part only: every pair is probed once, and no task
that probes sees a count. Filter and work grow with the corpus, a broadcast
does not.

Defined cases: a null or empty text has one token, the end. A null id counts
as the empty string for the fold (held out). Repeated rows count each. Without
training tokens every word is unknown: N = V = 0.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import tokens
from .common import col, shared_path, ship_package, written

BLOCK = 4 << 20
STRETCH = 200_000  # tokens scored at a time
ENTRY_BITS = 12  # of the filter for each entry
PROBES = 4  # with 12 bits: 0.7 % of the probes of absent pairs find something
MU = 300.0
SEGMENT = 16 << 20  # bytes of text whose pairs make a segment
PART = 8  # segments that are broadcast together
KEY_BITS = np.uint64(48)  # of a pair's hash below its segment: equal keys for different pairs are one in 10**8
END = np.uint64(0x1D872B41A9E3F577)  # hash of the end token; also the context of a text's first word
_LEVEL = np.uint64(0xA24BAED4963EE407)


def fold(doc_id: Column, modulus: int) -> Column:
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(modulus))


def _packed(*arrays: np.ndarray) -> bytes:
    """Arrays byte plane by byte plane, compressed: high bytes of small numbers cost nothing."""
    planes = b"".join(np.ascontiguousarray(a).view(np.uint8).reshape(len(a), -1).T.tobytes() for a in arrays)
    return zstandard.ZstdCompressor(level=1).compress(planes)


def _unpacked(blob: bytes, *kinds: type) -> list[np.ndarray]:
    sizes = [np.dtype(k).itemsize for k in kinds]
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    n, at, out = len(raw) // sum(sizes), 0, []
    for kind, size in zip(kinds, sizes):
        out.append(np.ascontiguousarray(raw[at : at + n * size].reshape(size, n).T).view(kind).ravel())
        at += n * size
    return out


class _Block:
    """Rows of some megabytes of text: word hashes with an end after each text."""

    def __init__(self):
        self.hashes: list[np.ndarray] = []
        self.lens: list[np.ndarray] = []
        self.ids: list[pa.Array] = []
        self.held: list[np.ndarray] = []
        self.bytes = 0

    def add(self, piece: tokens.Piece, ids: pa.Array, held: np.ndarray) -> None:
        lens = np.diff(piece.first)
        self.hashes.append(np.insert(piece.hashes, piece.first[1:], END))
        self.lens.append(lens + 1)
        self.ids.append(ids.slice(piece.lo, piece.hi - piece.lo))
        self.held.append(held[piece.lo : piece.hi])
        self.bytes += len(piece.data)

    def close(self) -> tuple[np.ndarray, np.ndarray, pa.Array, np.ndarray]:
        return np.concatenate(self.hashes), np.concatenate(self.lens), pa.concat_arrays(self.ids), np.concatenate(self.held)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, pa.Array, np.ndarray]]:
    """From batches of (id, text, held)."""
    block = _Block()
    for batch in batches:
        held = batch.column(2).to_numpy(zero_copy_only=False).astype(bool)
        for piece in tokens.pieces(batch.column(1)):
            block.add(piece, batch.column(0), held)
            if block.bytes >= BLOCK:
                yield block.close()
                block = _Block()
    if block.hashes:
        yield block.close()


def _bucket_of(h: np.ndarray, bits: int) -> np.ndarray:
    return (h >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(h), np.int64)


def _cuts(bucket: np.ndarray) -> np.ndarray:
    """Starts of the runs of a sorted array, and its length."""
    return np.append(np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])), len(bucket)) if len(bucket) else np.zeros(1, np.int64)


def _vocabulary(bits: int):
    """A row per block (its documents as word numbers, its words) and a row per block and word bucket (hashes, training counts)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for hashes, lens, ids, held in _blocks(batches):
            name = uuid.uuid4().hex  # only the attempt whose output is committed is ever read
            words, number = np.unique(hashes, return_inverse=True)
            count = np.bincount(number[np.repeat(~held, lens)], minlength=len(words))
            cuts = _cuts(bucket := _bucket_of(words, bits))
            n = len(cuts) - 1
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([name] * n), pa.array(bucket[cuts[:-1]].astype(np.int32)),
                    pa.array([_packed(words[a:b], count[a:b].astype(np.int64)) for a, b in zip(cuts[:-1], cuts[1:])], pa.binary()),
                    pa.nulls(n, pa.binary()), pa.nulls(n, pa.list_(ids.type)), pa.nulls(n, pa.list_(pa.int64())), pa.nulls(n, pa.list_(pa.bool_())),
                ],
                names=["block", "bucket", "blob", "words", "ids", "lens", "held"],
            )
            whole = lambda a: pa.ListArray.from_arrays(pa.array([0, len(a)], pa.int32()), a)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([name]), pa.array([-1], pa.int32()), pa.array([_packed(number.astype(np.uint32))], pa.binary()),
                    pa.array([_packed(words)], pa.binary()), whole(ids), whole(pa.array(lens.astype(np.int64))), whole(pa.array(held)),
                ],
                names=["block", "bucket", "blob", "words", "ids", "lens", "held"],
            )

    return run


def _summed(keys: list[np.ndarray], values: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys, their sums, and where each given key stands among them."""
    key, at = np.unique(np.concatenate([np.zeros(0, np.uint64), *keys]), return_inverse=True)
    total = np.zeros(len(key), np.int64)
    np.add.at(total, at, np.concatenate([np.zeros(0, np.int64), *values]).astype(np.int64))
    return key, total, at


def _add_up(group: pa.Table) -> pa.Table:
    """All blocks' words of one bucket: their totals back to each block, and the bucket's N and V."""
    names = group["block"].to_pylist()
    parts = [_unpacked(x, np.uint64, np.int64) for x in group["blob"].to_pylist()]
    _, total, at = _summed([w for w, _ in parts], [c for _, c in parts])
    ends = np.cumsum([len(w) for w, _ in parts])
    answers = [_packed(total[at[e - len(w) : e]]) for (w, _), e in zip(parts, ends)]
    bucket = group["bucket"][0].as_py()
    return pa.table(
        {
            "block": pa.array([*names, None], pa.string()),
            "at": pa.array([bucket] * (len(names) + 1), pa.int32()),
            "blob": pa.array([*answers, None], pa.binary()),
            "n": pa.array([None] * len(names) + [int(total.sum())], pa.int64()),
            "v": pa.array([None] * len(names) + [int((total > 0).sum())], pa.int64()),
        }
    )


def _pairs_of(words: np.ndarray, number: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of a block's distinct pairs, rising, and where each token's pair stands among them.

    The hash's first bits name the segment, the ``KEY_BITS`` after them the pair within it.
    """
    n = np.uint64(len(words))
    u = np.empty(len(number), np.uint64)
    u[1:] = number[:-1]
    u[np.cumsum(lens) - lens] = np.searchsorted(words, END)
    pair, at = np.unique(u * n + number.astype(np.uint64), return_inverse=True)
    h = tokens.mix(tokens.mix(words[pair // n]) + words[pair % n])
    order = np.argsort(h)
    back = np.empty_like(order)
    back[order] = np.arange(len(order))
    return h[order], back[at]


def _keys(h: np.ndarray, bits: int) -> np.ndarray:
    return (h << np.uint64(bits)) >> (np.uint64(64) - KEY_BITS)


def _pairs(bits: int):
    """A row per block and segment: its pairs' keys, held-out ones too, and their training counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {x: batch.column(x)[i] for x in batch.schema.names}
                (number,), (words,) = _unpacked(row["blob"].as_py(), np.uint32), _unpacked(row["words"].as_py(), np.uint64)
                lens, held = row["lens"].values.to_numpy(), row["held"].values.to_numpy(zero_copy_only=False)
                h, at = _pairs_of(words, number, lens)
                count = np.bincount(at[np.repeat(~held, lens)], minlength=len(h)).astype(np.uint32)
                segment, key = _bucket_of(h, bits), _keys(h, bits)
                cuts = _cuts(segment)
                keys = [_packed(np.diff(key[a:b], prepend=np.uint64(0))) for a, b in zip(cuts[:-1], cuts[1:])]
                counts = [_packed(count[a:b]) for a, b in zip(cuts[:-1], cuts[1:])]
                own = segment[cuts[:-1]].astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["block"].as_py()] * len(own), pa.string()), pa.array(own), pa.array(keys, pa.binary()), pa.array(counts, pa.binary()), pa.array(own // PART)],
                    names=["block", "segment", "keys", "counts", "part"],
                )

    return run


# ---- the filter -------------------------------------------------------------------------------


def _least_counts() -> np.ndarray:
    """The least count of level 1, 2, ...: powers of the root of 2, rounded up, each once."""
    return np.unique(np.ceil(2.0 ** (np.arange(0, 125) / 2) - 1e-9).astype(np.int64))


LEAST = _least_counts()


def quantised(count: np.ndarray) -> np.ndarray:
    """The level of a count: how many least counts it reaches."""
    return np.searchsorted(LEAST, count, "right")


def restored(level: np.ndarray) -> np.ndarray:
    """The least count of a level; 0 at level 0."""
    return np.append(0, LEAST)[level]


def _slots(key: np.ndarray, level: int, size: int) -> Iterator[np.ndarray]:
    """The bit numbers of keys at a level within a segment of ``size`` bits."""
    a = tokens.mix(key + np.uint64(level * int(_LEVEL) % 2**64))
    b = tokens.mix(a ^ _LEVEL) | np.uint64(1)
    for i in range(PROBES):
        yield ((a + np.uint64(i) * b) % np.uint64(size)).astype(np.int64)


def filled(key: np.ndarray, count: np.ndarray) -> bytes:
    """The bits of a segment that holds these keys at all levels of their counts."""
    level = quantised(count)
    size = -(-max(64, int(level.sum()) * ENTRY_BITS) // 64) * 64
    bits = np.zeros(size, bool)
    for j in range(1, int(level.max(initial=0)) + 1):
        key, level = key[level >= j], level[level >= j]
        for slot in _slots(key, j, size):
            bits[slot] = True
    return np.packbits(bits, bitorder="little").tobytes()


def probed(bits: np.ndarray, key: np.ndarray) -> np.ndarray:
    """The last level of 1, 2, ... at which each key is still a member of a segment's bits."""
    size = 8 * len(bits)
    out, alive = np.zeros(len(key), np.uint8), np.arange(len(key))
    for j in range(1, len(LEAST) + 1):
        if not len(alive):
            break
        inside = np.ones(len(alive), bool)
        for slot in _slots(key[alive], j, size):
            inside &= (bits[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 == 1
        alive = alive[inside]
        out[alive] = j
    return out


def _build(group: pa.Table) -> pa.Table:
    """All blocks' training counts of one segment to the segment's bits."""
    parts = [np.cumsum(_unpacked(x, np.uint64)[0], dtype=np.uint64) for x in group["keys"].to_pylist()]
    counts = [_unpacked(x, np.uint32)[0] for x in group["counts"].to_pylist()]
    key, total, _ = _summed([k[c > 0] for k, c in zip(parts, counts)], [c[c > 0] for c in counts])
    return pa.table({"segment": group["segment"][:1], "bits": pa.array([filled(key, total)], pa.binary())})


def _probe(shared):
    """Rows (block, segment, keys) of one part to their levels, by the part's broadcast segments."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = {s: np.frombuffer(b, np.uint8) for s, b in shared.value.items()}
        for batch in batches:
            for i in range(batch.num_rows):
                key = np.cumsum(_unpacked(batch.column("keys")[i].as_py(), np.uint64)[0], dtype=np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("block").slice(i, 1), batch.column("segment").slice(i, 1), pa.array([_packed(probed(bits[batch.column("segment")[i].as_py()], key))], pa.binary())],
                    names=["block", "at", "blob"],
                )

    return run


def levels_of(pairs: DataFrame, parts: int) -> DataFrame:
    """``(block, at, blob)``: every block's levels by segment, read off the filter part by part."""
    spark = pairs.sparkSession
    bits = written(pairs.groupBy("segment").applyInArrow(_build, "segment int, bits binary"), "lm-filter")
    path = shared_path(spark, "lm-levels")
    shape = "block string, at int, blob binary"
    for part in range(parts):
        own = bits.filter(F.col("segment").between(part * PART, part * PART + PART - 1))
        shared = spark.sparkContext.broadcast({r["segment"]: bytes(r["bits"]) for r in own.collect()})  # PART segments of bounded size
        pairs.filter(F.col("part") == part).select("block", "segment", "keys").mapInArrow(_probe(shared), shape).write.mode("append").parquet(path)
        shared.destroy()
    return spark.read.schema(shape).parquet(path)


def _score(n: int, v: int):
    """Rows of a block, its words' totals and its pairs' levels to scored documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {x: batch.column(x)[i] for x in batch.schema.names}
                ids, lens, held = row["ids"].values, row["lens"].values.to_numpy(), row["held"].values
                (number,), (words,) = _unpacked(row["blob"].as_py(), np.uint32), _unpacked(row["words"].as_py(), np.uint64)
                answers = sorted(row["answers"].as_py(), key=lambda x: (x["pair"], x["at"]))  # as the block's own words and pairs are
                total = np.concatenate([_unpacked(x["blob"], np.int64)[0] for x in answers if not x["pair"]])
                level = np.concatenate([_unpacked(x["blob"], np.uint8)[0] for x in answers if x["pair"]])
                _, pair = _pairs_of(words, number, lens)
                p0 = (total + 0.1) / (n + 0.1 * (v + 1))
                first = np.cumsum(lens) - lens
                # the text's start is the word END as a context: it stands once in every training text
                end = int(np.searchsorted(words, END))
                log_p0 = np.log10(p0)
                known, base, score = np.zeros(len(lens), np.int64), np.zeros(len(lens)), np.zeros(len(lens))
                cut = np.unique(np.append(np.searchsorted(first, np.arange(0, len(number), STRETCH)), len(lens)))
                for lo, hi in zip(cut[:-1], cut[1:]):  # whole texts, some tokens at a time
                    at = first[lo:hi] - first[lo]
                    own = slice(first[lo], first[hi - 1] + lens[hi - 1])
                    w = number[own].astype(np.int64)
                    u = np.empty_like(w)
                    u[1:] = w[:-1]
                    u[at] = end
                    c = np.minimum(restored(level[pair[own]]), np.minimum(total[u], total[w]))
                    p = (c + MU * p0[w]) / (total[u] + MU)
                    known[lo:hi] = np.add.reduceat((total > 0)[w].astype(np.int64), at)
                    base[lo:hi] = np.add.reduceat(log_p0[w], at)
                    score[lo:hi] = np.add.reduceat(np.log10(np.minimum(p, 1.0)), at)
                yield pa.RecordBatch.from_arrays(
                    [ids, held, pa.array(lens), pa.array(known), pa.array(np.full(len(lens), n)), pa.array(base), pa.array(score)],
                    names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
                )

    return run


def score_texts(docs: DataFrame, held_out: Column, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)`` per row."""
    spark = docs.sparkSession
    ship_package(spark)
    kind = docs.select(col(doc_id)).schema[0].dataType.simpleString()
    rows = docs.select(col(doc_id).alias("doc_id"), F.coalesce(col(text), F.lit("")).alias("text"), held_out.alias("held"))
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    # buckets and segments of bounded size: their number follows the input
    word_bits = max(0, math.ceil(math.log2(max(1, size / (64 << 20)))))
    pair_bits = max(3, math.ceil(math.log2(max(1, size / SEGMENT))))

    schema = f"block string, bucket int, blob binary, words binary, ids array<{kind}>, lens array<bigint>, held array<boolean>"
    cut = written(rows.mapInArrow(_vocabulary(word_bits), schema), "lm-blocks")
    blocks = cut.filter("bucket < 0").select("block", "blob", "words", "lens", "held", "ids")
    words = cut.filter("bucket >= 0").select("block", "bucket", "blob")
    added = written(words.groupBy("bucket").applyInArrow(_add_up, "block string, at int, blob binary, n bigint, v bigint"), "lm-words")
    n, v = added.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("v"), F.lit(0))).first()

    pairs = blocks.select("block", "blob", "words", "lens", "held").mapInArrow(_pairs(pair_bits), "block string, segment int, keys binary, counts binary, part int")
    path = shared_path(spark, "lm-pairs")
    pairs.write.partitionBy("part").parquet(path)
    pairs = spark.read.schema(pairs.schema).parquet(path)
    levels = levels_of(pairs, max(1, (1 << pair_bits) // PART))

    # a block's answers are bounded by the block
    answers = added.select("block", F.lit(False).alias("pair"), "at", "blob").unionByName(levels.select("block", F.lit(True).alias("pair"), "at", "blob"))
    answers = answers.filter("block is not null").groupBy("block").agg(F.collect_list(F.struct("pair", "at", "blob")).alias("answers"))
    out = f"doc_id {kind}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    return blocks.join(answers, "block").mapInArrow(_score(int(n), int(v)), out)
