"""Suffix-array dedup with sparse suffix arrays at minimiser positions.

A passage of at least 50 words that stands in two different texts is found and
its spans are reported in every text that holds it.

Suffixes are kept only at content-selected positions: of every window of 50
words, the position whose ten-word gram has the smallest hash (about one
position in 21). Equal windows select equal positions, so two texts that share
50 words share a kept suffix inside them. Suffixes whose ten-word gram stands
in one text only cannot match and go first. The suffixes of a gram that has at
most nine carry the 50 words to their right and the 40 to their left (as word
hashes). They are sorted by range over the whole corpus, in ranges of grams, so
a gram lies in one partition; each is compared with the next eight, which are
all others of its gram, and matches are extended right and left; a match of 50
words or more is a span.

A gram with more suffixes (a common phrase) has no order in which all matches
are neighbours: a match may lie left and right of the gram. Its suffixes send
the hash of every window of 50 words that holds the gram instead. A window
that stands in two texts is a span; windows are counted with partial
aggregation, without pairs, so a phrase may stand in any number of texts.
Texts are shuffled once, to make equal ones one and to meet their positions, and
written with these; both ways read them from there. Both are exact. Longer passages are covered by the spans of their
positions, which are merged.

Defined cases: repeats within one text only are no match. Equal texts (copies
of a row's text) of 50 words or more match in full. Null, empty and shorter
texts have no span. Rows are matched by text, so repeated ids and null ids get
the spans of their text. Words are separated by white space; case of A-Z is
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import tokens
from .common import col, ship_package, written

LENGTH = 50
GRAM = 10
NEIGHBOURS = 8
_WORD = r"[^ \t\n\x0B\f\r]+"


def _sliding(a: np.ndarray, width: int, op: np.ufunc) -> np.ndarray:
    """op over every run of ``width`` entries, by doubling."""
    have = 1
    while have * 2 <= width:
        a = op(a[:-have], a[have:])
        have *= 2
    return op(a[: len(a) - (width - have)], a[width - have :]) if width > have else a


def minimisers(piece: tokens.Piece, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """(word positions in the piece, gram hashes) that some window of ``length`` words selects."""
    width = length - gram + 1
    n = len(piece.hashes)
    if n < length:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    own, at = tokens.ngrams(piece, gram)
    top = np.uint64(2**64 - 1)
    h = np.full(n, top, np.uint64)  # grams that cross a text's end stay at the top
    h[at] = np.minimum(own, top - np.uint64(1))
    least = _sliding(h, width, np.minimum)
    bad = _sliding((h == top).astype(np.uint8), width, np.maximum)
    least[bad.astype(bool)] = 0
    padded = np.concatenate([np.zeros(width - 1, np.uint64), least, np.zeros(width - 1, np.uint64)])
    best = _sliding(padded, width, np.maximum)  # over the windows that hold each position
    chosen = np.flatnonzero((best[: len(h)] == h) & (h != top) & (h != 0))
    return chosen, h[chosen]


def positions(texts: DataFrame, length: int = LENGTH) -> DataFrame:
    """``(gram, key, pos)`` of the kept suffixes of ``texts(key, text)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in tokens.pieces(batch.column(1)):
                at, gram = minimisers(piece, length)
                doc = np.searchsorted(piece.first, at, "right") - 1
                keys = batch.column(0).take(pa.array(doc + piece.lo))
                pos = (at - piece.first[doc]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(gram.view(np.int64)), keys, pa.array(pos)], names=["gram", "key", "pos"])

    return texts.mapInArrow(run, "gram long, key binary, pos int")


def _fixed(rows: np.ndarray) -> pa.Array:
    """A binary column of equal-sized rows of big-endian words (they sort as their numbers do)."""
    data = rows.astype(">u4").tobytes()
    size = rows.shape[1] * 4
    offsets = pa.py_buffer(np.arange(len(rows) + 1, dtype=np.int32) * size)
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, offsets, pa.py_buffer(data)])


def _contexts(texts: DataFrame, length: int, gram: int = GRAM) -> DataFrame:
    """``(gram, right, left, key, pos)`` for ``texts(key, text, at)``: words as 32-bit hashes, 0 past the text."""
    before = length - gram

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            for piece in tokens.pieces(batch.column(1)):
                own = lists.slice(piece.lo, piece.hi - piece.lo)
                counts = np.array([len(x) for x in own], np.int64)
                doc = np.repeat(np.arange(len(own)), counts)
                pos = own.flatten().to_numpy().astype(np.int64)
                word = ((piece.hashes >> np.uint64(32)).astype(np.uint32)) | np.uint32(1)
                ngram, first = tokens.ngrams(piece, gram)
                at = piece.first[doc] + pos
                g = ngram[np.searchsorted(first, at)]
                for lo in range(0, len(at), 8192):
                    part, d = at[lo : lo + 8192, None], doc[lo : lo + 8192]
                    r = part + np.arange(length)
                    right = np.where(r < piece.first[d + 1][:, None], word[np.minimum(r, len(word) - 1)], 0)
                    left_at = part - 1 - np.arange(before)
                    left = np.where(left_at >= piece.first[d][:, None], word[np.maximum(left_at, 0)], 0)
                    keys = batch.column(0).take(pa.array(d + piece.lo))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(g[lo : lo + 8192].view(np.int64)), _fixed(right), _fixed(left), keys, pa.array(pos[lo : lo + 8192].astype(np.int32))],
                        names=["gram", "right", "left", "key", "pos"],
                    )

    return texts.mapInArrow(run, "gram long, right binary, left binary, key binary, pos int")


def _windows(texts: DataFrame, length: int, gram: int = GRAM) -> DataFrame:
    """``(window, key, pos)`` for ``texts(key, text, at)``: each window of ``length`` words that holds the gram at a position."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            for piece in tokens.pieces(batch.column(1)):
                own = lists.slice(piece.lo, piece.hi - piece.lo)
                doc = np.repeat(np.arange(len(own)), [len(x) for x in own])
                at = piece.first[doc] + own.flatten().to_numpy().astype(np.int64)
                window, first = tokens.ngrams(piece, length)
                held = np.zeros(len(piece.hashes) + 1, np.int64)  # a window's start lies up to ``length - gram`` words before
                np.add.at(held, np.maximum(at - (length - gram), piece.first[doc]), 1)
                np.add.at(held, at + 1, -1)
                chosen = np.flatnonzero(np.cumsum(held)[first] > 0)
                of = np.searchsorted(piece.first, first[chosen], "right") - 1
                pos = (first[chosen] - piece.first[of]).astype(np.int32)
                for lo in range(0, len(chosen), 65_536):
                    cut = slice(lo, lo + 65_536)
                    keys = batch.column(0).take(pa.array(of[cut] + piece.lo))
                    yield pa.RecordBatch.from_arrays([pa.array(window[chosen[cut]].view(np.int64)), keys, pa.array(pos[cut])], names=["window", "key", "pos"])

    return texts.mapInArrow(run, "window long, key binary, pos int")


def _common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common prefix of each pair of rows; 0 is no word."""
    differ = (a != b) | (a == 0)
    return np.where(differ.any(axis=1), differ.argmax(axis=1), a.shape[1])


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), ">u4").reshape(len(column), width).astype(np.uint32)


def _compare(length: int, gram: int = GRAM):
    """Compare a partition's sorted suffixes with their next neighbours: ``(key, from_word, to_word)``."""
    width = {"right": length, "left": length - gram}
    names = ["gram", "right", "left", "key", "pos"]

    def spans(t: pa.Table) -> pa.RecordBatch:
        n = t.num_rows
        g, pos = t["gram"].to_numpy(), t["pos"].to_numpy()
        keys = t["key"].combine_chunks()
        code = keys.dictionary_encode().indices.to_numpy()
        right, left = (_matrix(t[x].combine_chunks(), width[x]) for x in ("right", "left"))
        lo, hi = np.full(n, 1 << 30, np.int64), np.full(n, -1, np.int64)
        for step in range(1, min(NEIGHBOURS, n - 1) + 1):
            i = np.flatnonzero((g[:-step] == g[step:]) & (code[:-step] != code[step:]))
            j = i + step
            r, l = _common(right[i], right[j]), _common(left[i], left[j])
            ok = r + l >= length
            for x in (i[ok], j[ok]):
                np.minimum.at(lo, x, pos[x] - l[ok])
                np.maximum.at(hi, x, pos[x] + r[ok])
        at = np.flatnonzero(hi >= 0)
        return pa.RecordBatch.from_arrays([keys.take(pa.array(at)), pa.array(lo[at].astype(np.int32)), pa.array(hi[at].astype(np.int32))], names=["key", "from_word", "to_word"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carried = None  # the last suffixes of the batch before
        for batch in batches:
            own = pa.Table.from_batches([batch]).select(names)
            if own.num_rows:
                t = own if carried is None else pa.concat_tables([carried, own])
                yield spans(t)
                carried = t.slice(max(0, t.num_rows - NEIGHBOURS))

    return run


def repeated_spans(docs: DataFrame, text: str = "text", length: int = LENGTH) -> DataFrame:
    """``(key, from_word, to_word)``: merged spans; ``key`` is the MD5 of the text, in bytes."""
    spark = docs.sparkSession
    ship_package(spark)
    base = docs.select(F.unhex(F.md5(col(text).cast("binary"))).alias("key"), col(text).alias("text")).filter(F.col("text").isNotNull())
    kept = written(positions(base, length), "suffixes")
    # written, so that the joins below have plain exchanges on both sides and AQE can split a hot gram
    counted = kept.groupBy("gram").agg(F.min("key").alias("lo"), F.max("key").alias("hi"), (F.count(F.lit(1)) > NEIGHBOURS + 1).alias("common"))
    shared = written(counted.filter("lo != hi").select("gram", "common"), "shared")
    lists = kept.join(shared, "gram").groupBy("key").agg(
        F.collect_set(F.when(~F.col("common"), F.col("pos"))).alias("rare"), F.collect_set(F.when(F.col("common"), F.col("pos"))).alias("often")
    )
    once = base.groupBy("key").agg(F.first("text").alias("text"), F.count(F.lit(1)).alias("copies"))
    held = written(once.join(lists, "key", "left").filter("rare is not null or copies > 1"), "texts")
    at = lambda which: held.filter(F.size(which) > 0).select("key", "text", F.col(which).alias("at"))

    rows = _contexts(at("rare"), length)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(parts, "gram").sortWithinPartitions("gram", "right", "key", "pos")  # at most nine of a gram
    found = written(dealt.mapInArrow(_compare(length), "key binary, from_word int, to_word int"), "spans")
    # written: read twice below, and the join has plain exchanges as above
    windows = written(_windows(at("often"), length), "windows")
    several = written(windows.groupBy("window").agg(F.min("key").alias("lo"), F.max("key").alias("hi")).filter("lo != hi").select("window"), "several")
    common = windows.join(several, "window").select("key", F.col("pos").alias("from_word"), (F.col("pos") + length).alias("to_word"))
    copies = held.filter("copies > 1").select("key", F.lit(0).alias("from_word"), F.regexp_count("text", F.lit(_WORD)).alias("to_word")).filter(F.col("to_word") >= length)
    spans = found.unionByName(common).unionByName(copies)
    w = W.partitionBy("key").orderBy("from_word", "to_word")
    reach = F.max("to_word").over(w.rowsBetween(W.unboundedPreceding, -1))
    islands = spans.withColumn("fresh", F.when(F.col("from_word") <= reach, 0).otherwise(1)).withColumn("island", F.sum("fresh").over(w))
    return islands.groupBy("key", "island").agg(F.min("from_word").alias("from_word"), F.max("to_word").alias("to_word")).drop("island")


def repeated_passages(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """``(doc_id, from_word, to_word, n_words)``: a row per document and passage that another text repeats."""
    spans = repeated_spans(docs, text, length)
    ids = docs.select(col(doc_id).alias("doc_id"), F.unhex(F.md5(col(text).cast("binary"))).alias("key"))
    return ids.join(spans, "key").select("doc_id", "from_word", "to_word", (F.col("to_word") - F.col("from_word")).alias("n_words"))
