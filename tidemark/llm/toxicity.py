"""Toxicity by compression distance between two zstandard dictionaries.

One dictionary is trained on ordinary text, one on toxic text, each on its own
side alone: it holds, as raw content, the words that at least two documents of
the side use, the most used last, where a reference to them is cheapest, as
many as fit its size. Neither looks at the other side's counts; what is common
to both sides costs the same with either.

The window is a word with its borders, and every window of the whole text is
compressed with both. Its gain is its compressed length with the ordinary
dictionary less that with the toxic one, above or below zero; words that are
only partly known to a dictionary cost something between. A letter is written
as two bytes, so that a match of four or five letters outweighs the few bytes a
zstandard sequence costs.

Gains are calibrated by window length. For each length and gain there are two
numbers: the log ratio of toxic to ordinary documents that hold such a window
or one of a greater gain (its evidence), and the log ratio of such windows
among all of that length (its odds). A document's features are its three
largest pieces of evidence, its windows of evidence of at least one, and the
sum of the odds, both of the latter also by the number of windows; a logistic
calibration gives the score. All training documents teach the dictionaries;
calibration is crosswise, each half judged by dictionaries of the other half.
Distinct windows are compressed once a worker and looked up afterwards (a table
of bounded size).

Fitting reads at most ``fit_rows`` labelled documents of each class and at most
``fit_bytes`` of their text, those with the smallest hashes of their ids: these
bounds are the only ones. Copies of a text count once. Inputs of a score are
the text alone.

Defined cases: null and empty texts have no window and get the calibration's
score for no evidence. Null labels are no labels; documents whose labels
contradict each other are not used. With fewer than two toxic or ordinary
training texts every score is the share of toxic ones among them (0 without
any). A null id counts as the empty string for the fold.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import tokens
from .common import col, ship_package

FIT_ROWS = 3000
FIT_BYTES = 64 << 20
DICT_BYTES = (524_288, 131_072)  # ordinary, toxic
THRESHOLD = 0.7
CACHE = 1_500_000
LENGTHS, GAINS, NO_GAIN = 24, 49, 24  # a window's cell: its length, and its gain above -NO_GAIN
_CODE = np.random.default_rng(11).integers(0, 256, (256, 2), dtype=np.uint8)
_EDGE = bytes(b for b in range(128) if not chr(b).isalnum())


def _spelt(word: bytes) -> bytes:
    """A word between borders, a byte as two."""
    return _CODE[np.frombuffer(b" " + word + b" ", np.uint8)].tobytes()


def _normal(word: bytes) -> bytes:
    return word.lower().strip(_EDGE)


def _words(text: str) -> set[bytes]:
    return {w for w in (_normal(x) for x in text.encode().split()) if w}


def _trained(texts: list[str], size: int) -> bytes:
    """A raw-content dictionary of the words that at least two texts use, the most used last."""
    use: Counter = Counter()
    for text in texts:
        use.update(w for w in _words(text) if len(w) >= 3)
    recurring = sorted((w for w, n in use.items() if n >= 2), key=lambda w: (use[w], w))
    return b"".join(map(_spelt, recurring))[-size:]


@dataclass
class Model:
    ordinary: bytes
    toxic: bytes
    evidence: np.ndarray  # by cell
    odds: np.ndarray  # by cell
    weights: np.ndarray  # of the features
    constant: float | None = None

    def compressors(self) -> tuple[zstandard.ZstdCompressor, zstandard.ZstdCompressor]:
        out = []
        for content in (self.ordinary, self.toxic):
            params = zstandard.ZstdCompressionParameters(
                window_log=20, chain_log=17, hash_log=17, search_log=5, min_match=5, target_length=64, strategy=zstandard.STRATEGY_BTOPT,
                write_content_size=0, write_dict_id=0, write_checksum=0, format=zstandard.FORMAT_ZSTD1_MAGICLESS,
            )
            known = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            known.precompute_compress(compression_params=params)
            out.append(zstandard.ZstdCompressor(dict_data=known, compression_params=params))
        return out[0], out[1]


def gains(words: list[bytes], compressors) -> np.ndarray:
    """Compressed length with the ordinary dictionary less that with the toxic one, per word."""
    if not words:
        return np.zeros(0, np.int64)
    spelt = list(map(_spelt, words))
    x, y = (c.multi_compress_to_buffer(spelt) for c in compressors)
    return np.array([len(x[i]) - len(y[i]) for i in range(len(words))], np.int64)


def cells(words: list[bytes], compressors) -> np.ndarray:
    """Each word's cell."""
    n = np.minimum([len(w) for w in words], LENGTHS - 1).astype(np.int64)
    return (n * GAINS + np.clip(gains(words, compressors) + NO_GAIN, 0, GAINS - 1)).astype(np.int16)


class _Known:
    """Cells of words by hash, kept in the worker; started anew when full."""

    def __init__(self, compressors):
        self.compressors = compressors
        self.hashes, self.values = np.zeros(0, np.uint64), np.zeros(0, np.int16)

    def look_up(self, hashes: np.ndarray, word) -> np.ndarray:
        """Cells of distinct words; ``word(indices)`` gives those not met before."""
        at = np.searchsorted(self.hashes, hashes)
        found = np.zeros(len(hashes), bool)
        inside = at < len(self.hashes)
        found[inside] = self.hashes[at[inside]] == hashes[inside]
        out = np.zeros(len(hashes), np.int16)
        out[found] = self.values[at[found]]
        missing = np.flatnonzero(~found)
        if len(missing):
            out[missing] = cells(word(missing), self.compressors)
            if len(self.hashes) + len(missing) > CACHE:
                self.hashes, self.values = np.zeros(0, np.uint64), np.zeros(0, np.int16)
            joined = np.concatenate([self.hashes, hashes[missing]])
            order = np.argsort(joined)
            self.hashes, self.values = joined[order], np.concatenate([self.values, out[missing]])[order]
        return out


def piece_cells(piece: tokens.Piece, known: _Known) -> tuple[np.ndarray, np.ndarray]:
    """(text, cell) of every text's distinct words, by text."""
    hashes, first, number = np.unique(piece.hashes, return_index=True, return_inverse=True)

    def word(missing: np.ndarray) -> list[bytes]:
        at = first[missing]
        raw = piece.data.tobytes()
        return [_normal(raw[a:b]) for a, b in zip(piece.starts[at], piece.ends[at])]

    cell = known.look_up(hashes, word)
    pair = np.unique((piece.doc.astype(np.int64) << 32) | number)
    return pair >> 32, cell[pair & 0xFFFFFFFF].astype(np.int64)


def features(doc: np.ndarray, cell: np.ndarray, rows: int, evidence: np.ndarray, odds: np.ndarray) -> np.ndarray:
    """Three largest pieces of evidence, windows of evidence >= 1, sum of the odds by root and by number of windows, 1."""
    e = evidence[cell]
    order = np.lexsort((-e, doc))
    first, ends = (np.searchsorted(doc[order], np.arange(rows), side) for side in ("left", "right"))
    out = np.zeros((rows, 7))
    for k in range(3):
        has = first + k < ends
        out[has, k] = np.maximum(e[order[first[has] + k]], 0)
    n = np.maximum(np.bincount(doc, minlength=rows), 1)
    sums = np.bincount(doc, weights=odds[cell], minlength=rows)
    out[:, 3] = np.bincount(doc[e >= 1], minlength=rows) / np.sqrt(n)
    out[:, 4], out[:, 5], out[:, 6] = sums / np.sqrt(n), sums / n, 1
    return out


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 40) -> np.ndarray:
    """Weights of the features; both classes count the same, as the sample is drawn by class."""
    own = np.where(y > 0, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (own * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(h, x.T @ (own * (y - p)) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


def _judged(texts: list[str], known: _Known) -> list[tuple[np.ndarray, np.ndarray, int]]:
    """(text, cell, texts) of the texts' pieces."""
    return [(*piece_cells(p, known), p.hi - p.lo) for p in tokens.pieces(pa.array(texts, pa.large_string()))]


def _tables(side: list[tuple[np.ndarray, np.ndarray, int]]) -> tuple[np.ndarray, np.ndarray]:
    """By length and gain: the share of documents with such a window or one of a greater gain, and of windows of the length."""
    docs, windows, total = np.zeros((LENGTHS, GAINS)), np.zeros((LENGTHS, GAINS)), 0
    for doc, cell, rows in side:
        most = np.full((rows, LENGTHS), -1)
        np.maximum.at(most, (doc, cell // GAINS), cell % GAINS)
        for n in range(LENGTHS):
            top = np.bincount(most[most[:, n] >= 0, n], minlength=GAINS)
            docs[n] += top[::-1].cumsum()[::-1]
        windows += np.bincount(cell, minlength=LENGTHS * GAINS).reshape(LENGTHS, GAINS)
        total += rows
    return (docs + 0.5) / (total + 1), (windows + 0.3) / (windows.sum(1, keepdims=True) + 0.3 * GAINS)


def fit(toxic: list[str], ordinary: list[str]) -> Model:
    """Dictionaries from all labelled texts; calibration crosswise, each half by the other half's dictionaries."""
    # by a hash, so that the halves do not depend on the order in which texts came
    sets = [sorted(set(side), key=lambda t: (zlib.crc32(t.encode()), t)) for side in (toxic, ordinary)]
    sizes = DICT_BYTES[::-1]
    blank = np.zeros(LENGTHS * GAINS)
    final = Model(_trained(sets[1], sizes[1]), _trained(sets[0], sizes[0]), blank, blank, np.zeros(7))
    if not final.toxic or not final.ordinary or min(map(len, sets)) < 2:
        known = len(toxic) + len(ordinary)
        return Model(b"", b"", blank, blank, np.zeros(7), len(toxic) / known if known else 0.0)
    judged: list[list[tuple[np.ndarray, np.ndarray, int]]] = [[], []]
    for half in (0, 1):
        model = Model(*(_trained(sets[k][1 - half :: 2], sizes[k]) or b"\0" for k in (1, 0)), blank, blank, np.zeros(7))
        known = _Known(model.compressors())
        for kind in (0, 1):
            judged[kind] += _judged(sets[kind][half::2], known)
    (docs, windows), (other_docs, other_windows) = _tables(judged[0]), _tables(judged[1])
    evidence = np.log(docs / other_docs)
    evidence[:, : NO_GAIN + 1] = 0
    final.evidence, final.odds = evidence.ravel(), np.log(windows / other_windows).ravel()
    table = [[features(*part, final.evidence, final.odds) for part in side] for side in judged]
    y = np.concatenate([np.full(sum(len(x) for x in side), 1.0 - k) for k, side in enumerate(table)])
    final.weights = _logistic(np.concatenate([x for side in table for x in side]), y)
    return final


def scores(model: Model, x: np.ndarray) -> np.ndarray:
    if model.constant is not None:
        return np.full(len(x), model.constant)
    return 1 / (1 + np.exp(-np.clip(x @ model.weights, -30, 30)))


_worker: dict = {}


def training_texts(
    docs: DataFrame, labels: DataFrame, trains: Column, fit_rows: int, doc_id: str, text: str, fit_bytes: int = FIT_BYTES
) -> tuple[list[str], list[str]]:
    """Texts of each class from the training fold: those with the smallest hashes of their ids, at most ``fit_rows``
    documents and ``fit_bytes`` of text; a document that does not fit what is left is passed over."""
    clear = labels.filter(F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("most"))
    clear = clear.filter("toxic = most").select(F.col("doc_id").alias("label_id"), "toxic")
    pool = docs.select(col(doc_id).alias("doc_id"), col(text).alias("text")).filter(trains).filter(F.col("text").isNotNull())
    # ids and sizes first: no text meets the labels, and texts of the chosen rows only are read
    sizes = pool.select("doc_id", F.octet_length("text").alias("size")).join(clear, F.col("doc_id") == F.col("label_id")).groupBy("toxic", "doc_id").agg(F.sum("size").alias("size"))
    out = []
    for toxic in (1, 0):
        left, chosen = fit_bytes, []
        for r in sizes.filter(F.col("toxic") == toxic).orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows).collect():  # fit_rows rows
            if r["size"] <= left:
                left -= r["size"]
                chosen.append((r["doc_id"],))
        ids = docs.sparkSession.createDataFrame(chosen, pool.select("doc_id").schema)
        rows = pool.join(F.broadcast(ids), "doc_id", "left_semi").distinct().toLocalIterator()
        out.append([r["text"] for r in rows])
    return out[0], out[1]


def score_documents(
    docs: DataFrame, labels: DataFrame, held_out: Column, doc_id: str = "doc_id", text: str = "text", fit_rows: int = FIT_ROWS
) -> DataFrame:
    """``(doc_id, held_out, score, predicted, evidence, n_over)`` per row; ``held_out`` is over ``doc_id``."""
    spark = docs.sparkSession
    ship_package(spark)
    model = fit(*training_texts(docs, labels, ~held_out, fit_rows, doc_id, text))
    shared = spark.sparkContext.broadcast(model)  # two dictionaries of fixed size
    kind = docs.select(col(doc_id)).schema[0].dataType.simpleString()
    rows = docs.select(col(doc_id).alias("doc_id"), col(text).alias("text")).select("doc_id", "text", held_out.alias("held_out"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        if _worker.get("for") != (own.toxic, own.ordinary):
            _worker.clear()
            _worker.update({"for": (own.toxic, own.ordinary), "known": _Known(own.compressors()) if own.toxic else None})
        for batch in batches:
            for piece in tokens.pieces(batch.column(1)):
                n = piece.hi - piece.lo
                doc, cell = piece_cells(piece, _worker["known"]) if own.toxic else (np.zeros(0, np.int64), np.zeros(0, np.int64))
                x = features(doc, cell, n, own.evidence, own.odds)
                s = scores(own, x)
                over = np.bincount(doc[own.evidence[cell] >= 1], minlength=n)
                cut = lambda c: c.slice(piece.lo, n)  # noqa: B023, E731
                yield pa.RecordBatch.from_arrays(
                    [cut(batch.column(0)), cut(batch.column(2)), pa.array(s), pa.array((s >= THRESHOLD).astype(np.int32)), pa.array(x[:, 0]), pa.array(over.astype(np.int64))],
                    names=["doc_id", "held_out", "score", "predicted", "evidence", "n_over"],
                )

    return rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, score double, predicted int, evidence double, n_over bigint")
