"""Quality classifier by co-training of a text view and a metadata view.

The text view reads the words: the evidence that they and their pairs give,
beside counts (lengths, symbols, capitals, digits, bars, repetition). The
metadata view sees the other columns (language, source, length) and the evidence
of the source. Each is a logistic regression over these. In every round a view is
fitted on the labelled training rows and on the rows without a label that the
*other* view is confident about (probability at least 0.95 or at most 0.05),
at a third of a labelled row's weight; the two views exchange these
pseudo-labels again in the next round. Then both views are calibrated (Platt)
on labelled rows that neither was fitted on, and combined by a logistic
regression of the two calibrated log odds on the same rows.

Evidence is a log ratio of good to bad labelled training documents that hold a
word or pair (hashed to ``SLOTS``) or have a source (hashed to eight times as
many slots as there are sources). It is fitted crosswise: documents are halved
by a hash of their id, and each half is judged by the other half's table, so no
document's label tells on itself. The tables come from at most ``FIT_ROWS``
labelled documents, those with the smallest hashes of their ids: this bound is
the only one.

All rows take part: a Newton step adds up gradient and Hessian (some thousand
numbers) over the whole feature table by key, and the driver sees sums only. The
feature table holds some 70 numbers a row, not the texts, and is written once.

Defined cases: null labels are no labels, contradicting labels of a document
are not used, repeated equal labels count once. Null and empty texts have
zero counts and are scored like any other. Missing metadata columns and null
values are values of their own. Without both classes among the labels every
score is the share of good rows among the labelled (1 without labels, so
nothing is rejected).
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import tokens
from .common import col, ship_package, written

ROUNDS = 3
STEPS, FIRST_STEPS = 3, 7
STRIDE = 1.0  # the most that a Newton step changes a weight by
CONFIDENT = 0.95
PSEUDO_WEIGHT = 1 / 3
KEEP = 0.5
RIDGE = 1.0

_SYMBOLS = "#$%&*+<=>@\\^_`{}~"
_CLASS = np.zeros(256, np.uint8)
for _i, _chars in enumerate((" \t\r\v\f", "\n", "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ".,;:?'\"()-", "!", "|", _SYMBOLS), start=1):
    _CLASS[[ord(c) for c in _chars]] = _i
COUNTS, WORDS = 18, 6
TEXT_FEATURES = COUNTS + WORDS
LANGS, SOURCES = 8, 32
META_FEATURES = LANGS + SOURCES + 6
SLOTS = 1 << 16
FIT_ROWS = 20_000


def text_features(piece: tokens.Piece) -> np.ndarray:
    """(rows, COUNTS) of a piece."""
    rows = piece.hi - piece.lo
    size = np.diff(piece.offsets)
    n = np.maximum(np.diff(piece.first), 1).astype(float)
    byte_doc = np.repeat(np.arange(rows, dtype=np.int64), size)
    by_class = np.bincount(byte_doc * 16 + _CLASS[piece.data], minlength=rows * 16).reshape(rows, 16).astype(float)
    doc = piece.doc
    length = (piece.ends - piece.starts).astype(float)
    mean = np.bincount(doc, length, rows) / n
    spread = np.sqrt(np.maximum(np.bincount(doc, length**2, rows) / n - mean**2, 0))
    share = lambda flag: np.bincount(doc, flag, rows) / n
    pair = np.sort((piece.hashes >> np.uint64(16)) | (doc.astype(np.uint64) << np.uint64(48)))
    fresh = np.concatenate([[True], pair[1:] != pair[:-1]]) if len(pair) else np.zeros(0, bool)
    distinct = np.bincount((pair[fresh] >> np.uint64(48)).astype(np.int64), minlength=rows)
    again = np.zeros(len(doc))
    if len(doc) > 1:
        again[1:] = (piece.hashes[1:] == piece.hashes[:-1]) & (doc[1:] == doc[:-1])
    grams, at = tokens.ngrams(piece, 3)
    gram = np.unique((grams >> np.uint64(16)) | (doc[at].astype(np.uint64) << np.uint64(48)))
    gram_distinct = np.bincount((gram >> np.uint64(48)).astype(np.int64), minlength=rows)
    gram_all = np.maximum(np.bincount(doc[at], minlength=rows), 1)
    letters = np.maximum(size - by_class[:, 1:9].sum(axis=1) + by_class[:, 4], 1)
    per_word = lambda k: np.minimum(by_class[:, k] / n, 3)
    bytes_ = np.maximum(size, 1)
    f = [
        np.log1p(np.diff(piece.first)), np.minimum(mean, 30) / 10, np.minimum(spread, 30) / 10,
        by_class[:, 4] / letters, by_class[:, 3] / bytes_, by_class[:, 2] / bytes_ * 10,
        per_word(5), per_word(6), per_word(7), per_word(8),
        distinct / n, share(again), gram_distinct / gram_all, share(length <= 3), share(length >= 14),
        (by_class[:, 6] > 0).astype(float), (per_word(7) > 0.3).astype(float), (per_word(8) > 0.3).astype(float),
    ]
    return np.stack(f, axis=1).astype(np.float32)


def word_slots(piece: tokens.Piece) -> list[tuple[np.ndarray, np.ndarray]]:
    """(text, slot) of every word, and of every pair of neighbours."""
    pairs, at = tokens.ngrams(piece, 2)
    return [(piece.doc, (piece.hashes >> np.uint64(48)).astype(np.int64)), (piece.doc[at], (tokens.mix(pairs) >> np.uint64(48)).astype(np.int64))]


@dataclass
class Evidence:
    """Log ratios by the half they were fitted on: of hashed words and pairs, and of hashed sources."""

    words: np.ndarray
    sources: np.ndarray

    def word_features(self, piece: tokens.Piece, half: np.ndarray) -> np.ndarray:
        """(rows, WORDS): mean and sum by root of number, of words and of pairs, and the extremes; by the other half's table."""
        rows = piece.hi - piece.lo
        out = np.zeros((rows, WORDS), np.float32)
        for k, (doc, slot) in enumerate(word_slots(piece)):
            e = self.words[1 - half[doc], slot]
            n = np.maximum(np.bincount(doc, minlength=rows), 1)
            total = np.bincount(doc, e, rows)
            out[:, 2 * k], out[:, 2 * k + 1] = total / n, total / np.sqrt(n)
            np.maximum.at(out[:, 4], doc, e)
            np.minimum.at(out[:, 5], doc, e)
        return out


def meta_features(lang: pa.Array, source: pa.Array, n_chars: pa.Array, half: np.ndarray, evidence: Evidence) -> np.ndarray:
    """(rows, META_FEATURES): language and source by hashed one-hot, length by a few hinges, the source's evidence."""
    out = np.zeros((len(lang), META_FEATURES), np.float32)
    rows = np.arange(len(lang))
    for values, at, slots in ((lang, 0, LANGS), (source, LANGS, SOURCES)):
        table = values.dictionary_encode()
        code = np.array([0] + [1 + _slot(v.as_py(), slots - 1) for v in table.dictionary])
        index = table.indices.fill_null(-1).to_numpy(zero_copy_only=False)
        out[rows, at + code[index + 1]] = 1
    n = n_chars.to_numpy(zero_copy_only=False).astype(float)
    known = np.isfinite(n)
    logs = np.log1p(np.where(known, np.maximum(n, 0), 0))
    at = LANGS + SOURCES
    out[:, at], out[:, at + 1] = known, logs / 10
    for k, knee in enumerate((5.0, 7.0, 9.0)):
        out[:, at + 2 + k] = np.maximum(logs - knee, 0) / 10
    out[:, at + 5] = evidence.sources[1 - half, source_slots(source, evidence.sources.shape[1])]
    return out


def source_slots(source: pa.Array, slots: int) -> np.ndarray:
    table = source.dictionary_encode()
    code = np.array([_slot(None, slots)] + [_slot(v.as_py(), slots) for v in table.dictionary])
    return code[table.indices.fill_null(-1).to_numpy(zero_copy_only=False) + 1]


def _slot(value, slots: int) -> int:
    if value is None:
        return 0
    raw = np.frombuffer(str(value).encode(), np.uint8).astype(np.uint64)
    h = np.array([len(raw)], np.uint64)
    for b in raw:
        h = (h * np.uint64(1099511628211)) ^ b
    return int(tokens.mix(h)[0] % np.uint64(slots))


@dataclass
class Model:
    """Two views, their calibration, and their combination."""

    center: list[np.ndarray] = field(default_factory=list)
    scale: list[np.ndarray] = field(default_factory=list)
    weights: list[np.ndarray] = field(default_factory=list)
    platt: list[np.ndarray] = field(default_factory=lambda: [np.array([1.0, 0.0]), np.array([1.0, 0.0])])
    mix: np.ndarray = field(default_factory=lambda: np.array([1.0, 0.0, 0.0]))
    constant: float | None = None

    def inputs(self, view: int, x: np.ndarray) -> np.ndarray:
        return np.hstack([np.clip((x - self.center[view]) / self.scale[view], -8, 8), np.ones((len(x), 1))])

    def odds(self, view: int, x: np.ndarray) -> np.ndarray:
        return np.clip(self.inputs(view, x) @ self.weights[view], -10, 10)

    def calibrated(self, view: int, x: np.ndarray) -> np.ndarray:
        return self.platt[view][0] * self.odds(view, x) + self.platt[view][1]

    def score(self, text: np.ndarray, meta: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(text), self.constant)
        z = np.stack([self.calibrated(0, text), self.calibrated(1, meta), np.ones(len(text))], axis=1)
        return _sigmoid(z @ self.mix)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _half(doc_id: Column) -> Column:
    return F.pmod(F.xxhash64(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(2)).cast("int")


def _holds(doc_id: Column) -> Column:
    """The calibration fold."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(5)) == 0


def _clear(labels: DataFrame) -> DataFrame:
    """``(label_id, y)`` of the documents whose labels agree."""
    clear = labels.filter(F.col("quality").isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("y"), F.max("quality").alias("most"))
    return clear.filter("y = most").select(F.col("doc_id").alias("label_id"), "y")


def _seen(docs: DataFrame, doc_id: str, text: str) -> list[Column]:
    """What both views are made of, by working names."""
    have = set(docs.columns)
    meta = [(col(c).cast(t) if c in have else F.lit(None).cast(t)).alias(f"_{c}") for c, t in (("lang", "string"), ("source", "string"), ("n_chars", "double"))]
    return [col(text).alias("_text"), *meta, _half(col(doc_id) if doc_id in have else F.lit(None)).alias("_half")]


def fit_evidence(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, fit_rows: int = FIT_ROWS) -> Evidence:
    """Evidence tables from the training fold's labelled documents."""
    seen = docs.select(col(doc_id).alias("doc_id"), *_seen(docs, doc_id, text))
    n_sources = seen.agg(F.approx_count_distinct("_source")).first()[0]
    slots = min(1 << 20, max(256, 1 << math.ceil(math.log2(8 * n_sources + 1))))
    own = _clear(labels).filter(~_holds(F.col("label_id"))).orderBy(F.xxhash64("label_id"), "label_id").limit(fit_rows)
    rows = seen.join(F.broadcast(own), F.col("doc_id") == F.col("label_id")).select("_text", "_source", "_half", F.col("y").cast("int").alias("y"))  # fit_rows ids
    width = SLOTS + slots + 1  # documents with a word, with a source, and all of them, by half and label

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(4 * width, np.int64)
        for batch in batches:
            for piece in tokens.pieces(batch.column(0)):
                cut = lambda k: batch.column(k).slice(piece.lo, piece.hi - piece.lo)  # noqa: B023, E731
                kind = 2 * cut(2).to_numpy() + (cut(3).to_numpy() > 0)
                pair = np.unique(np.concatenate([(doc << 16) | slot for doc, slot in word_slots(piece)]))
                at = [kind[pair >> 16] * width + (pair & 0xFFFF), kind * width + SLOTS + source_slots(cut(1), slots), kind * width + width - 1]
                total += np.bincount(np.concatenate(at), minlength=4 * width)
        at = np.flatnonzero(total)
        for lo in range(0, len(at), 1 << 16):
            part = at[lo : lo + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(total[part])], names=["at", "n"])

    got = rows.mapInArrow(run, "at int, n bigint").groupBy("at").agg(F.sum("n").alias("n")).toArrow()  # at most 4 x width numbers
    count = np.zeros(4 * width)
    count[got["at"].to_numpy()] = got["n"].to_numpy()
    count = count.reshape(2, 2, width)
    share = np.log((count[:, :, :-1] + 1) / (count[:, :, -1:] + 2))
    ratio = (share[:, 1] - share[:, 0]).astype(np.float32)
    return Evidence(ratio[:, :SLOTS], ratio[:, SLOTS:])


def feature_rows(docs: DataFrame, evidence: Evidence, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, text_view, meta_view)`` per row."""
    kind = docs.select(col(doc_id)).schema[0].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(evidence)  # two tables of bounded size
    rows = docs.select(col(doc_id).alias("doc_id"), *_seen(docs, doc_id, text))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t, m, lo, hi in _views(batch, 1, shared.value):
                lists = lambda x: pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1], x.ravel())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), lists(t), lists(m)], names=["doc_id", "text_view", "meta_view"])

    return rows.mapInArrow(run, f"doc_id {kind}, text_view array<float>, meta_view array<float>")


def _views(batch: pa.RecordBatch, at: int, evidence: Evidence) -> Iterator[tuple[np.ndarray, np.ndarray, int, int]]:
    """Both views of a batch whose columns from ``at`` are text, lang, source, n_chars, half."""
    for piece in tokens.pieces(batch.column(at)):
        *own, half = [batch.column(at + k).slice(piece.lo, piece.hi - piece.lo) for k in (1, 2, 3, 4)]
        half = half.to_numpy()
        yield np.hstack([text_features(piece), evidence.word_features(piece, half)]), meta_features(*own, half, evidence), piece.lo, piece.hi


def _sums(table: DataFrame, one) -> np.ndarray:
    """The sum over all rows of the vectors that ``one(text, meta, y, fold)`` gives for a batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            view = lambda k, width: batch.column(k).flatten().to_numpy().reshape(n, width).astype(float)  # noqa: B023, E731
            y = batch.column(2).cast(pa.float64()).to_numpy(zero_copy_only=False)  # no label: nan
            got = one(view(0, TEXT_FEATURES), view(1, META_FEATURES), y, batch.column(3).to_numpy(zero_copy_only=False).astype(bool))
            total = got if total is None else total + got
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total)], names=["at", "value"])

    rows = table.select("text_view", "meta_view", "y", "holds").mapInArrow(run, "at int, value double").groupBy("at").agg(F.sum("value").alias("value"))
    got = rows.toArrow()
    out = np.zeros(got.num_rows)
    out[got["at"].to_numpy()] = got["value"].to_numpy()
    return out


def _step_parts(x: np.ndarray, y: np.ndarray, weight: np.ndarray, w: np.ndarray) -> np.ndarray:
    p = _sigmoid(x @ w)
    return np.concatenate([x.T @ (weight * (y - p)), ((x * (weight * p * (1 - p))[:, None]).T @ x).ravel()])


def _stepped(parts: np.ndarray, w: np.ndarray, ridge: float) -> np.ndarray:
    d = len(w)
    penalty = ridge * np.append(np.ones(d - 1), 1e-3)
    step = np.linalg.solve(parts[d : d + d * d].reshape(d, d) + np.diag(penalty), parts[:d] - penalty * w)
    return w + step * min(1.0, STRIDE / max(np.abs(step).max(), 1e-12))  # saturated rows have no curvature: no leaps


def fit(table: DataFrame) -> Model:
    """Co-train on ``table(text_view, meta_view, y, holds)``; ``holds`` marks the calibration fold."""

    def moments(t, m, y, holds):
        known = ~np.isnan(y)
        return np.concatenate([[len(t), known.sum(), np.nansum(y), (known & holds).sum(), np.nansum(y[holds])], t.sum(0), (t**2).sum(0), m.sum(0), (m**2).sum(0)])

    s = _sums(table, moments)
    if not len(s) or s[1] == 0 or not 0 < s[2] < s[1]:
        return Model(constant=1.0 if not len(s) or s[1] == 0 else float(s[2] / s[1]))
    model, at = Model(), 5
    for d in (TEXT_FEATURES, META_FEATURES):
        mean = s[at : at + d] / s[0]
        model.center.append(mean)
        model.scale.append(np.sqrt(np.maximum(s[at + d : at + 2 * d] / s[0] - mean**2, 1e-8)))
        model.weights.append(np.zeros(d + 1))
        at += 2 * d
    folded = 0 < s[4] < s[3]  # the calibration fold shows both classes; else all labelled rows calibrate
    sizes = [TEXT_FEATURES + 1, META_FEATURES + 1]
    cut = sizes[0] + sizes[0] ** 2

    for round_ in range(ROUNDS + 1):
        teachers = [w.copy() for w in model.weights] if round_ else None

        def parts(t, m, y, holds, model=model, teachers=teachers):
            xs, known = [model.inputs(0, t), model.inputs(1, m)], ~np.isnan(y)
            out = []
            for view in (0, 1):
                target, weight = np.where(known, y, 0.0), (known & ~(holds & folded)).astype(float)
                if teachers is not None:
                    p = _sigmoid(xs[1 - view] @ teachers[1 - view])
                    sure = ~known & ((p >= CONFIDENT) | (p <= 1 - CONFIDENT))
                    target, weight = np.where(sure, p >= 0.5, target), np.where(sure, PSEUDO_WEIGHT, weight)
                out.append(_step_parts(xs[view], target, weight, model.weights[view]))
            return np.concatenate(out)

        for _ in range(STEPS if round_ else FIRST_STEPS):
            s = _sums(table, parts)
            model.weights = [_stepped(s[:cut], model.weights[0], RIDGE), _stepped(s[cut:], model.weights[1], RIDGE)]

    for _ in range(STEPS + 2):

        def platt(t, m, y, holds):
            use = (~np.isnan(y) & (holds | (not folded))).astype(float)
            return np.concatenate([_step_parts(np.stack([model.odds(v, x), np.ones(len(x))], 1), np.nan_to_num(y), use, model.platt[v]) for v, x in ((0, t), (1, m))])

        s = _sums(table, platt)
        model.platt = [_stepped(s[:6], model.platt[0], 0.1), _stepped(s[6:], model.platt[1], 0.1)]
    for _ in range(STEPS + 2):

        def mix(t, m, y, holds):
            use = (~np.isnan(y) & (holds | (not folded))).astype(float)
            z = np.stack([model.calibrated(0, t), model.calibrated(1, m), np.ones(len(t))], 1)
            return _step_parts(z, np.nan_to_num(y), use, model.mix)

        model.mix = _stepped(_sums(table, mix), model.mix, 0.1)
    return model


def training_table(docs: DataFrame, labels: DataFrame, evidence: Evidence, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Features of every row with its label or null, written once."""
    rows = feature_rows(docs, evidence, doc_id, text).join(_clear(labels), F.col("doc_id") == F.col("label_id"), "left").drop("label_id")
    return written(rows.withColumn("holds", _holds(F.col("doc_id"))), "quality-features")


def scored(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, text_score, meta_score, score, kept)`` per row of ``docs``."""
    spark = docs.sparkSession
    ship_package(spark)
    table = training_table(docs, labels, fit_evidence(docs, labels, doc_id, text), doc_id, text)
    shared = spark.sparkContext.broadcast(fit(table))
    kind = table.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            n = batch.num_rows
            t, m = (batch.column(k).flatten().to_numpy().reshape(n, w).astype(float) for k, w in ((1, TEXT_FEATURES), (2, META_FEATURES)))
            s = model.score(t, m)
            own = [np.full(n, np.nan)] * 2 if model.constant is not None else [_sigmoid(model.calibrated(0, t)), _sigmoid(model.calibrated(1, m))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, own), pa.array(s), pa.array(s >= KEEP)], names=["doc_id", "text_score", "meta_score", "score", "kept"])

    out = f"doc_id {kind}, text_score double, meta_score double, score double, kept boolean"
    return table.select("doc_id", "text_view", "meta_view").mapInArrow(run, out)


def keep_good(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not rejected, all columns as they were.

    The model is applied to the texts in the same pass that filters them: no
    join by id, so rows with null or repeated ids are judged by themselves.
    """
    spark = docs.sparkSession
    ship_package(spark)
    evidence = fit_evidence(docs, labels, doc_id, text)
    shared = spark.sparkContext.broadcast((fit(training_table(docs, labels, evidence, doc_id, text)), evidence))
    names = [f"_c{i}" for i in range(len(docs.columns))]
    plain = docs.select(*[col(c).alias(n) for c, n in zip(docs.columns, names)], *_seen(docs, doc_id, text))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, evidence = shared.value
        for batch in batches:
            keep = [model.score(t.astype(float), m.astype(float)) >= KEEP for t, m, _, _ in _views(batch, len(names), evidence)]
            if keep:
                yield batch.select(range(len(names))).filter(pa.array(np.concatenate(keep)))

    return plain.mapInArrow(run, plain.select(*names).schema).toDF(*docs.columns)
