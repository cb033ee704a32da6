"""Quality, toxicity and language model: held-out accuracy, exact counts, edge cases."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import functions as F

from tidemark.llm import lm, quality, queries, tokens, toxicity

from .conftest import DOCS, SF_SMALL, words


def _auc(score, y):
    pairs = [(a > b) + 0.5 * (a == b) for a, p in zip(score, y) if p for b, q in zip(score, y) if not q]
    return sum(pairs) / len(pairs)


def _judged(spark, n=600):
    r = random.Random(4)
    docs, labels = [], []
    for i in range(n):
        bad, toxic = i % 5 == 0, i % 7 == 0
        ws = words(i, r.randrange(20, 120), 3000)
        if bad:
            ws = [w.upper() + "!!" for w in ws]
        if toxic:
            for k in range(r.randrange(1, 4)):
                ws[r.randrange(len(ws))] = ("zzgrubvik", "qupplorth", "xenthrombo")[k]
        docs.append((i, " ".join(ws), "en" if i % 3 else "fr", f"s{i % 4}", 100 + i))
        if i % 10 != 3:
            labels.append((i, int(not bad), int(toxic)))
    return spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")


def test_quality_tells_classes_it_was_not_fitted_on(spark):
    docs, labels = _judged(spark)
    got = {r["doc_id"]: r for r in quality.scored(docs, labels).collect()}
    unlabelled = [i for i in got if i % 10 == 3]
    assert _auc([got[i]["score"] for i in unlabelled], [i % 5 != 0 for i in unlabelled]) > 0.99 if any(i % 5 == 0 for i in unlabelled) else True
    held = [i for i in got if zlib.crc32(str(i).encode()) % 5 == 0]
    assert _auc([got[i]["score"] for i in held], [i % 5 != 0 for i in held]) > 0.99
    kept = quality.keep_good(docs, labels)
    assert {r["doc_id"] for r in kept.collect()} == {i for i, r in got.items() if r["kept"]}
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_quality_reads_the_words(spark):
    """Texts alike in every count: only their words tell, to documents that have no label too, and no label tells on itself."""
    r = random.Random(6)
    names = [[f"{a}{b}{c}" for b in "xyzuvw" for c in "klmnop"] for a in ("ga", "ba", "oa")]
    docs, labels = [], []
    for i in range(500):
        good = i % 2
        ws = [r.choice(names[1 - good] if r.random() < 0.2 else names[2]) for _ in range(60)]
        docs.append((i, " ".join(ws), "en", "s", 300))
        if i % 5 != 1:
            labels.append((i, good, 0))
    docs, labels = spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    got = [x for x in quality.scored(docs, labels).collect() if x["doc_id"] % 5 == 1]
    assert _auc([x["score"] for x in got], [x["doc_id"] % 2 for x in got]) > 0.97
    mixed = labels.withColumn("quality", F.pmod(F.xxhash64("doc_id"), F.lit(2)).cast("int"))  # labels that nothing tells
    blind = quality.scored(docs, mixed).join(mixed, "doc_id").collect()
    assert _auc([x["score"] for x in blind], [x["quality"] for x in blind]) < 0.75


def test_quality_evidence_of_hosts_follows_their_number(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("a b c").alias("text"), F.lit("en").alias("lang"), F.concat(F.lit("h"), F.col("id") % 1000).alias("source"), F.lit(5).alias("n_chars"))
    labels = spark.range(4000).select(F.col("id").alias("doc_id"), (F.col("id") % 1000 % 2).cast("int").alias("quality"))
    found = quality.fit_evidence(docs, labels, "doc_id", "text")
    assert found.sources.shape[1] >= 4000
    got = quality.scored(docs, labels.where("doc_id < 3000")).where("doc_id >= 3000").collect()
    assert _auc([x["score"] for x in got], [x["doc_id"] % 2 for x in got]) > 0.95  # a thousand hosts, told apart


def test_quality_edges(spark, edges, empty, labels):
    assert quality.scored(edges, labels).count() == edges.count()
    left = quality.keep_good(edges, labels)
    assert left.columns == edges.columns and left.schema == edges.schema or left.columns == edges.columns
    none = labels.limit(0)
    assert quality.keep_good(edges, none).count() == edges.count()  # no labels: nothing is rejected
    assert quality.scored(empty, labels).count() == 0 and quality.keep_good(empty, labels).count() == 0
    bare = edges.select("doc_id", "text")  # no metadata columns
    assert quality.scored(bare, labels).count() == edges.count()


def test_toxicity_on_the_held_out_fold(spark):
    docs, labels = _judged(spark)
    got = toxicity.score_documents(docs, labels, lm.fold(F.col("doc_id"), 3) == 1).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in got)
    held = [r for r in got if r["held_out"]]
    assert _auc([r["score"] for r in held], [r["doc_id"] % 7 == 0 for r in held]) > 0.97
    assert all(r["predicted"] == (r["score"] >= 0.7) for r in got)


def test_toxicity_never_sees_held_out_labels(spark):
    docs, labels = _judged(spark, 200)
    flipped = labels.withColumn("toxic", F.when(lm.fold(F.col("doc_id"), 3) == 1, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = (sorted((r["doc_id"], r["score"]) for r in toxicity.score_documents(docs, x, lm.fold(F.col("doc_id"), 3) == 1).collect()) for x in (labels, flipped))
    assert a == b


def test_toxicity_edges(spark, edges, empty, labels):
    for own in (labels, labels.limit(0)):
        got = toxicity.score_documents(edges, own, lm.fold(F.col("doc_id"), 3) == 1).collect()
        assert len(got) == edges.count() and all(0 <= r["score"] <= 1 for r in got)
    assert toxicity.score_documents(empty, labels, lm.fold(F.col("doc_id"), 3) == 1).count() == 0


def test_each_dictionary_is_trained_on_its_own_side():
    """Neither side's words are chosen by the other's counts, and the window's gain is what compression makes of them."""
    both = ["shared words stand here", "shared words stand there"]
    toxic, ordinary = [f"{t} zzgrubvik {i}" for i, t in enumerate(both)], [f"{t} plainfolk {i}" for i, t in enumerate(both)]
    a, b = toxicity.fit(toxic, ordinary), toxicity.fit(toxic, [*ordinary, "zzgrubvik once"])
    assert a.toxic == b.toxic and toxicity._spelt(b"shared") in a.toxic and toxicity._spelt(b"shared") in a.ordinary
    gain = dict(zip((b"shared", b"zzgrubvik", b"zzgrubviks", b"plainfolk", b"elsewhere"), toxicity.gains([b"shared", b"zzgrubvik", b"zzgrubviks", b"plainfolk", b"elsewhere"], a.compressors())))
    assert gain[b"zzgrubvik"] > gain[b"zzgrubviks"] > 4 and gain[b"plainfolk"] < -4  # a word known in part gains in part
    assert abs(gain[b"shared"]) <= 1 and gain[b"elsewhere"] == 0
    assert max(map(len, (a.toxic, a.ordinary))) <= max(toxicity.DICT_BYTES)


def test_toxicity_fits_on_bounded_bytes(spark):
    docs = spark.createDataFrame([(i, f"w{i:02d} " * (20_000 if i == 3 else 50), "en", "s", 0) for i in range(20)], DOCS)
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(20)], "doc_id bigint, quality int, toxic int")
    toxic, ordinary = toxicity.training_texts(docs, labels, F.lit(True), 6, "doc_id", "text", 1000)
    assert len(ordinary) == len(toxic) == 5 and max(map(len, toxic + ordinary)) == 200 and sum(map(len, toxic)) <= 1000
    whole = toxicity.training_texts(docs, labels, F.lit(True), 50, "doc_id", "text")
    assert [len(x) for x in whole] == [10, 10]


def _tokens(text):
    folded = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", folded) + [None]


def _base(rows):
    counts = Counter()
    for i, t in rows:
        if zlib.crc32(("" if i is None else str(i)).encode()) % 10:
            counts.update(_tokens(t))
    n, v = sum(counts.values()), len(counts)
    return counts, n, lambda ws: sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws)


def _check(got, rows):
    counts, n, base = _base(rows)
    want = sorted((i is None, i, len(_tokens(t)), sum(counts[w] > 0 for w in _tokens(t)), n, round(base(_tokens(t)), 6)) for i, t in rows)
    have = sorted((r["doc_id"] is None, r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in got)
    key = lambda x: (x[0], x[1] or 0, *x[2:])
    assert sorted(have, key=key) == sorted(want, key=key)


def test_base_score_is_exact(spark):
    got = queries.op8_lm_scoring(spark, SF_SMALL).collect()
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    _check(got, rows)
    held = [r for r in got if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)  # pairs help on unseen documents


def test_blocks_and_buckets_do_not_change_counts(spark, monkeypatch):
    docs = spark.createDataFrame([(i, " ".join(words(i, 200, 50)), "en", "s", 0) for i in range(60)], DOCS)
    a = sorted(map(tuple, lm.score_texts(docs.repartition(5), lm.fold(F.col("doc_id"), 10) == 0).collect()))
    b = sorted(map(tuple, lm.score_texts(docs.coalesce(1), lm.fold(F.col("doc_id"), 10) == 0).collect()))
    assert [x[:5] for x in a] == [x[:5] for x in b]
    assert np.allclose([x[5:] for x in a], [x[5:] for x in b])


def test_filter_levels_come_back():
    counts = np.array([1, 1, 2, 3, 4, 7, 30, 1000, 10**6, 2**40])
    levels = lm.quantised(counts)
    low = lm.restored(levels)
    assert (low <= counts).all() and (counts < 2**0.5 * low + 1).all() and list(low[:5]) == [1, 1, 2, 3, 4]
    keys = np.arange(1, 11, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    bits = np.frombuffer(lm.filled(keys, counts), np.uint8)
    assert (lm.probed(bits, keys) >= levels).all()  # a filter forgets nothing
    many, others = np.arange(1, 200_001, dtype=np.uint64), np.arange(10**6, 10**6 + 100_000, dtype=np.uint64)
    bits = np.frombuffer(lm.filled(many, np.ones(len(many), np.int64)), np.uint8)
    assert len(bits) * 8 < len(many) * (lm.ENTRY_BITS + 1)
    assert (lm.probed(bits, many) >= 1).all() and (lm.probed(bits, others) > 0).mean() < 0.01
    assert (lm.probed(np.frombuffer(lm.filled(many[:0], many[:0]), np.uint8), others) == 0).all()


def test_lm_edges(spark, edges, empty):
    got = lm.score_texts(edges, lm.fold(F.col("doc_id"), 10) == 0).collect()
    _check(got, [(r["doc_id"], r["text"]) for r in edges.collect()])
    assert all(math.isfinite(r["score"]) for r in got)
    assert lm.score_texts(empty, lm.fold(F.col("doc_id"), 10) == 0).count() == 0
    untrained = lm.score_texts(edges, F.lit(True)).collect()  # no training tokens: N = V = 0
    assert all(r["train_tokens"] == 0 and r["n_known"] == 0 and math.isfinite(r["base_score"]) for r in untrained)


def _exact_model(rows):
    """The score by exact pair counts, rounded down to their levels."""
    pairs, single = Counter(), Counter()
    for i, t in rows:
        if zlib.crc32(("" if i is None else str(i)).encode()) % 10:
            ws = _tokens(t)
            single.update(ws)
            pairs.update(zip([None, *ws], ws))
    n, v = sum(single.values()), len(single)

    def score(t):
        ws, out = _tokens(t), 0.0
        for u, w in zip([None, *ws], ws):
            c = int(lm.restored(lm.quantised(np.array([pairs[u, w]])))[0])
            p0 = (single[w] + 0.1) / (n + 0.1 * (v + 1))
            out += math.log10(min(1.0, (c + lm.MU * p0) / (single[u] + lm.MU)))
        return out

    return score, pairs


def test_lm_keeps_every_pair_seen_once_or_more(spark, monkeypatch):
    """Scores equal the model from exact pair counts, over several parts of the filter; most pairs are seen once."""
    monkeypatch.setattr(lm, "SEGMENT", 1 << 14)
    r = random.Random(8)
    texts = []
    for i in range(400):  # "of" precedes every second word: a hot context with thousands of successors
        own = [f"x{r.randrange(400_000)}" for _ in range(150)]
        texts += [" ".join(f"of {w}" for w in own)] * (2 if i % 5 == 0 else 1)
    rows = list(enumerate(texts))
    want, pairs = _exact_model(rows)
    assert sum(c == 1 for c in pairs.values()) > len(pairs) / 2
    asked = []
    monkeypatch.setattr(lm, "_probe", lambda shared, f=lm._probe: asked.append(len(shared.value)) or f(shared))
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], DOCS)
    off = [r["score"] - want(texts[r["doc_id"]]) for r in lm.score_texts(docs, lm.fold(F.col("doc_id"), 10) == 0).collect()]
    assert len(off) == len(rows) and min(off) > -1e-6 and np.abs(off).mean() / 301 < 0.01  # a filter's false positives only
    assert len(asked) >= 4 and set(asked) == {lm.PART}  # part after part, each of bounded size


def test_texts_that_occur_twice_score_apart(spark):
    """All but copies hold pairs of their own, seen once: a model that leaves those out could not tell them from twins."""
    r = random.Random(3)
    texts = [" ".join(f"w{r.randrange(3000)}" for _ in range(60)) for _ in range(500)]
    rows = [(i, t) for i, t in enumerate(texts + texts[:50])]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], DOCS)
    got = {x["doc_id"]: x["score"] - x["base_score"] for x in lm.score_texts(docs, F.lit(False)).collect()}
    once = sorted(got[i] for i in range(50, 500))
    assert sum(got[i] > once[int(0.95 * len(once))] for i in range(50)) > 45


def test_a_hot_context_is_dealt_over_all_segments():
    """One context before all words: its pairs lie evenly in the segments, and no probe sees a count."""
    words_ = np.unique(np.append(tokens.mix(np.arange(1, 20_001, dtype=np.uint64)), lm.END))
    number = np.full(40_000, 7)  # word 7 before each word, each such pair twice
    number[1::2] = np.tile(np.arange(0, 20_000, 2), 2)
    block = {"block": ["b"], "blob": [lm._packed(number.astype(np.uint32))], "words": [lm._packed(words_)], "lens": [[len(number)]], "held": [[False]], "ids": [[1]]}
    parts = pa.concat_tables([pa.Table.from_batches([b]) for b in lm._pairs(4)(pa.Table.from_pydict(block).to_batches())])
    sizes = [len(lm._unpacked(k, np.uint64)[0]) for k in parts["keys"].to_pylist()]
    assert len(sizes) == 16 and sorted(set(parts["part"].to_pylist())) == list(range(16 // lm.PART))
    assert min(sizes) > sum(sizes) / 16 / 1.3 and max(sizes) < sum(sizes) / 16 * 1.3
    for s in range(16):
        own = parts.filter(pa.compute.equal(parts["segment"], s))
        bits = np.frombuffer(lm._build(own)["bits"][0].as_py(), np.uint8)
        key = np.cumsum(lm._unpacked(own["keys"][0].as_py(), np.uint64)[0], dtype=np.uint64)
        count = lm._unpacked(own["counts"][0].as_py(), np.uint32)[0]
        assert (lm.probed(bits, key) >= lm.quantised(count)).all() and (lm.probed(bits, key) == lm.quantised(count)).mean() > 0.97
