"""Licence scan, whitening and fill-in-middle against brute force, and their edge cases."""

import hashlib
import random
import re
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import fim, licence_scan, licence_texts, queries, whitening

from .conftest import DOCS, SF_SMALL

# ---- licence scan -----------------------------------------------------------------------------

PHRASES = {"a b": "ab", "b c d": "bcd", "d d": "dd"}
TEMPLATES = {"one": ("a b c d e f g h", "h g f e d"), "two": ("c d e f x y z", "a b a b a b c d"), "three": ("d d d a",)}


def _plain_words(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text))


def _statistics(words, texts):
    """Longest run of words ending at each place that stands in one of the texts, by trying all."""
    runs = {tuple(t[i:j]) for t in texts for i in range(len(t)) for j in range(i + 1, len(t) + 1)}
    return [max((n for n in range(1, i + 2) if tuple(words[i + 1 - n : i + 1]) in runs), default=0) for i in range(len(words))]


def _long_matches(words, phrases, templates, least):
    texts = [_plain_words(t) for t in [*phrases, *(t for ts in templates.values() for t in ts)]]
    stats = _statistics(words, texts) + [0]
    return [(i + 1, n) for i, n in enumerate(stats[:-1]) if n >= least and stats[i + 1] != n + 1]


def _random_text(r, n):
    return " ".join(r.choice("abcdefghxyz") if r.random() < 0.9 else r.choice(["other", "É", "q1", "B"]) for _ in range(n))


def _seen(auto, texts, window=1 << 19, least=3):
    return list(licence_scan.streamed(auto, pa.array(texts, pa.string()), least, window))


@pytest.mark.parametrize("window", [1 << 19, 40, 7])
def test_matching_statistics_and_phrases_equal_trying_all(window):
    r = random.Random(3)
    texts = [_random_text(r, r.randrange(0, 120)) for _ in range(150)] + ["a b c d e f g h", "", None, "a", "ab", "D d D-d"]
    auto = licence_scan.Automaton(PHRASES, TEMPLATES)
    for text, got in zip(texts, _seen(auto, texts, window)):
        words = _plain_words(text or "")
        assert got.words == len(words)
        assert [(e, n) for e, n, _ in got.matches] == _long_matches(words, PHRASES, TEMPLATES, 3)
        starts = [(i, k) for k, p in enumerate(PHRASES) for i in range(len(words)) if words[i : i + len(p.split())] == p.split()]
        assert got.places == len(starts) and got.named == {k for _, k in starts}
        assert (got.first, got.last) == ((min(starts)[0], max(starts)[0]) if starts else (None, None))
        for end, n, state in got.matches:  # every template place of a long match, and no other
            run = words[end - n : end]
            want = [(k, j) for k, (t, _) in enumerate(auto.templates) for j in range(n, len(t) + 1) if t[j - n : j] == run]
            assert auto.places(state) == want


def _best_chain(matches, max_gap):
    """Most covered words of any chain, by trying all of them."""
    def follow(path, covered):
        best = covered
        end, t_end, _ = path[-1]
        for m in matches:
            e, t, n = m
            if e > end and t > t_end and e - n - end <= max_gap and t - n - t_end <= max_gap:
                best = max(best, follow([*path, m], covered + min(n, e - end, t - t_end)))
        return best

    return max((follow([m], m[2]) for m in matches), default=0)


def test_chains_cover_as_much_as_any():
    r = random.Random(5)
    for _ in range(200):
        matches = list({(e := r.randrange(3, 40), t := r.randrange(3, 20), r.randrange(1, min(e, t) + 1)) for _ in range(r.randrange(0, 8))})
        got = licence_scan.chains(matches, 6)
        assert max((c for c, _, _ in got), default=0) == _best_chain(matches, 6)
        assert all(b1 < a2 or b2 < a1 for i, (_, a1, b1) in enumerate(got) for _, a2, b2 in got[:i])


def test_licences_are_found_whole_edited_and_twice(spark):
    mit, gpl = licence_texts.TEMPLATES["mit"][2], licence_texts.TEMPLATES["gpl-3.0"][1]
    filler = " ".join(f"code{i}" for i in range(300))
    edited = mit.split()
    edited[60:62] = ["entirely", "new"]
    rows = [
        (1, f"{filler}\n{mit}\n{filler}"), (2, f"{filler} {' '.join(edited)}"), (3, f"{gpl} {filler} {gpl}"),
        (4, "This work is licensed under the GNU General Public License, version 3."), (5, "Licensed under CC BY-NC 4.0."),
        (6, " ".join(mit.split()[:60])), (7, filler), (8, mit.upper().replace(" ", "\n// ")), (9, "licensed under the GNU General Public License, version 4"),
    ]
    got = {r["key"]: r for r in licence_scan.scan(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    labels = {k: r["labels"] for k, r in got.items()}
    assert labels == {1: ["mit"], 2: ["mit"], 3: ["gpl", "gpl-3.0"], 4: ["gpl", "gpl-3.0"], 5: ["cc-by", "cc-by-nc-4.0"], 6: [], 7: [], 8: ["mit"], 9: ["gpl"]}
    assert [s["first_word"] for s in got[1]["spans"]] == [300] and got[1]["spans"][0]["share"] == 1.0 and got[1]["score"] == 1.0
    size = len(_plain_words(mit))
    assert got[1]["spans"][0]["last_word"] == 300 + size - 1 and got[2]["spans"][0]["covered"] == size - 2
    assert sorted(s["first_word"] for s in got[3]["spans"]) == [0, len(_plain_words(gpl)) + 300] and got[3]["n_base"] == 4
    assert 0.2 < got[6]["score"] < 0.9 and got[7]["score"] == 0.0


def test_base_places_of_the_given_documents(spark):
    """All places of the phrases, counted with a regular expression over the words."""
    got = {r["doc_id"]: r for r in queries.op11_license_scan(spark, SF_SMALL).collect()}
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    for d in docs:
        words = _plain_words(d["text"] or "")
        at = [(i, label) for p, label in licence_texts.PHRASES.items() for i in range(len(words)) if words[i : i + len(p.split())] == p.split()]
        r = got[d["doc_id"]]
        assert (r["n_words"], r["n_base"]) == (len(words), len(at))
        assert (r["first_word"], r["last_word"]) == ((min(at)[0], max(at)[0]) if at else (None, None))
        assert r["base_labels"] == ",".join(sorted({x for _, x in at})) and set(r["base_labels"].split(",")) <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1


def test_licence_edges(spark, edges, empty):
    got = licence_scan.scan(edges).collect()
    assert len(got) == edges.count()
    for r in got:
        if r["n_words"] == 0:
            assert (r["n_base"], r["first_word"], r["labels"], r["spans"], r["score"]) == (0, None, [], [], 0.0)
    assert licence_scan.digest(licence_scan.scan(empty)).count() == 0
    long = "the MIT license " * 200_000  # nothing but places, across many windows
    r = licence_scan.scan(spark.createDataFrame([(1, long)], "doc_id bigint, text string")).first()
    assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"]) == (600_000, 200_000, 1, 599_998)
    with pytest.raises(ValueError):
        licence_scan.Automaton({"word": "x"}, {})
    assert not licence_scan.scan(edges, phrases={}, templates={}).filter("score > 0 or n_base > 0").count()


# ---- whitening --------------------------------------------------------------------------------


def _spread(n, dims, seed=1, scale=1.0):
    r = np.random.default_rng(seed)
    turn = np.linalg.qr(r.normal(size=(dims, dims)))[0]
    return (r.normal(size=(n, dims)) * np.linspace(1, 3, dims) * scale) @ turn


def _vectors(spark, rows, kind="float"):
    return spark.createDataFrame(rows, f"vec_id bigint, embedding array<{kind}>, label int")


def test_whitening_equals_brute_force(spark):
    data = _spread(700, 12).astype(np.float32)
    rows = [(i, [float(c) for c in v], 0) for i, v in enumerate(data)]
    rows += [(1000, None, 1), (1001, [1.0] * 11 + [None], 1), (1002, [1.0] * 11 + [float("nan")], 1), (1003, [float("inf")] * 12, 1), (1004, [1.0, 2.0], 1), (None, rows[5][1], 1)]
    got = whitening.components(whitening.whiten(_vectors(spark, rows))).collect()
    used = [(r[0], r[1]) for r in rows if r[0] is None or r[0] < 1000]
    x = np.array([[int(np.floor(1024 * c)) + 100_000 for c in v] for _, v in used])
    n, total = len(x), x.sum(0)
    assert len(got) == 8 * n and {r["n"] for r in got} == {n}
    covariance = np.cov(x.T.astype(float), bias=True)
    values, axes = np.linalg.eigh(covariance)
    values, axes = values[::-1], axes[:, ::-1]
    white = (x - total / n) @ axes[:, :8] / np.sqrt(values[:8])
    by = {}
    for r in got:
        by.setdefault(r["vec_id"], {})[r["component"]] = r
    for k in range(8):
        mine = np.array([by[i][k + 1]["whitened"] for i, _ in used])
        sign = np.sign(mine @ white[:, k])
        assert np.abs(mine - sign * white[:, k]).max() < 1e-9
        assert by[3][k + 1]["explained"] == pytest.approx(values[k] / values.sum(), rel=1e-12)
    for (i, _), row in zip(used, x):
        assert by[i][1]["deviation"] == sum((n * int(c) - int(s)) ** 2 for c, s in zip(row, total))
    assert all(r["identity_error"] < 1e-12 for r in got)


def test_sums_are_exact_for_great_numbers():
    r = np.random.default_rng(2)
    y = r.integers(-(2**51), 2**51, size=(5000, 3))
    got = whitening.products(y)
    for i in range(3):
        for j in range(3):
            assert got[i, j] == sum(int(a) * int(b) for a, b in zip(y[:, i], y[:, j]))
    rest = [7, 0, 3]
    want = [sum((11 * int(v) - k) ** 2 for v, k in zip(row, rest)) for row in y[:50]]
    assert [int(d) for d in whitening._deviations(y[:50], 11, rest).to_pylist()] == want
    assert whitening._deviations(y[:1], 10**12, rest).to_pylist() == [None]  # beyond 38 digits


def _exact_residual(a, values, vectors):
    """Largest entry of A v - l v, in whole arithmetic."""
    worst = 0.0
    rows = [[Fraction(float(c)) for c in row] for row in a]
    for value, vector in zip(values, vectors):
        v = [Fraction(float(c)) for c in vector]
        for i, row in enumerate(rows):
            worst = max(worst, abs(float(sum(p * q for p, q in zip(row, v)) - Fraction(float(value)) * v[i])))
    return worst


@pytest.mark.parametrize("values", [
    [9, 7, 5, 4, 3, 2, 1, 0.5],
    [9, 9 * (1 - 1e-9), 5, 5 * (1 + 1e-11), 5 * (1 - 1e-10), 2, 2, 1e-6],  # clusters far below what float32 can part
    [4] * 8,
    [1, 1e-12, 1e-13, 0, 0, 0, 0, 0],
])
def test_refined_vectors_reach_double_precision(values):
    turn = np.linalg.qr(np.random.default_rng(7).normal(size=(8, 8)))[0]
    a = (turn * np.array(values, float)) @ turn.T
    a = (a + a.T) / 2
    got, vectors = whitening.eigen(a)
    wide = vectors.astype(np.longdouble)
    assert np.abs(wide @ wide.T - np.eye(8)).max() < 4e-16
    assert _exact_residual(a, got, vectors) < 4e-15 * max(values)
    assert np.abs(got - np.linalg.eigvalsh(a)[::-1]).max() < 1e-14 * max(values)
    rough = np.linalg.eigh(a.astype(np.float32))
    if len(set(values)) == 8 and min(values) > 1e-3:
        assert _exact_residual(a, rough[0][::-1], rough[1].T[::-1].astype(float)) > 1e-8  # single precision alone does not


def test_clustered_vectors_are_parted_by_their_own_problem():
    """Gaps of 1e-9: the vectors, not just their space, come out right."""
    turn = np.linalg.qr(np.random.default_rng(9).normal(size=(6, 6)))[0].astype(np.longdouble)
    turn = turn @ (1.5 * np.eye(6) - 0.5 * (turn.T @ turn))
    values = np.array([3, 3 + 1e-9, 3 - 1e-9, 1, 1 + 1e-8, 0.2], np.longdouble)
    a = (turn * values) @ turn.T
    _, rough = np.linalg.eigh(a.astype(np.float32))
    found, x, rounds = whitening.refine(a, rough)
    order, want = np.argsort(found), np.argsort(values)
    alike = np.abs((x[:, order] * turn[:, want]).sum(0).astype(float))
    assert np.abs(alike - 1).max() < 1e-12 and rounds <= 8


def test_whitening_edges(spark):
    none = whitening.components(whitening.whiten(_vectors(spark, []))).collect()
    assert none == []
    one = whitening.components(whitening.whiten(_vectors(spark, [(1, [0.5, 0.25], 0)]))).collect()
    assert [(r["component"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in one] == [(1, 0, None, 0.0, None), (2, 0, None, 0.0, None)]
    flat = [(i, [float(i % 7), 2.0, 3.0], 0) for i in range(50)] * 2  # two dimensions without variance, repeated rows
    clash = _vectors(spark, flat, "double").withColumns({c: F.lit(1) for c in ("key", "x", "v", "i", "n", "total")})
    got = whitening.components(whitening.whiten(clash)).collect()
    assert len(got) == 300 and all((r["whitened"] is None) == (r["component"] > 1) for r in got)
    assert all(r["identity_error"] < 1e-12 for r in got) and max(r["explained"] for r in got) == pytest.approx(1.0)
    wide = whitening.whiten(_vectors(spark, [(i, [float(10**9 * (i % 5)), float(i)], 0) for i in range(40)], "double")).collect()
    x = np.array([[1024 * 10**9 * (i % 5), 1024 * i] for i in range(40)], object)
    total = x.sum(0)
    for r in wide:
        assert r["deviation"] == Decimal(sum((40 * int(c) - int(s)) ** 2 for c, s in zip(x[r["key"]], total)))


def test_the_given_embeddings_are_white(spark):
    got = queries.op12_embedding_whitening(spark, SF_SMALL)
    n = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").count()
    cells = {r["component"]: [] for r in got.select("component").distinct().collect()}
    for r in got.collect():
        cells[r["component"]].append(r["whitened"])
        assert r["n"] == n and 0 <= r["identity_error"] <= 1e-4
    white = np.array([sorted(cells[k]) for k in sorted(cells)])
    assert white.shape == (8, n) and np.abs(white.mean(1)).max() < 1e-9 and np.abs(white.var(1) - 1).max() < 1e-9


# ---- fill in the middle -----------------------------------------------------------------------


def _units(text):
    return re.findall(r"[A-Za-z]+|[^A-Za-z]", text)


def test_the_skip_list_reaches_every_rank():
    r = random.Random(8)
    for size in (0, 1, 2, 3, 17, 400):
        text = "".join(r.choice(["word", "a", " ", "é", "😀", "7", "\n", "ß", "Zz"]) for _ in range(size))
        units = _units(text)
        for window in (1 << 20, 5, 1):
            built = fim.read_units(np.frombuffer(text.encode(), np.uint8), window).build()
            assert built.size == len(units)
            assert [built.point(k) for k in range(len(units) + 1)] == [len("".join(units[:k])) for k in range(len(units) + 1)]


def test_express_lanes_carry_sums_and_shorten_the_way():
    text = "ab 1" * 50_000
    built = fim.read_units(np.frombuffer(text.encode(), np.uint8)).build()
    assert len(built.lanes) > 5
    for (units, points, _), (up_units, up_points, up) in zip(built.lanes, built.lanes[1:]):
        assert 0.15 < len(up) / len(units) < 0.6 or len(units) < 200
        assert up_units.sum() == units.sum() == built.size and up_points.sum() == points.sum() == len(text)
    followed = 0

    class Counted(np.ndarray):
        def __getitem__(self, k):
            nonlocal followed
            followed += 1
            return super().__getitem__(k)

    built.lanes = [(u.view(Counted), p, d) for u, p, d in built.lanes]
    for rank in range(0, built.size, 997):
        built.point(rank)
    assert followed / len(range(0, built.size, 997)) < 150  # of 150,000 units


def _by_hand(key, text):
    text = text or ""
    units = _units(text)
    h = [int(hashlib.sha256(f"1:{'' if key is None else key}".encode()).hexdigest()[8 * k : 8 * k + 8], 16) for k in range(4)]
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return len(units), "plain", None, None, text
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < 20:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_transformation_by_hand_and_back(spark, edges, empty):
    r = random.Random(4)
    rows = [(k, "".join(r.choice(["<", "P", ">", "S", "M", "<P", "x", " ", "é", "😀", "\n", "\r", "\\"]) for _ in range(r.randrange(0, 60)))) for k in range(400)]
    rows += [(None, "null key"), (7, "a <M> b"), (8, "x" * 300_000), (9, "́‍" * 2000)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").unionByName(edges.select("doc_id", "text"))
    texts = [(d["doc_id"], d["text"]) for d in df.collect()]
    done = fim.transform(df).withColumn("again", fim.restored(F.col("output"), F.col("form")))
    got = sorted(((x["key"], x["n"], x["form"], x["prefix_chars"], x["middle_chars"], x["output"], x["again"]) for x in done.collect()), key=repr)
    want = sorted(((k, *_by_hand(k, t), t or "") for k, t in texts), key=repr)
    assert got == want and {g[2] for g in got} == {"plain", "psm", "spm"}
    assert fim.transform(empty).count() == 0
    assert fim.transform(edges).count() == edges.count()  # columns that clash with working names
