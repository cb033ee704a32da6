"""Near-dedup, suffix dedup and embedding dedup against brute force, with edge cases."""

import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import embedding_dedup, near_dedup, suffix_dedup, tokens
from tidemark.llm.common import components

from .conftest import DOCS, words


def _classes(links, nodes):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        parent[root(a)] = root(b)
    out = {}
    for n in nodes:
        out.setdefault(root(n), set()).add(n)
    return {n: min(g) for g in out.values() for n in g}


def test_components_of_chains_stars_and_cycles(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + k) for k in range(1, 30)] + [(200, 201), (201, 202), (202, 200), (300, 300)]
    got = {r["id"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == _classes(links, {x for p in links for x in p})
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def _family(seed, n, copies, edits):
    base, out = words(seed, n), []
    for k in range(copies):
        own = list(base)
        for e in range(edits[k % len(edits)]):
            own[(seed + 31 * k + 17 * e) % n] = f"edit{k}x{e}"
        out.append(" ".join(own))
    return out


def _by_hand(texts):
    """Each text's shingles and weights, counted with plain Python: count times 1 + ln(N / df) / ln(N + 1)."""
    grams = [Counter(zip(*(t.lower().split()[k:] for k in range(5)))) for t in texts]
    df, n = Counter(g for own in grams for g in own), len(texts)
    return [{g: c * (1 + math.log(n / df[g]) / math.log(n + 1)) for g, c in own.items()} for own in grams]


def _alike(a, b):
    low = sum(min(w, b[g]) for g, w in a.items() if g in b)
    return low / (sum(a.values()) + sum(b.values()) - low) if a and b else 0.0


def test_shingle_frequencies_are_exact(spark, monkeypatch):
    texts = [" ".join(words(7, 40) + words(100 + k, 30, 50)) for k in range(60)] + [None, "", "a b c d", "a b c d e", "a b c d e"]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(texts)], DOCS).repartition(5)
    monkeypatch.setattr(near_dedup, "BLOCK", 2000)
    found = near_dedup.document_frequencies(docs)
    hand = _by_hand([t or "" for t in texts])
    for t, own in zip(texts, hand):
        h, w = near_dedup._weighted(pa.array([t], pa.string()), found)
        assert len(h) == len(own) and np.allclose(sorted(w), sorted(own.values()), rtol=1e-6)
    some = near_dedup.document_frequencies(docs, frequent=36)  # room for the shingles of the common part only
    assert len(some.h) == 36 and np.allclose(some.idf, 1 + math.log(65 / 60) / math.log(66))
    assert some.rest == near_dedup.Weights(some.h, some.idf, 4, 65).rest < found.rest
    none = near_dedup.document_frequencies(docs.limit(0))
    assert len(none.h) == 0 and np.isfinite(none.rest)


def test_near_copies_at_and_above_the_threshold_are_found(spark):
    """Planted edits: of the pairs in each range of weighted Jaccard similarity, at least nine tenths share a class."""
    texts, r = [], np.random.default_rng(80)
    for k in range(240):
        own = words(3000 + k, 200, 5000)
        copy = list(own)
        for at in r.choice(200, 2 + k % 3, replace=False):
            copy[at] = f"edit{k}x{at}"
        texts += [" ".join(own), " ".join(copy)]
    vectors = _by_hand(texts)
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(texts)], DOCS)
    got = {x["doc_id"]: x["class_id"] for x in near_dedup.near_classes(docs).select("row.doc_id", "class_id").collect()}
    for least, most in ((0.8, 0.82), (0.84, 0.87), (0.88, 0.92)):
        pairs = [k for k in range(0, len(texts), 2) if least <= _alike(vectors[k], vectors[k + 1]) <= most]
        assert len(pairs) >= 20 and sum(got[k] == got[k + 1] for k in pairs) >= 0.9 * len(pairs)


def test_near_dedup_equals_brute_force(spark):
    texts = []
    for f in range(6):
        texts += _family(40 + f, 90 + 40 * f, 30, (0, 1, 2, 3, 5, 8))
    texts += [" ".join(words(900 + k, 60 + k)) for k in range(40)] + [texts[1], texts[1], texts[50]]
    passage = " ".join(words(77, 40))
    texts += [passage + " " + " ".join(words(1500 + k, 80)) for k in range(30)]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(texts)], DOCS)
    got = {r["doc_id"]: (r["class_id"], r["kept"]) for r in near_dedup.near_classes(docs).select("row.doc_id", "class_id", "kept").collect()}
    vectors = _by_hand(texts)
    links = [(i, j) for i in range(len(texts)) for j in range(i) if texts[i] == texts[j] or _alike(vectors[i], vectors[j]) >= 0.8]
    want = _classes(links, range(len(texts)))
    assert {i: c for i, (c, _) in got.items()} == want
    assert {i for i, (_, k) in got.items() if k} == set(want.values())


def test_consistent_weighted_samples_estimate_weighted_jaccard():
    a, b = _family(3, 400, 2, (0, 12))
    one = near_dedup.Weights(np.zeros(0, np.uint64), np.zeros(0), 2, 1)
    sampler, found = near_dedup.Sampler(samples=1024), []
    for t in (a, b):
        h, w = near_dedup._weighted(pa.array([t]), one)
        found.append(sampler.sample(h, w, np.array([0]))[0])
    exact = near_dedup.weighted_jaccard(near_dedup._weighted(pa.array([a]), one), near_dedup._weighted(pa.array([b]), one))
    assert abs((found[0] == found[1]).mean() - exact) < 0.06


@pytest.mark.parametrize("likely", [5.0, 0.02])
def test_samples_are_the_smallest_of_all_draws(monkeypatch, likely):
    """As drawn for every shingle, though at the usual first bound under a fifth of the draws are computed; at a
    bound that few texts reach, too."""
    monkeypatch.setattr(near_dedup, "LIKELY", likely)
    sampler, r = near_dedup.Sampler(), np.random.default_rng(11)
    sizes = np.array([1, 2, 700, 1, 400, 5, 900, 30, 300, 600])
    h = r.integers(0, 2**48, sizes.sum(), dtype=np.uint64)
    weight = r.integers(1, 4, len(h)) * np.exp(r.normal(0, 1, len(h))).astype(np.float32)
    log_w, first, want = np.log(weight).astype(np.float32), np.cumsum(sizes) - sizes, []
    for odd in sampler.odd:
        slot = ((h * odd) >> np.uint64(48)).astype(np.int64)
        level = np.floor(log_w * sampler.inv_r[slot] + sampler.beta[slot])
        draws = sampler.log_c[slot] - sampler.r[slot] * (level - sampler.beta[slot] + np.float32(1))
        at = np.array([lo + int(np.argmin(draws[lo : lo + n])) for lo, n in zip(first, sizes)])
        want.append(tokens.mix(h[at] * np.uint64(0x9E3779B97F4A7C15) + level[at].astype(np.int64).astype(np.uint64)))
    computed, draws_of = [], near_dedup.Sampler._draws
    monkeypatch.setattr(near_dedup.Sampler, "_draws", lambda self, slot, log_w, at: computed.append(len(at)) or draws_of(self, slot, log_w, at))
    assert np.array_equal(sampler.sample(h, weight, first), np.column_stack(want))
    assert likely < 5 or sum(computed) < len(h) * len(sampler.odd) / 5


def test_texts_to_compare_are_shingled_together(monkeypatch):
    texts = [" ".join(words(60 + k, 20 + k)) for k in range(50)] + ["", "a b c", "a b c d e a b c d e"]
    table = near_dedup.Weights(np.zeros(0, np.uint64), np.zeros(0), 2, 53)
    alone = [near_dedup._weighted(pa.array([t]), table) for t in texts]
    calls, sets = [], near_dedup._sets
    monkeypatch.setattr(near_dedup, "_sets", lambda piece: calls.append(1) or sets(piece))
    for df in (None, [near_dedup.planes_packed(np.arange(2, 2 + len(h), dtype=np.uint32)) for h, _ in alone if len(h)]):
        held = [k for k, (h, _) in enumerate(alone) if df is None or len(h)]  # texts without a shingle carry no frequencies
        column = pa.array(["x", *[texts[k] for k in held]]).slice(1)
        got = list(near_dedup._vectors(column, pa.array(df or [None] * len(texts), pa.binary()), table))
        assert len(got) == len(held)
        for (h, w), (own, plain) in zip(got, [alone[k] for k in held]):
            assert np.array_equal(h, own) and np.array_equal(w, plain if df is None else plain / table.rest * table.own(np.arange(2, 2 + len(h))))
    assert len(calls) == 2


def test_a_tile_of_one_block_holds_each_text_once(spark, monkeypatch):
    """Links of a bucket's members that are apart, found from one row a text and tile."""
    texts = _family(71, 80, 6, (0, 0, 30, 1, 30, 2))
    rows = [(1, bytes([k]), bytes([k]), k > 0, len(texts)) for k in range(len(texts))]
    placed = spark.createDataFrame(rows, "bucket long, key binary, comp binary, apart boolean, members long")
    own = spark.createDataFrame([(bytes([k]), t, None) for k, t in enumerate(texts)], "key binary, text string, df binary")
    table = near_dedup.Weights(np.zeros(0, np.uint64), np.zeros(0), 2, 6)
    dealt, repartition = [], type(placed).repartition
    monkeypatch.setattr(type(placed), "repartition", lambda df, *by: dealt.append(df) or repartition(df, *by))
    links = near_dedup._tile_links(spark, placed, own, table, 0.8).collect()
    vectors = [near_dedup._weighted(pa.array([t]), table) for t in texts]
    want = [(bytes([i]), bytes([j])) for i in range(6) for j in range(i) if near_dedup.weighted_jaccard(vectors[i], vectors[j]) >= 0.8]
    nodes = [bytes([k]) for k in range(6)]
    assert _classes([(r["a"], r["b"]) for r in links], nodes) == _classes(want, nodes) and 0 < len(want) < 15
    assert len(dealt) == 1 and dealt[0].count() == len(texts)


def test_near_dedup_edges(spark, edges, empty):
    got = near_dedup.near_classes(edges).collect()
    assert len(got) == edges.count()
    same = [r for r in got if r["row"]["text"] == got[0]["row"]["text"] or r["row"]["doc_id"] in (1, 2)]
    ones = [r for r in got if r["row"]["doc_id"] in (1, 2) or (r["row"]["doc_id"] is None and r["row"]["text"])]
    assert {r["class_id"] for r in ones} == {1} and len(same) >= 3
    assert [r["row"]["doc_id"] for r in ones if r["kept"]] == [1]
    assert all(r["kept"] for r in got if r["row"]["text"] is None)
    left = near_dedup.keep_one(edges)
    assert left.columns == edges.columns
    assert left.count() == edges.count() - 3  # the text of ids 1, 2, 2 and null once
    assert near_dedup.near_classes(empty).count() == 0
    twice = spark.createDataFrame([(None, "a b c d e f", "en", "s", 1)] * 3, DOCS)
    assert near_dedup.keep_one(twice).count() == 1


def _covered(texts, length=50):
    lists = {i: t.lower().split() for i, t in texts.items()}
    owners = {}
    for i, ws in lists.items():
        for k in range(len(ws) - length + 1):
            owners.setdefault(tuple(ws[k : k + length]), set()).add(i)
    out = {}
    for i, ws in lists.items():
        for k in range(len(ws) - length + 1):
            if len(owners[tuple(ws[k : k + length])]) > 1:
                out.setdefault(i, set()).update(range(k, k + length))
    return out


def test_suffix_dedup_equals_brute_force(spark):
    texts = {i: " ".join(words(10 + i, 150 + 7 * i)) for i in range(30)}
    for k, n in enumerate((49, 50, 51, 60, 140, 300)):  # passages shared by three texts each, at other places
        passage = words(500 + k, n)
        for j in range(3):
            own = texts[3 * k + j].split()
            own[20 + 13 * j : 20 + 13 * j] = passage
            texts[3 * k + j] = " ".join(own)
    texts[40], texts[41] = texts[25], texts[25].upper()
    texts[42] = " ".join(words(999, 60) * 3)  # repeats itself only
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in texts.items()], DOCS)
    have = {}
    for r in suffix_dedup.repeated_passages(docs).collect():
        have.setdefault(r["doc_id"], set()).update(range(r["from_word"], r["to_word"]))
    assert have == _covered(texts)


def test_suffix_dedup_of_a_common_phrase_equals_brute_force(spark):
    """A tail phrase in more than 100 texts, some pairs of which share the words before it too, and a passage repeated in one text."""
    texts = {}
    for k, n in enumerate((10, 15, 20, 25, 30, 40, 49)):
        phrase = words(700 + k, n)
        for j in range(120):
            before = words(800 + 1000 * k + (j % 60 if j % 60 < 5 else j), 50 - n + j % 3, 5000)  # texts j and j + 60 share some of it
            texts[1000 * k + j] = " ".join(words(9000 + 500 * k + j, 20, 5000) + before + phrase + words(20000 + 500 * k + j, 60, 5000))
    passage = words(31, 60)
    texts[9000] = " ".join(w for k in range(20) for w in passage + words(32 + k, 5, 5000))
    texts[9001] = " ".join(words(60, 30, 5000) + passage + words(61, 30, 5000))
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in texts.items()], DOCS)
    have = {}
    for r in suffix_dedup.repeated_passages(docs).collect():
        have.setdefault(r["doc_id"], set()).update(range(r["from_word"], r["to_word"]))
    want = _covered(texts)
    assert len(want) > 40 and {9000, 9001} <= set(want)
    assert have == want


def test_suffix_dedup_edges(spark, edges, empty):
    got = suffix_dedup.repeated_passages(edges).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"], r["from_word"], r["to_word"]) for r in got) == [
        (False, 1, 0, 120), (False, 2, 0, 120), (False, 2, 0, 120), (True, None, 0, 120),
    ]
    assert suffix_dedup.repeated_passages(empty).count() == 0


def test_tokens_split_like_the_definition():
    import re

    texts = ["", "  ", "a", "A b\tC\n", "x\x0by\x0cz", "É é", None, "end", "nospace" * 50, " lead", "trail "]
    got = []
    for p in tokens.pieces(pa.array(texts), limit=8):
        got += [bytes(p.data[a:b]).decode() for a, b in zip(p.starts, p.ends)]
        assert p.first[-1] == len(p.hashes)
    want = [w for t in texts for w in re.findall(r"[^\x20\x09-\x0D]+", t or "")]
    assert got == want
    one, two = (next(tokens.pieces(pa.array([t]), 1 << 20)).hashes for t in ("Ab cd Ab", "xx AB cd"))
    assert one[0] == one[2] == two[1] and one[1] == two[2] and one[0] != one[1]


@pytest.mark.parametrize("dim", [3, 64])
def test_embedding_dedup_equals_brute_force(spark, dim):
    r = np.random.default_rng(dim)
    x = r.normal(size=(300, dim))
    x[100:180] = x[:80] + 0.35 * r.normal(size=(80, dim)) * np.linalg.norm(x[:80], axis=1, keepdims=True) / np.sqrt(dim)
    x[200:210] = x[0] * r.uniform(0.1, 1e6, (10, 1))
    x[210:230] = x[1]
    rows = [(i, [float(v) for v in row]) for i, row in enumerate(x)]
    rows += [(300, None), (301, []), (302, [0.0] * dim), (303, [float("nan")] * dim), (304, [float("inf")] + [1.0] * (dim - 1)), (305, [None] + [1.0] * (dim - 1)), (306, [1.0] * (dim + 1)), (306, [1.0] * (dim + 1))]
    got = embedding_dedup.classes(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")).collect()
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.9
    np.fill_diagonal(near, False)
    want = _classes(list(zip(*np.nonzero(near))), range(300))
    have = {g["vec_id"]: g for g in got if g["vec_id"] < 300}
    assert {i: g["n_links"] for i, g in have.items()} == {i: int(near[i].sum()) for i in range(300)}
    assert {i: g["component_id"] for i, g in have.items()} == {i: int(c) for i, c in want.items()}
    assert all(g["kept"] == (g["vec_id"] == g["component_id"]) for g in got)
    assert [(g["n_links"], g["component_id"]) for g in sorted(got, key=lambda g: g["vec_id"]) if g["vec_id"] >= 300] == [(0, i) for i in range(300, 306)] + [(1, 306)] * 2
    assert embedding_dedup.classes(spark.createDataFrame([], "vec_id bigint, embedding array<float>, turned int")).count() == 0


def test_a_dense_cluster_needs_bounded_memory_and_no_pair_list(spark):
    """5,000 near-equal vectors of 384 dimensions, some of them at the threshold: all pairs are open to the end."""
    import tracemalloc

    r = np.random.default_rng(12)
    n, dim = 5000, 384
    x = r.normal(size=dim) + r.normal(size=(n, dim)) * r.uniform(0.05, 0.6, (n, 1))
    x = x.astype(np.float32)
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    axes = np.linalg.eigh(unit.T @ unit)[1][:, ::-1]
    turned = unit @ axes
    tracemalloc.start()
    i, j = embedding_dedup._linked(x[:2048].astype(float), x[2048:4096].astype(float), turned[:2048], turned[2048:4096], 0.9)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    near = unit @ unit.T >= 0.9
    assert len(i) == near[:2048, 2048:4096].sum() > 10**6 and near[:2048, 2048:4096][i, j].all()
    assert peak < 300 << 20
    np.fill_diagonal(near, False)
    rows = [(k, [float(v) for v in row]) for k, row in enumerate(x)]
    got = embedding_dedup.classes(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").repartition(4)).collect()
    assert {g["vec_id"]: g["n_links"] for g in got} == {k: int(c) for k, c in enumerate(near.sum(1))}
    want = _classes([(0, int(k)) for k in np.flatnonzero(near[0])] + [(int(a), int(near[a].argmax())) for a in range(n) if near[a].any()], range(n))
    assert {g["vec_id"]: g["component_id"] for g in got} == want


def test_boxes_drop_tiles_before_vectors_move(spark, tmp_path_factory, monkeypatch):
    """Clusters apart on the leading axes: of the tiles between neighbouring cells only those whose boxes can hold a link stay."""
    r = np.random.default_rng(5)
    centres = r.normal(size=(12, 3))
    x = np.concatenate([np.column_stack([c + 0.01 * r.normal(size=(60, 3)), 0.01 * r.normal(size=(60, 13))]) for c in centres])
    kept = {}
    monkeypatch.setattr(embedding_dedup, "written", lambda df, name, f=embedding_dedup.written: kept.setdefault(name, f(df, name)))
    rows = [(k, [float(v) for v in row]) for k, row in enumerate(x)]
    got = {g["vec_id"]: g["n_links"] for g in embedding_dedup.classes(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")).collect()}
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = (unit @ unit.T >= 0.9).sum(1) - 1
    assert got == {k: int(c) for k, c in enumerate(near)}
    cells = kept["boxes"].select("name", "c0", "c1", "c2").collect()
    adjoining = sum(a["name"] <= b["name"] and max(abs(a[c] - b[c]) for c in ("c0", "c1", "c2")) <= 1 for a in cells for b in cells)
    assert kept["tile-pairs"].count() <= adjoining - 5


def test_rare_shingles_weigh_by_their_own_frequency(spark, monkeypatch):
    """Without room for a single shingle in the broadcast table, classes are those of exact weights."""
    texts = []
    for f in range(8):
        texts += _family(240 + f, 60 + 30 * f, 12, (0, 4, 5, 6, 7, 9))
    texts += [" ".join(words(2900 + k, 60 + k)) for k in range(20)] + [texts[1], None, None, "", "a b c"]
    # 170 shingles shared, 20 apart on each side: 0.81 alike if all weigh alike, 0.798 by their own frequencies
    a = len(texts)
    texts += [" ".join(words(3100, 174, 90_000) + words(3101 + k, 20, 90_000)) for k in range(2)]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(texts)], DOCS).repartition(3)
    monkeypatch.setattr(near_dedup, "BLOCK", 3000)
    monkeypatch.setattr(near_dedup, "BUCKET", 5000)
    classes = lambda: {r["doc_id"]: (r["class_id"], r["kept"]) for r in near_dedup.near_classes(docs).select("row.doc_id", "class_id", "kept").collect()}
    broadcast = classes()
    monkeypatch.setattr(near_dedup, "FREQUENT", 0)
    assert classes() == broadcast and broadcast[a][0] != broadcast[a + 1][0]
    vectors = _by_hand([t or "" for t in texts])
    links = [(i, j) for i in range(len(texts)) for j in range(i) if texts[i] is not None and (texts[i] == texts[j] or _alike(vectors[i], vectors[j]) >= 0.8)]
    assert {i: c for i, (c, _) in broadcast.items()} == _classes(links, range(len(texts)))
