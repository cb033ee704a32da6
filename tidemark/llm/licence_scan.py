"""Licence scans by matching statistics over a generalised suffix automaton.

The words of all licence phrases and templates (A-Z lower-cased; a word is a
run of 0-9, a-z and characters from U+0080 up) become one suffix automaton,
built on the driver and broadcast: it grows with the templates, never with the
files, and ``MAX_TEMPLATE_WORDS`` bounds it. Files are streamed through it.
After each word the automaton's state and length give the longest run of words
that ends there and stands in some template: the matching statistics.

* A phrase stands at a word if its own state lies on the state's suffix-link
  path and the run is long enough. Every such place counts.
* A run of ``min_match`` words or more that cannot be extended is a long match
  with every template place of its state. Per template, long matches that
  advance in file and template and lie at most ``max_gap`` words apart are
  chained for the most covered template words. A chain that covers
  ``min_share`` of its template's words is a span, and labels the file.

A file in which no two consecutive words stand consecutively in a template
keeps a statistic of at most one word, so those places are told apart by
arrays (word keys are compared in full, not by a hash) and only the rest is
walked. Long files are cut at word ends into windows of about ``WINDOW`` bytes
with the state carried over: beside the text itself and what matches in it,
memory is bounded by a window. There is no shuffle.

Defined cases: a null text is an empty one: no words, no places (``first_word``
and ``last_word`` null), no labels, score 0. Null, repeated and extra columns do
not matter: one result row per input row; only the key and the text are read.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import col, ship_package
from .licence_texts import PHRASES, TEMPLATES
from .tokens import text_buffers

MIN_MATCH = 4
MIN_SHARE = 0.9
MAX_GAP = 20
WINDOW = 1 << 19
MAX_TEMPLATE_WORDS = 1_000_000

_WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
_IS_WORD = np.zeros(256, bool)
_IS_WORD[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[0x41:0x5B] += 32


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.translate(_LOWER))


class Vocabulary:
    """Word bytes -> id, for arrays of words; keys are compared in full."""

    def __init__(self, vocabulary: Sequence[str]):
        raw = [w.encode() for w in vocabulary]
        self.width = 8 * max(1, -(-max(map(len, raw), default=1) // 8))
        keys = np.array([list(w.ljust(self.width, b"\0")) for w in raw], np.uint8).reshape(len(raw), self.width).view("<u8")
        self.lengths = np.zeros(self.width + 1, bool)
        self.lengths[[len(w) for w in raw]] = True
        for seed in range(100):  # multipliers under which no two words share a sum
            self.odd = np.random.default_rng(seed).integers(0, 2**63, keys.shape[1], dtype=np.uint64) * np.uint64(2) + np.uint64(1)
            sums = (keys * self.odd).sum(1, dtype=np.uint64)
            if len(np.unique(sums)) == len(raw):
                break
        else:
            raise ValueError("no multipliers found")
        self.ids = np.argsort(sums)
        self.sums, self.keys = sums[self.ids], keys[self.ids]

    def look_up(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Word ids, -1 for others; ``data`` is folded and has ``width`` bytes after the last word."""
        out = np.full(len(starts), -1, np.int32)
        size = ends - starts
        at = np.flatnonzero(self.lengths[np.minimum(size, self.width)] & (size <= self.width))
        if not len(at) or not len(self.ids):
            return out
        inside = np.arange(self.width)
        letters = data[starts[at][:, None] + inside] * (inside < size[at][:, None])
        keys = np.ascontiguousarray(letters).view("<u8")
        place = np.minimum(np.searchsorted(self.sums, (keys * self.odd).sum(1, dtype=np.uint64)), len(self.ids) - 1)
        same = (self.keys[place] == keys).all(1)
        out[at[same]] = self.ids[place[same]]
        return out


class Automaton:
    """A generalised suffix automaton over word ids, with its phrases and template places."""

    def __init__(self, phrases: Mapping[str, str], templates: Mapping[str, Sequence[str]]):
        self.phrases = [(words_of(p), label) for p, label in phrases.items()]
        self.templates = [(words_of(t), label) for label, texts in templates.items() for t in texts]
        if any(len(p) < 2 for p, _ in self.phrases):
            raise ValueError("a phrase has at least two words")
        texts = [w for w, _ in self.phrases + self.templates]
        if sum(map(len, texts)) > MAX_TEMPLATE_WORDS:
            raise ValueError(f"templates of more than {MAX_TEMPLATE_WORDS} words: the automaton would not fit a broadcast")
        numbers: dict[str, int] = {}
        coded = [[numbers.setdefault(w, len(numbers)) for w in t] for t in texts]
        self.vocabulary = Vocabulary(list(numbers))
        self.size = len(numbers)
        self.pairs = np.unique(np.array([a * self.size + b for t in coded for a, b in zip(t, t[1:])], np.int64))
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        for t in coded:
            last = 0
            for c in t:
                last = self._extend(last, c)
        self._settle(coded)

    def _state(self, length: int, after: dict[int, int], link: int) -> int:
        self.next.append(after)
        self.link.append(link)
        self.length.append(length)
        return len(self.link) - 1

    def _split(self, p: int, c: int, q: int) -> int:
        """The part of state ``q`` that is as long as ``p`` and one more word."""
        short = self._state(self.length[p] + 1, dict(self.next[q]), self.link[q])
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = short
            p = self.link[p]
        self.link[q] = short
        return short

    def _extend(self, last: int, c: int) -> int:
        q = self.next[last].get(c)
        if q is not None:  # stands in an earlier template
            return q if self.length[q] == self.length[last] + 1 else self._split(last, c, q)
        new = self._state(self.length[last] + 1, {}, 0)
        p = last
        while p >= 0 and c not in self.next[p]:
            self.next[p][c] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][c]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, c, q)
        return new

    def _settle(self, coded: list[list[int]]) -> None:
        """Where each state's runs end in the templates, and the phrases on its suffix-link path."""
        own: list[list[tuple[int, int]]] = [[] for _ in self.link]
        named: list[list[tuple[int, int]]] = [[] for _ in self.link]
        for k, t in enumerate(coded):
            state = 0
            for end, c in enumerate(t, 1):
                state = self.next[state][c]
                if k >= len(self.phrases):
                    own[state].append((k - len(self.phrases), end))
            if k < len(self.phrases):
                named[state].append((k, len(t)))
        self.own = own
        self.below: list[list[int]] = [[] for _ in self.link]
        self.named: list[tuple[tuple[int, int], ...]] = [()] * len(self.link)
        for state in sorted(range(1, len(self.link)), key=self.length.__getitem__):
            self.below[self.link[state]].append(state)
            self.named[state] = (*self.named[self.link[state]], *named[state])
        self._places: dict[int, list[tuple[int, int]]] = {}

    def places(self, state: int) -> list[tuple[int, int]]:
        """(template, end) of every place where the state's runs stand."""
        if state not in self._places:
            found, todo = [], [state]
            while todo:
                s = todo.pop()
                found += self.own[s]
                todo += self.below[s]
            self._places[state] = sorted(found)
        return self._places[state]

    def step(self, state: int, length: int, c: int) -> tuple[int, int]:
        """State and matching statistic after one more word."""
        while state and c not in self.next[state]:
            state = self.link[state]
            length = self.length[state]
        after = self.next[state].get(c)
        return (after, length + 1) if after is not None else (0, 0)


class File:
    """What one file has shown so far: word count, phrase places and long matches."""

    def __init__(self):
        self.words = self.places = 0
        self.tail = -1  # id of the last word
        self.first = self.last = None
        self.named: set[int] = set()
        self.matches: list[tuple[int, int, int]] = []  # (word after the last, length, state)
        self.state = self.length = 0
        self.end = 0  # word after the run that state and length stand for

    def read(self, auto: Automaton, word: int, state: int, length: int) -> None:
        self.state, self.length, self.end = state, length, word + 1
        for phrase, size in auto.named[state]:
            if size <= length:
                self.places += 1
                start = word + 1 - size
                self.first = start if self.first is None else min(self.first, start)
                self.last = start if self.last is None else max(self.last, start)
                self.named.add(phrase)

    def close_run(self, min_match: int) -> None:
        if self.length >= min_match:
            self.matches.append((self.end, self.length, self.state))


def window_into(auto: Automaton, files: list[File], data: np.ndarray, offsets: np.ndarray, min_match: int) -> None:
    """Stream one window, the bytes ``offsets[i]`` to ``offsets[i + 1]`` of each file, whole words only."""
    size = len(data)
    word = _IS_WORD[data]
    inner = offsets[(offsets > 0) & (offsets < size)]
    begins, stops = word.copy(), word.copy()
    begins[1:] &= ~word[:-1]
    stops[:-1] &= ~word[1:]
    begins[inner] = word[inner]
    stops[inner - 1] = word[inner - 1]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    padded = np.zeros(size + auto.vocabulary.width, np.uint8)
    np.take(_FOLD, data, out=padded[:size])
    ids = auto.vocabulary.look_up(padded, starts, ends)
    first = np.searchsorted(starts, offsets)  # file -> its first word
    before = np.full(len(ids), -1, np.int64)
    before[1:] = ids[:-1]
    base = np.zeros(len(files), np.int64)
    for i, f in enumerate(files):
        if first[i] < first[i + 1]:
            before[first[i]] = -1
            if f.words and f.end == f.words:  # the last word of the window before stands in the vocabulary
                before[first[i]] = f.tail
        base[i] = f.words - first[i]
    pair = before * auto.size + ids
    known = np.flatnonzero((before >= 0) & (ids >= 0))
    if len(auto.pairs):
        place = np.minimum(np.searchsorted(auto.pairs, pair[known]), len(auto.pairs) - 1)
        known = known[auto.pairs[place] == pair[known]]
    else:
        known = known[:0]
    of = np.searchsorted(first, known, "right") - 1
    for at, i, c, prev in zip(known.tolist(), of.tolist(), ids[known].tolist(), before[known].tolist()):
        f = files[i]
        w = at + int(base[i])
        if f.end != w or not f.length:  # a run begins with the word before
            f.close_run(min_match)
            f.state, f.length = auto.step(0, 0, prev)
            f.end = w
        state, length = auto.step(f.state, f.length, c)
        if length != f.length + 1:
            f.close_run(min_match)
        f.read(auto, w, state, length)
    for i, f in enumerate(files):
        if first[i] < first[i + 1]:
            f.words += int(first[i + 1] - first[i])
            f.tail = int(ids[first[i + 1] - 1])
            if f.tail >= 0 and f.end != f.words:
                f.close_run(min_match)
                f.state, f.length = auto.step(0, 0, f.tail)
                f.end = f.words


def streamed(auto: Automaton, texts: pa.Array, min_match: int = MIN_MATCH, window: int = WINDOW) -> Iterator[File]:
    """Each text's ``File``, in order."""
    raw, offsets = text_buffers(texts)
    n, lo = len(texts), 0
    while lo < n:
        hi = max(lo + 1, min(int(np.searchsorted(offsets, offsets[lo] + window, "right")) - 1, lo + 60_000, n))
        files = [File() for _ in range(hi - lo)]
        start, end = int(offsets[lo]), int(offsets[hi])
        if hi > lo + 1 or end - start <= window:
            window_into(auto, files, raw[start:end], offsets[lo : hi + 1] - start, min_match)
        else:
            while start < end:
                stop = min(start + window, end)
                while stop < end and _IS_WORD[raw[stop - 1]]:  # a word is not cut
                    tail = np.flatnonzero(~_IS_WORD[raw[stop : stop + window]])
                    stop = min(stop + (int(tail[0]) + 1 if len(tail) else window), end)
                window_into(auto, files, raw[start:stop], np.array([0, stop - start]), min_match)
                start = stop
        for f in files:
            f.close_run(min_match)
            yield f
        lo = hi


@dataclass
class Span:
    """A chain of long matches: words [first, last] of the file, and how many template words it covers."""

    template: int
    first: int
    last: int
    covered: int


def chains(matches: list[tuple[int, int, int, int]], max_gap: int) -> list[tuple[int, int, int]]:
    """(covered words, first word, last word) of disjoint chains of one template's matches, most covered first.

    A match is (file end, template end, length). A match may follow another if
    it ends later in both and the words skipped between them are at most
    ``max_gap`` in file and template; words that both hold count once. So a
    match is compared only with those that end within its own words and
    ``max_gap`` before it.
    """
    matches = sorted(matches)
    best, back = [], []
    for k, (end, t_end, size) in enumerate(matches):
        score, prev = size, -1
        for j in range(k - 1, -1, -1):
            e, t, _ = matches[j]
            if end - size - e > max_gap:
                break  # ends only fall from here on
            if e == end or t >= t_end or t_end - size - t > max_gap:
                continue
            new = min(size, end - e, t_end - t)
            if best[j] + new > score:
                score, prev = best[j] + new, j
        best.append(score)
        back.append(prev)
    used = [False] * len(matches)
    out: list[tuple[int, int, int]] = []
    taken: list[tuple[int, int]] = []
    for k in sorted(range(len(matches)), key=lambda k: (-best[k], matches[k])):
        path, j = [], k
        while j >= 0 and not used[j]:
            path.append(j)
            j = back[j]
        if j >= 0 or not path:
            continue  # a part of a chain already told
        first, last = min(matches[j][0] - matches[j][2] for j in path), matches[k][0] - 1
        if all(last < a or first > b for a, b in taken):
            out.append((best[k], first, last))
            taken.append((first, last))
        for j in path:
            used[j] = True
    return out


def spans(auto: Automaton, found: File, max_gap: int) -> list[Span]:
    """Chains of every template that a long match of the file touches."""
    per = defaultdict(list)
    for end, size, state in found.matches:
        for template, t_end in auto.places(state):
            per[template].append((end, t_end, size))
    return [Span(t, first, last, covered) for t in sorted(per) for covered, first, last in chains(per[t], max_gap)]


_SPAN = "struct<label:string,template:int,first_word:bigint,last_word:bigint,covered:int,share:double>"


def scan(
    docs: DataFrame,
    key: str | Column = "doc_id",
    text: str = "text",
    phrases: Mapping[str, str] = PHRASES,
    templates: Mapping[str, Sequence[str]] = TEMPLATES,
    min_match: int = MIN_MATCH,
    min_share: float = MIN_SHARE,
    max_gap: int = MAX_GAP,
) -> DataFrame:
    """Per row: ``(key, n_words, n_base, first_word, last_word, base_labels, labels, spans, score)``.

    ``spans`` holds the chains that cover at least ``min_share`` of their
    template (label, template number, first and last word in the file, covered
    words, share of the template's words); ``labels`` those labels and the
    phrases', distinct and sorted. ``score`` is 1 - (1 - c)(1 - b/2): c the
    largest share that any chain of the file covers, b 1 if a phrase stands in
    it; a phrase alone gives 0.5.
    """
    spark = docs.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(Automaton(phrases, templates))  # bounded by MAX_TEMPLATE_WORDS
    rows = docs.select((col(key) if isinstance(key, str) else key).alias("key"), col(text).cast("string").alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    span_type = pa.list_(pa.struct([("label", pa.string()), ("template", pa.int32()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("covered", pa.int32()), ("share", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        auto = shared.value
        for batch in batches:
            out = {k: [] for k in ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "spans", "score")}
            for f in streamed(auto, batch.column(1), min_match):
                told = spans(auto, f, max_gap)
                size = [len(auto.templates[s.template][0]) for s in told]
                share = [min(1.0, s.covered / n) for s, n in zip(told, size)]
                base = sorted({auto.phrases[k][1] for k in f.named})
                kept = [(s, x) for s, x in zip(told, share) if x >= min_share]
                out["n_words"].append(f.words)
                out["n_base"].append(f.places)
                out["first_word"].append(f.first)
                out["last_word"].append(f.last)
                out["base_labels"].append(base)
                out["labels"].append(sorted({*base, *(auto.templates[s.template][1] for s, _ in kept)}))
                out["spans"].append([
                    {"label": auto.templates[s.template][1], "template": s.template, "first_word": s.first, "last_word": s.last, "covered": s.covered, "share": x}
                    for s, x in kept
                ])
                out["score"].append(1 - (1 - max(share, default=0.0)) * (0.5 if f.places else 1.0))
            kinds = [pa.int64()] * 4 + [pa.list_(pa.string())] * 2 + [span_type, pa.float64()]
            arrays = [pa.array(v, t) for v, t in zip(out.values(), kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names=["key", *out])

    return rows.mapInArrow(
        run,
        f"key {kind}, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels array<string>, labels array<string>, spans array<{_SPAN}>, score double",
    )


def digest(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """The flat form: label lists joined by commas, the number of spans instead of the spans."""
    joined = lambda c: F.array_join(c, ",").alias(c)
    return found.select(
        F.col("key").alias(key), "n_words", "n_base", "first_word", "last_word", joined("base_labels"), joined("labels"), "score", F.size("spans").alias("n_spans")
    )
