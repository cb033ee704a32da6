"""Fill-in-middle transformation, cut by an indexable skip list.

A text is a sequence of units: runs of ASCII letters, and every other code
point by itself. Two cut ranks, drawn from the document's key, part it into
prefix, middle and suffix. The ranks count units, the cuts are made at code
points, so a text's units are kept in an indexable skip list: on each lane a
link carries how many units and how many code points it leads over. The bottom
lane links every unit to the next one; a unit's tower is as high as a hash of
its number says (a quarter of a lane's units reach the next lane), and an
express lane's link has the widths of the links below it, added up.
``SkipList.point`` goes along the highest lane while the accumulated units do
not pass the rank, then down: some 4 log4(n) links to a cut, which is reached
exactly.

A text is read as UTF-8 bytes in windows of ``WINDOW``, appended to the list;
beside text and output a text takes some 15 bytes for each of its units while
its list stands. There is no shuffle: each row is transformed by itself.

Defined cases: a null text is an empty one, and an empty text is ``plain`` with
0 units. A null key draws as the key ''. Repeated rows give repeated results.
Extra columns do not matter: only the key and the text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import col, ship_package
from .tokens import text_buffers

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN_PERCENT = 10  # of the texts stay plain
SPM_PERCENT = 20  # of the others put the suffix first
WINDOW = 1 << 20
_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
_LEAD = np.ones(256, bool)
_LEAD[0x80:0xC0] = False  # bytes that continue a code point


def _towers(start: int, stop: int) -> np.ndarray:
    """Heights of the units [start, stop), by their number's hash: a height of at least k has probability 4**-k."""
    h = np.arange(start, stop, dtype=np.uint64) + np.uint64(1)
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    height = np.zeros(len(h), np.uint8)
    up = np.arange(len(h))
    for k in range(32):
        up = up[(h[up] >> np.uint64(2 * k)) & np.uint64(3) == 0]
        if not len(up):
            break
        height[up] += 1
    return height


class SkipList:
    """An indexable skip list: append units by their code points, ``build`` the express lanes, ask ``point``."""

    def __init__(self):
        self.size = 0
        self._points: list[np.ndarray] = []
        self._heights: list[np.ndarray] = []
        #: per lane: units and code points of each link, and the link below its beginning
        self.lanes: list[tuple[np.ndarray, np.ndarray, np.ndarray | None]] = []

    def append(self, points: np.ndarray) -> None:
        """Units of these many code points come after the last one."""
        if len(points):
            self._heights.append(_towers(self.size, self.size + len(points)))
            self._points.append(points.astype(np.uint32))
            self.size += len(points)

    def widen(self, points: int) -> None:
        """The last unit goes on for ``points`` code points."""
        self._points[-1][-1] += points

    def build(self) -> SkipList:
        if not self.size:
            return self
        points, height = np.concatenate(self._points), np.concatenate(self._heights)
        units = np.ones(len(points), np.uint32)
        self._points, self._heights = [], []
        self.lanes = [(units, points, None)]
        while len(units) > 1:
            up = np.flatnonzero(height >= len(self.lanes))
            if not len(up) or up[0]:
                up = np.append(0, up)  # the head stands on every lane
            if len(up) == len(units):
                break
            units, points, height = np.add.reduceat(units, up), np.add.reduceat(points, up), height[up]
            self.lanes.append((units, points, up))
        return self

    def point(self, rank: int) -> int:
        """The code points before unit ``rank`` (0 to ``size``)."""
        unit = point = link = 0
        for units, points, down in reversed(self.lanes):
            while link < len(units) and unit + int(units[link]) <= rank:
                unit += int(units[link])
                point += int(points[link])
                link += 1
            if unit == rank:
                break
            if down is not None:
                link = int(down[link])
        return point


def read_units(data: np.ndarray, window: int = WINDOW) -> SkipList:
    """The units of a text's UTF-8 bytes, window by window."""
    found = SkipList()
    letter_before = False
    for start in range(0, len(data), window):
        part = data[start : start + window]
        letter, lead = _LETTER[part], _LEAD[part]
        begins = lead.copy()
        begins[1:] &= ~(letter[1:] & letter[:-1])
        begins[0] &= not (letter[0] and letter_before)
        at = np.flatnonzero(begins)
        head = int(np.count_nonzero(lead[: at[0]] if len(at) else lead))
        if head:
            found.widen(head)
        if len(at):
            found.append(np.add.reduceat(lead, at, dtype=np.uint32))
        letter_before = bool(letter[-1])
    return found


def _draws(key: Column) -> list[Column]:
    """The first four 32-bit numbers of the SHA-256 of ``1:`` and the key."""
    digest = F.sha2(F.concat(F.lit("1:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * k, 8), 16, 10).cast("long").alias(f"h{k + 1}") for k in range(4)]


def transform(docs: DataFrame, key: str | Column = "doc_id", text: str = "text", plain_percent: int = PLAIN_PERCENT, spm_percent: int = SPM_PERCENT) -> DataFrame:
    """Per row: ``(key, n, form, prefix_chars, middle_chars, output)``.

    With ``h1`` to ``h4`` the key's draws and ``n`` units, the prefix ends
    after the smaller of ``h1 % (n + 1)`` and ``h2 % (n + 1)`` units and the
    middle after the larger. ``form`` is ``plain`` (the text itself; the two
    numbers of code points are null) if the text is empty or holds a marker, or
    by ``h3``; else ``spm`` or ``psm`` by ``h4``.
    """
    ship_package(docs.sparkSession)
    key = col(key) if isinstance(key, str) else key
    source = F.coalesce(col(text).cast("string"), F.lit(""))
    h = _draws(key)
    marked = F.contains(source, F.lit(PREFIX)) | F.contains(source, F.lit(SUFFIX)) | F.contains(source, F.lit(MIDDLE))
    plain = (source == "") | marked | (h[2] % 100 >= 100 - plain_percent)
    form = F.when(plain, "plain").when(h[3] % 100 < spm_percent, "spm").otherwise("psm")
    rows = docs.select(key.alias("key"), source.alias("text"), form.alias("form"), h[0], h[1])
    kind = rows.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = text_buffers(batch.column(1))
            forms, h1, h2 = (batch.column(k).to_pylist() for k in (2, 3, 4))
            n, cuts, output = [], [], []
            for i, form in enumerate(forms):
                units = read_units(raw[offsets[i] : offsets[i + 1]])
                whole = raw[offsets[i] : offsets[i + 1]].tobytes().decode()
                n.append(units.size)
                if form == "plain":
                    cuts.append((None, None))
                    output.append(whole)
                    continue
                units.build()
                a, b = sorted((h1[i] % (units.size + 1), h2[i] % (units.size + 1)))
                a, b = units.point(a), units.point(b)
                cuts.append((a, b - a))
                prefix, middle, suffix = whole[:a], whole[a:b], whole[b:]
                output.append(f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}" if form == "psm" else f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}")
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), batch.column(2), *(pa.array(c, pa.int64()) for c in (tuple(zip(*cuts)) or ((), ()))), pa.array(output, pa.string())],
                names=["key", "n", "form", "prefix_chars", "middle_chars", "output"],
            )

    return rows.mapInArrow(run, f"key {kind}, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string")


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made from.

    A transformed text holds none of the markers, and no marker can overlap
    itself, so the first one found after its part is the one that was put in.
    """
    body = F.substring(output, len(PREFIX) + 1, 2**31 - 1)
    halves = F.split(body, F.when(form == "psm", SUFFIX).otherwise(PREFIX), 2)
    tail = F.split(halves[1], MIDDLE, 2)
    first, second, middle = halves[0], tail[0], tail[1]
    moved = F.when(form == "psm", F.concat(first, middle, second)).otherwise(F.concat(second, middle, first))
    return F.when(form == "plain", output).otherwise(moved)
