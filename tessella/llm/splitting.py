"""Splitting oversized texts at natural boundaries.

Method: balanced targets.  The least number of pieces is computed, equally
spaced cut targets are placed, each target snaps to the strongest boundary
near it, and a piece is added whenever a limit cannot be held otherwise.

Everything is linear in the text.  Texts within the limit never leave the JVM.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from math import ceil

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Boundaries: line ends, sentence ends, and clause ends, which only a cut may use.
MARK = re.compile(r"(?P<line>\n)|(?P<sent>[。！？；]|[.!?;](?=\s))|(?P<clause>[，、：,:])")
CLOSERS = "”’」』）"
#: A blank line is stronger than a line end, that is stronger than a sentence end, and so on.
PARAGRAPH, LINE, SENTENCE, CLAUSE = 4, 3, 2, 1


class Boundaries:
    """Where a text may be cut, in ascending order, and its stretches between line and sentence ends."""

    def __init__(self, text: str):
        self.size = len(text)
        self.at: list[int] = []
        self.strength: list[int] = []
        #: Starts and ends of the line and sentence marks.
        self.starts: list[int] = []
        self.ends: list[int] = []
        line_end = None
        for m in MARK.finditer(text):
            start, end = m.span()
            kind = m.lastgroup
            if kind == "clause":
                place, strength = end, CLAUSE
            else:
                self.starts.append(start)
                self.ends.append(end)
                place, strength = end, SENTENCE
                if kind == "line":
                    strength = PARAGRAPH if line_end is not None and not text[line_end:start].strip() else LINE
                    line_end = end
            if kind != "line":
                while place < len(text) and text[place] in CLOSERS:
                    place += 1
                if place < len(text) and text[place] in " \t":
                    place += 1
            if self.at and self.at[-1] >= start:
                # Of marks in a row only the last is a place to cut, as strong as the strongest.
                place, strength = max(place, self.at.pop()), max(strength, self.strength.pop())
            self.at.append(place)
            self.strength.append(strength)

    def stretch(self, cut: int) -> int:
        """Length of the stretch between line or sentence ends that a cut lies in, marks not counted."""
        i = bisect_right(self.starts, cut - 1)
        begin = self.ends[i - 1] if i else 0
        finish = self.starts[i] if i < len(self.starts) else self.size
        return finish - begin if begin < cut < finish else 0


def cut_points(text: str, limit: int, overlap: int, seen: Boundaries | None = None) -> list[int]:
    """Ends of the pieces of ``text``; piece i runs from (end of i-1) - overlap to its end.

    No piece is longer than ``limit``.  A cut lies at a boundary wherever one
    is within reach of the piece; only otherwise it lies at the plain target.
    """
    size, step = len(text), limit - overlap
    if size <= limit:
        return [size]
    seen = seen or Boundaries(text)
    at, strength = seen.at, seen.strength
    left = max(2, ceil((size - overlap) / step))
    done, ends = 0, []
    while left > 1:
        reach = done + (step if ends else limit)
        if size <= reach:
            break
        # The rest must fit into the pieces that are left; if it can't, a piece is added.
        low = max(done + overlap + 1, size - (left - 1) * step)
        if low > reach:
            left += 1
            continue
        target = min(reach, max(low, done + round((size - done) / left)))
        window = max(1, (size - done) // (left * 4))
        best = None
        for a, b in ((max(low, target - window), min(reach, target + window)), (low, reach)):
            i, j = bisect_left(at, a), bisect_right(at, b)
            if i < j:
                best = max(range(i, j), key=lambda k: (strength[k], -abs(at[k] - target), -at[k]))
                break
        if best is None:
            # No boundary leaves the rest within its piece count: an earlier one costs a piece more.
            i, j = bisect_left(at, done + overlap + 1), bisect_right(at, reach)
            if i < j:
                best = j - 1
                left += 1
        cut = target if best is None else at[best]
        if cut >= size:
            break
        ends.append(cut)
        done = cut
        left -= 1
        if left <= 1 and size - done > step:
            left = ceil((size - done) / step)
            if left <= 1:
                left = 2
    ends.append(size)
    return ends


def pieces_of(text: str, limit: int, overlap: int) -> list[tuple[int, int]]:
    """(start, end) of every piece in code points."""
    ends = cut_points(text, limit, overlap)
    return [(0 if i == 0 else ends[i - 1] - overlap, e) for i, e in enumerate(ends)]


def cut_kind(text: str, limit: int, overlap: int) -> tuple[str, int]:
    """``hard`` if a piece had to end inside a stretch longer than the limit, else ``natural``; and the number of pieces.

    A stretch longer than the limit always has a piece end in it, so the piece ends tell.
    """
    seen = Boundaries(text)
    ends = cut_points(text, limit, overlap, seen)
    return ("hard" if any(seen.stretch(e) > limit for e in ends[:-1]) else "natural"), len(ends)


def _long(df: DataFrame, key: str, text: str, limit: int, overlap: int) -> DataFrame:
    if not 0 <= overlap < limit // 2:
        raise ValueError("overlap must be less than half the limit")
    return df.select(F.col(key).cast("string").alias("item_key"), F.col(text).alias("text")).where(F.char_length("text") > limit)


def text_cuts(df: DataFrame, key: str, text: str, limit: int = 420, overlap: int = 40) -> DataFrame:
    """(item_key, cut, n_pieces) of every text longer than ``limit``.

    Texts are cut where they lie and only the answers are shuffled.  Null,
    empty and short texts give no row; repeated keys count once (a key whose
    rows differ is ``hard`` if one of them is); other columns are ignored.
    """
    schema = pa.schema([("item_key", pa.string()), ("cut", pa.string()), ("n_pieces", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [cut_kind(t, limit, overlap) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.int32())], schema=schema)

    rows = _long(df, key, text, limit, overlap).mapInArrow(run, "item_key string, cut string, n_pieces int")
    return rows.groupBy("item_key").agg(F.min("cut").alias("cut"), F.max("n_pieces").alias("n_pieces"))


def split_texts(df: DataFrame, key: str, text: str, limit: int = 420, overlap: int = 40) -> DataFrame:
    """(item_key, piece_no, start, length, piece): the pieces of every text longer than ``limit``.

    Null, empty and short texts give no row; repeated keys count once (their
    first text by code point order); columns other than the two named ones are
    ignored, whatever their names.
    """
    long = _long(df, key, text, limit, overlap).groupBy("item_key").agg(F.min("text").alias("text"))
    schema = pa.schema([("item_key", pa.string()), ("piece_no", pa.int32()), ("start", pa.int32()), ("length", pa.int32()), ("piece", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            held = 0
            for k, t in zip(*(c.to_pylist() for c in batch.columns)):
                for i, (a, b) in enumerate(pieces_of(t, limit, overlap)):
                    out.append((k, i, a, b - a, t[a:b]))
                    held += b - a
                if held > 4_000_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
                    out, held = [], 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    return long.mapInArrow(run, "item_key string, piece_no int, start int, length int, piece string")
