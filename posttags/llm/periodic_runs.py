"""Maximal periodic runs of words, and texts with their repetitions taken out.

A suffix automaton grows by one word at a time. Its suffix links form a tree, kept as a
link-cut tree whose preferred paths are segments of equal last occurrence: appending a word
accesses the new prefix, which recolours its path to the root with the new end. Each segment
met on the way tells that all suffixes of its range of lengths last ended at the segment's old
end; where the distance between old and new end lies in that range, the two occurrences are a
square with a primitive root. Every such square is met, and is extended to its run.

Long runs are rare, so an exact bound first tells where they can be: all windows of 8 words of
a run with three periods and 24 words occur twice in it. The automaton reads only stretches
of such windows.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from posttags.llm.common import whole_text

# A run has at least this many words and this many periods.
LEAST, PERIODS = 24, 3
# Words of a window; a run of PERIODS or more has more than LEAST / PERIODS beyond two periods.
WINDOW = LEAST // PERIODS
# How often a stretch is looked at again by itself; what is left then goes to the automaton whole.
LOOKS = 4
_MULTIPLIER = 0x9E3779B97F4A7C15


class SuffixAutomaton:
    """An online suffix automaton whose links are a link-cut tree of last occurrences.

    State 1 is the root, 0 stands for none. ``left``, ``right`` and ``up`` hold the splay trees
    of the preferred paths, ordered by depth; ``up`` of a splay root is the parent of its path.
    ``colour`` of a splay root is the last end of what its whole path stands for.
    """

    def __init__(self) -> None:
        self.edges: list[dict[int, int]] = [{}, {}]
        self.length, self.link, self.colour = [0, 0], [0, 0], [0, 0]
        self.left, self.right, self.up = [0, 0], [0, 0], [0, 0]
        self.last, self.size = 1, 0

    def _new(self, length: int, edges: dict[int, int]) -> int:
        self.edges.append(edges)
        self.length.append(length)
        for column in (self.link, self.colour, self.left, self.right, self.up):
            column.append(0)
        return len(self.length) - 1

    def _splay(self, x: int) -> int:
        """Makes ``x`` the root of its splay tree; the colour of the path moves along."""
        left, right, up = self.left, self.right, self.up
        y = up[x]
        if not y or (left[y] != x and right[y] != x):
            return self.colour[x]
        while True:
            z = up[y]
            inner = z and (left[z] == y or right[z] == y)
            if inner:  # turn y or x first, as x and y lean alike or not
                top = up[z]
                if (left[z] == y) == (left[y] == x):
                    if left[z] == y:
                        b = left[z] = right[y]
                        right[y] = z
                    else:
                        b = right[z] = left[y]
                        left[y] = z
                    if b:
                        up[b] = z
                    up[z] = y
                    if left[y] == x:
                        b = left[y] = right[x]
                        right[x] = y
                    else:
                        b = right[y] = left[x]
                        left[x] = y
                    if b:
                        up[b] = y
                    up[y] = x
                else:
                    if left[y] == x:
                        b, c = right[x], left[x]
                        left[y], right[z] = b, c
                        right[x], left[x] = y, z
                    else:
                        b, c = left[x], right[x]
                        right[y], left[z] = b, c
                        left[x], right[x] = y, z
                    if b:
                        up[b] = y
                    if c:
                        up[c] = z
                    up[y] = up[z] = x
                root, above = z, top
            else:
                if left[y] == x:
                    b = left[y] = right[x]
                    right[x] = y
                else:
                    b = right[y] = left[x]
                    left[x] = y
                if b:
                    up[b] = y
                up[y] = x
                root, above = y, z
            up[x] = above
            if not above:
                break
            if left[above] == root:
                left[above] = x
            elif right[above] == root:
                right[above] = x
            else:
                break
            y = above
        found = self.colour[x] = self.colour[root]
        return found

    def _extend(self, word: int) -> int:
        """Adds a word; returns the state of the whole prefix, hung under its link."""
        edges, length, link = self.edges, self.length, self.link
        self.size += 1
        new, p = self._new(self.size, {}), self.last
        while p and word not in edges[p]:
            edges[p][word] = new
            p = link[p]
        if not p:
            link[new] = 1
        else:
            q = edges[p][word]
            if length[p] + 1 != length[q]:
                q = self._split(p, word, q)
            link[new] = q
        self.up[new] = link[new]
        self.last = new
        return new

    def _split(self, p: int, word: int, q: int) -> int:
        """A copy of ``q`` for its shorter strings, between ``q`` and its link on the same path."""
        edges, link, left, up = self.edges, self.link, self.left, self.up
        self._splay(q)
        copy = self._new(self.length[p] + 1, edges[q].copy())
        link[copy], link[q] = link[q], copy
        above = left[copy] = left[q]
        if above:
            up[above] = copy
        left[q], up[copy] = copy, q
        while p and edges[p].get(word) == q:
            edges[p][word] = copy
            p = link[p]
        return copy

    def append(self, word: int) -> list[tuple[int, int]]:
        """Adds a word and accesses its prefix: ``end, period`` of the primitive squares ending here."""
        last = self._extend(word)
        left, right, up, length, colour = self.left, self.right, self.up, self.length, self.colour
        end, squares = self.size, []
        x = up[last]
        while x:
            old = self._splay(x)
            below = right[x]
            if below:
                colour[below] = old
            right[x], up[last] = last, x
            above = up[x]
            if old and length[above] < end - old <= length[x]:
                squares.append((end, end - old))
            last, x = x, above
        colour[last] = end
        return squares


def runs_of(words: Sequence[int]) -> list[tuple[int, int, int]]:
    """``start, length, period`` of all maximal runs with LEAST words and PERIODS periods."""
    automaton, n, found = SuffixAutomaton(), len(words), []
    known: dict[int, int] = {}  # the end of the latest run of each period
    for word in words:
        for end, period in automaton.append(word):
            if end <= known.get(period, 0):
                continue
            start = end - 2 * period
            while start and words[start - 1] == words[start - 1 + period]:
                start -= 1
            while end < n and words[end] == words[end - period]:
                end += 1
            known[period] = end
            if end - start >= max(LEAST, PERIODS * period):
                found.append((start, end - start, period))
    return found


def _repeated(words: np.ndarray) -> np.ndarray | None:
    """Which windows occur twice among those of ``words``, or none at all.

    Windows are compared by a hash: equal ones always have equal hashes, so none is missed.
    """
    total, width, power = words.astype(np.uint64), 1, _MULTIPLIER
    while width < WINDOW:
        total = total[:-width] * np.uint64(power) + total[width:]
        total ^= total >> np.uint64(31)
        width, power = 2 * width, power * power % (1 << 64)
    order = np.sort(total)
    same = order[1:] == order[:-1]
    if not same.any():
        return None
    twice = order[1:][same]
    return twice[np.minimum(np.searchsorted(twice, total), len(twice) - 1)] == total


def stretches(words: np.ndarray, at: int = 0, looks: int = LOOKS) -> Iterator[tuple[int, np.ndarray]]:
    """The parts of ``words`` in which runs can lie, each with its place; no run is cut."""
    if len(words) < LEAST:
        return
    mask = _repeated(words)
    if mask is None:
        return
    edges = np.diff(mask.astype(np.int8), prepend=0, append=0)
    for a, b in zip(np.flatnonzero(edges == 1).tolist(), np.flatnonzero(edges == -1).tolist()):
        part = words[a : b + WINDOW - 1]
        if len(part) == len(words) or not looks:
            yield at + a, part
        else:  # what repeated somewhere else need not repeat in here
            yield from stretches(part, at + a, looks - 1)


@dataclass
class Found:
    """The runs of a text, by start and period, and its words without the repetitions."""

    words: list[bytes]
    runs: list[tuple[int, int, int]]

    def best(self) -> tuple[int, int, int] | None:
        """The run of the greatest exponent; of equal ones the first, then the shortest period."""
        best = None
        for run in self.runs:
            if best is None or run[1] * best[2] > best[1] * run[2]:
                best = run
        return best

    def kept(self) -> list[bytes]:
        """The words that no run holds beyond its first period."""
        if not self.runs:
            return self.words
        gone = np.zeros(len(self.words), bool)
        for start, length, period in self.runs:
            gone[start + period : start + length] = True
        return [self.words[i] for i in np.flatnonzero(~gone).tolist()]


def detect(words: list[bytes]) -> Found:
    """The runs of a list of words."""
    number = defaultdict(count().__next__)
    ids = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
    found = []
    for at, part in stretches(ids):
        found += [(at + start, length, period) for start, length, period in runs_of(part.tolist())]
    return Found(words, sorted(found, key=lambda run: (run[0], run[2])))


def repeated_tail(words: list[bytes], begin: int, period: int) -> list[bytes]:
    """``words`` with everything from ``begin`` replaced by its first ``period`` words, again and again."""
    tail = words[begin : begin + period]
    left = len(words) - begin
    return words[:begin] + (tail * (left // len(tail) + 1))[:left] if tail else words


SCHEMA = (
    "doc_id long, n_words long, n_runs long, start long, length long, period long, "
    "exponent_milli long, runs_sha256 string, collapsed_sha256 string"
)


def find_runs(docs: DataFrame, tail: tuple[Column, Column] | None = None) -> DataFrame:
    """The runs of every row's text: SCHEMA, one row per input row.

    ``start, length, period`` are those of the run with the greatest exponent, null without a
    run; ``runs_sha256`` digests all runs, ``collapsed_sha256`` the text without repetitions.
    ``tail`` is for tests at scale: two columns ``g, planted``, where ``planted`` rows get a
    tail of period ``1 + (n - a) // (3 + g % 8)`` from word ``a = g % n``.

    A null or empty text has no words and no run. Null doc_ids and rows given twice keep
    their own rows; an empty table gives an empty result. Other columns are not looked at. A
    text is one row, so it is read by one task; what a task holds is that of its longest text.
    """
    g, planted = tail or (F.lit(0), F.lit(False))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), whole_text().cast("binary").alias("text"),
        F.coalesce(g.cast("long"), F.lit(0)).alias("g"), F.coalesce(planted, F.lit(False)).alias("planted"),
    )

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: list[list] = [[] for _ in range(8)]
            for text, g, planted in zip(batch.column(1), batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                words = text.as_py().split()
                if planted and words:
                    begin = g % len(words)
                    words = repeated_tail(words, begin, 1 + (len(words) - begin) // (3 + g % 8))
                found = detect(words)
                start, length, period = found.best() or (None, None, None)
                listed = "".join(f"{s},{n},{p}\n" for s, n, p in found.runs)
                row = (
                    len(words), len(found.runs), start, length, period,
                    None if length is None else 1000 * length // period,
                    hashlib.sha256(listed.encode()).hexdigest(),
                    hashlib.sha256(b" ".join(found.kept())).hexdigest(),
                )
                for column, value in zip(columns, row):
                    column.append(value)
            kinds = [pa.int64()] * 6 + [pa.string()] * 2
            arrays = [batch.column(0), *[pa.array(c, kind) for c, kind in zip(columns, kinds)]]
            yield pa.RecordBatch.from_arrays(arrays, [part.split()[0] for part in SCHEMA.split(", ")])

    return rows.mapInArrow(find, SCHEMA)
