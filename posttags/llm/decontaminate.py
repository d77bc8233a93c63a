"""Find training passages that copy, edit or paraphrase benchmark items.

A local (Smith-Waterman) alignment of words scores passages against items. Bounds on what an
alignment can reach leave out only places that cannot score enough, so the result is that of
aligning every document with every item.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from posttags.llm.common import few, lean, whole_text
from posttags.llm.shingles import word_hashes
from posttags.session import materialise

LEAST = 3  # words of an item
MATCH, MISMATCH, GAP = 2, -1, -1
# Share of an item's perfect score at which a passage counts as its copy.
LEAK = 0.5
# Words of benchmark items that tasks hold at once; a larger benchmark takes several passes.
HELD_WORDS = 1_000_000
# Words of documents looked at together, postings met at once, and chunks bounded at once.
TOGETHER, HELD_POSTINGS, BOUNDED = 50_000, 4_000_000, 1000

# ASCII signs and blanks divide words; bytes of other characters belong to them.
_DIVIDE = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


def words_of(text: str) -> np.ndarray:
    """Hashed words, lower-cased, without ASCII signs."""
    return word_hashes(text.lower().encode(), _DIVIDE)


def align(item: np.ndarray, passage: np.ndarray) -> tuple[int, int, int]:
    """The best local alignment: its score, and where in ``passage`` it begins and ends.

    A row of the table at a time; a running maximum carries gaps along the passage.
    """
    n = len(passage)
    steps = np.arange(1, n + 1) * -GAP
    score, begin = np.zeros(n + 1, np.int64), np.arange(n + 1)
    best = (0, 0, 0)
    for word in item:
        across = score[:-1] + np.where(passage == word, MATCH, MISMATCH)
        down = score[1:] + GAP
        row = np.maximum(np.maximum(across, down), 0)
        start = np.where(across >= down, begin[:-1], begin[1:])
        start = np.where(row > 0, start, np.arange(1, n + 1))
        lifted = row + steps
        carried = np.maximum.accumulate(lifted)
        source = np.maximum.accumulate(np.where(lifted == carried, np.arange(n), 0))
        row, start = carried - steps, start[source]
        score = np.concatenate([[0], row])
        begin = np.concatenate([[0], start])
        top = int(row.argmax()) if n else 0
        if n and row[top] > best[0]:
            best = (int(row[top]), int(start[top]), top + 1)
    return best


@dataclass
class Group:
    """Items of like length and what proposes them."""

    span: int  # words that a leaking passage of any of them has at most
    members: np.ndarray
    first: np.ndarray  # where the postings of each known word begin
    owner: np.ndarray  # of each posting: its place in ``members``
    need: np.ndarray  # postings that a leaking passage has at least


class Index:
    """Which chunks of documents can hold a passage that reaches ``leak`` of an item's perfect score.

    Such a passage has at least ``leak`` of the item's words, and at most 3 - 2 * leak times as
    many words as the item. So a chunk twice as long, beginning at each multiple of that
    length, holds it whole, and has all of the item's rarest words but those it may lack. The
    rarest are by the items that have them, which costs no pass over documents and bears on
    the work alone. Chunks that have enough of them must reach the score with each word that
    is the item's for a match. No passage that would be found is lost.
    """

    def __init__(self, items: list[tuple[int, np.ndarray]], leak: float):
        items = [(item, words) for item, words in items if len(words) >= LEAST]
        self.ids = [item for item, _ in items]
        self.known = np.unique(np.concatenate([w for _, w in items])) if items else np.empty(0, np.uint64)
        self.texts = [np.searchsorted(self.known, words) for _, words in items]
        self.least = [max(1, math.ceil(MATCH * leak * len(t) - 1e-9)) for t in self.texts]
        in_items = np.zeros(len(self.known), np.int64)
        for text in self.texts:
            in_items[np.unique(text)] += 1
        alike: dict[int, list[int]] = {}
        for at, text in enumerate(self.texts):
            alike.setdefault(len(text).bit_length(), []).append(at)
        self.groups = [self._group(np.array(members), in_items) for _, members in sorted(alike.items())]

    def _group(self, members: np.ndarray, in_items: np.ndarray) -> Group:
        words, owner, need, span = [], [], [], 1
        for place, at in enumerate(members):
            text, matches = self.texts[at], -(-self.least[at] // MATCH)
            span = max(span, 3 * len(text) - self.least[at])
            need.append(max(1, -(-matches // 2)))
            rare = text[np.lexsort((text, in_items[text]))][: max(0, len(text) - matches) + need[-1]]
            words.append(rare)
            owner.append(np.full(len(rare), place))
        word, owners = np.concatenate(words), np.concatenate(owner)
        order = np.argsort(word, kind="stable")
        first = np.searchsorted(word[order], np.arange(len(self.known) + 1))
        return Group(span, members, first, owners[order], np.array(need))

    def numbered(self, text: str) -> np.ndarray:
        """The words of ``text`` by their place among the known ones; others have the next number."""
        words = words_of(text)
        if not len(self.known):
            return np.zeros(len(words), np.int64)
        at = np.minimum(np.searchsorted(self.known, words), len(self.known) - 1)
        return np.where(self.known[at] == words, at, len(self.known))

    def passages(self, docs: list[np.ndarray]) -> Iterator[tuple[int, int, int, int]]:
        """``doc, item, start, end``: where each document must be aligned with each item."""
        sizes = np.array([len(d) for d in docs])
        words, starts = np.concatenate(docs), np.cumsum(sizes) - sizes
        doc = np.repeat(np.arange(len(docs)), sizes)
        at = np.flatnonzero(words < len(self.known))
        for group in self.groups:
            yield from self._of_group(group, words, at, doc[at], starts, sizes)

    def _of_group(self, group, words, at, doc, starts, sizes) -> Iterator[tuple[int, int, int, int]]:
        span, known = group.span, len(self.known)
        chunks = np.maximum(1, -(-sizes // span) - 1)
        offset = np.cumsum(chunks) - chunks
        block = (at - starts[doc]) // span
        useful = (group.first[1:] > group.first[:-1])[words[at]]
        # a chunk is two blocks, a block is in two chunks
        earlier = useful & (block > 0)
        keys = np.concatenate([
            (offset[doc] + np.minimum(block, chunks[doc] - 1))[useful] * known + words[at][useful],
            (offset[doc] + block - 1)[earlier] * known + words[at][earlier],
        ])
        keys.sort()
        keys = keys[np.diff(keys, prepend=-1) > 0]
        chunk, word = keys // known, keys % known
        found: list[tuple[np.ndarray, np.ndarray]] = []
        step = max(1, HELD_POSTINGS // len(group.owner))
        for low in range(0, int(chunks.sum()), step):
            a, b = np.searchsorted(chunk, [low, low + step])
            n = group.first[word[a:b] + 1] - group.first[word[a:b]]
            posting = np.repeat(group.first[word[a:b]] - np.cumsum(n) + n, n) + np.arange(n.sum())
            cell = np.repeat(chunk[a:b] - low, n) * len(group.members) + group.owner[posting]
            tally = np.bincount(cell, minlength=step * len(group.members)).reshape(step, -1)
            enough, item = np.nonzero(tally >= group.need)
            found.append((enough + low, item))
        enough, item = (np.concatenate(x) for x in zip(*found))
        of = np.searchsorted(offset, enough, "right") - 1
        begin = (enough - offset[of]) * span
        end = np.minimum(begin + 2 * span, sizes[of])
        order = np.lexsort((enough, item))
        padded, own = np.append(words, known), np.zeros(known + 1, bool)
        for part in np.split(order, np.flatnonzero(np.diff(item[order])) + 1):
            if not len(part):
                continue
            number = int(group.members[item[part[0]]])
            own[self.texts[number]] = True
            last: tuple[int, int, int] | None = None
            for some in np.split(part, range(BOUNDED, len(part), BOUNDED)):
                place = begin[some, None] + np.arange(2 * span)
                place = np.where(place < end[some, None], place + starts[of[some], None], len(words))
                total = np.cumsum((MATCH - GAP) * own[padded[place]] + GAP, axis=1)
                lowest = np.minimum(np.minimum.accumulate(total, axis=1), 0)
                lowest = np.concatenate([np.zeros((len(some), 1), lowest.dtype), lowest[:, :-1]], axis=1)
                for c in some[(total - lowest).max(axis=1) >= self.least[number]].tolist():
                    here = (int(of[c]), int(begin[c]), int(end[c]))
                    if last and last[0] == here[0] and last[2] >= here[1]:  # one passage
                        last = (last[0], last[1], here[2])
                        continue
                    if last:
                        yield last[0], number, last[1], last[2]
                    last = here
            own[self.texts[number]] = False
            if last:
                yield last[0], number, last[1], last[2]


def leaks(docs: DataFrame, benchmark: DataFrame, leak: float = LEAK, held: int = HELD_WORDS) -> DataFrame:
    """The benchmark items that documents leak.

    Returns ``doc_id, item_id, score, start_word, n_words`` for each row of ``docs`` and item
    whose best alignment reaches ``leak`` of the item's perfect score: 2 for each equal word,
    -1 for another word, a missing or an extra one. Words are what ASCII signs and blanks
    divide.

    Every passage that reaches it is found, however edited. Items of fewer than three words,
    null or empty ones and those without item_id match nothing, as do null and empty documents.
    Items that share an item_id are judged as one per text. Null doc_ids are kept; a row
    given twice comes back twice; an empty table gives an empty result. Other columns are not
    looked at.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), whole_text().alias("text"))
    items = materialise(items.where("item_id is not null").distinct(), "items")
    size = items.agg(F.coalesce(F.sum(F.size(F.split("text", r"\W+"))), F.lit(0))).first()[0]
    passes = max(1, -(-size // held))
    block = F.pmod(F.xxhash64("item_id"), F.lit(passes))
    found = [_leaks_of(rows, items.where(block == i), leak) for i in range(passes)]
    return reduce(DataFrame.unionByName, found)


def _leaks_of(rows: DataFrame, items: DataFrame, leak: float) -> DataFrame:
    held = [(row.item_id, words_of(row.text)) for row in items.orderBy("item_id", "text").collect()]
    index = Index(held, leak)

    def judged(ids: list, docs: list[np.ndarray]) -> list[tuple]:
        best: dict[tuple[int, int], tuple[float, int, int]] = {}
        for doc, number, a, b in index.passages(docs):
            item = index.texts[number]
            score, start, end = align(item, docs[doc][a:b])
            score, key = score / (MATCH * len(item)), (doc, index.ids[number])
            if score >= leak and score > best.get(key, (0.0,))[0]:
                best[key] = (score, a + start, a + end)
        return [(ids[d], i, round(score, 6), a, b - a) for (d, i), (score, a, b) in best.items()]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, ids, docs, size = [], [], [], 0
            for doc_id, text in zip(batch.column(0).to_pylist(), few(batch.column(1))):
                ids.append(doc_id)
                docs.append(index.numbered(text))
                size += len(docs[-1])
                if size >= TOGETHER:
                    out += judged(ids, docs)
                    ids, docs, size = [], [], 0
            if docs:
                out += judged(ids, docs)
            columns = list(zip(*out)) if out else [[]] * 5
            kinds = [pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)],
                ["doc_id", "item_id", "score", "start_word", "n_words"],
            )

    return rows.mapInArrow(
        lean(find), "doc_id long, item_id long, score double, start_word long, n_words long"
    )
