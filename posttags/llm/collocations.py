"""Phrases of words that stand together more often than their parts foretell.

Tasks count the windows of up to five words that begin at each word in a HAT-trie: a trie over
word ids whose lower parts are hash containers, which burst into trie nodes where they grow
large. When a trie is full, its largest subtrees leave it whole, as runs of sorted windows.
Runs are cut at sampled splitters, so each part of the shuffle holds one range of the sorted
windows, whatever prefix is frequent, and merges the runs of that range. A window counts for
all its prefixes; only phrases that begin a splitter are counted in several parts, and summed.

Words with fewer occurrences than a phrase needs end a window: no candidate holds one. Tasks
know them by a bitmap of hashes, which may let rare words pass but never stops another.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window, functions as F

from posttags.llm.common import whole_text
from posttags.session import materialise

LONGEST = 5
# Windows a trie holds before it spills, words it numbers, and windows of a container that bursts.
HELD, NUMBERED, BURST = 400_000, 1_000_000, 16_384
# Words of a text that are counted before the trie may spill.
SLICE = 50_000
# Windows a part of the shuffle should merge, and sampled windows for each splitter.
PART, PER_SPLITTER = 1_500_000, 20
# Documents that splitters are sampled from, and the most windows that are sampled. Where
# splitters lie decides how even the parts are, never what is counted.
SAMPLED_DOCS, SAMPLED = 20_000, 1_000_000
# The bitmap of frequent words: bits for each, and the most bits (32 MB).
BITS_EACH, MOST_BITS = 16, 1 << 28
_BLOCK = 1 << 16  # bits of the bitmap put together by one task
# Phrases that one task ranks, times the number of phrases asked for: each round passes on a tenth.
LOT = 10

_LOWER, _BREAKS = bytes(range(65, 91)), b".,;:!?\n\x0b\x0c\r"
_BREAK = b"\xff"  # no UTF-8 text has this byte
_SIGNS = bytes.maketrans(_LOWER + _BREAKS + b"\t", _LOWER.lower() + _BREAK * len(_BREAKS) + b" ")
_RARE = b""

Phrase = tuple[bytes, ...]


def tokens(text: bytes) -> list[bytes]:
    """The words of a text, A-Z lower-cased, and a BREAK where a piece ends."""
    return text.translate(_SIGNS).replace(_BREAK, b" \xff ").split()


def texts_of(docs: DataFrame, undetermined: str = "und") -> DataFrame:
    """``lang, text``: null languages are ``undetermined``, null texts empty."""
    lang = F.coalesce(F.col("lang").cast("string"), F.lit(undetermined))
    return docs.select(lang.alias("lang"), whole_text().cast("binary").alias("text"))


def word_counts(texts: DataFrame) -> DataFrame:
    """``lang, word, n`` of all words."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, counts in held.items():
                del counts[_BREAK]
                words = pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())
                names = pa.array([lang]).take(pa.array([0] * len(counts), pa.int32()))
                yield pa.RecordBatch.from_arrays([names, *words], ["lang", "word", "n"])
            held.clear()

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                counts = held.setdefault(lang, Counter())
                counts.update(tokens(text.as_py()))
                if len(counts) > NUMBERED:
                    yield from flush()
        yield from flush()

    rows = texts.mapInArrow(count, "lang string, word binary, n long")
    word = F.col("word").cast("string").alias("word")
    return rows.groupBy("lang", word).agg(F.sum("n").alias("n"))


def _key(lang: str, word: bytes) -> bytes:
    return lang.encode() + b"\t" + word


class Bitmap:
    """A bit for the hash of each frequent word of each language."""

    def __init__(self, words: DataFrame, frequent: int):
        bits = 1 << min(max(_BLOCK.bit_length() - 1, (BITS_EACH * frequent).bit_length()), MOST_BITS.bit_length() - 1)
        self.mask, self.bits = bits - 1, np.zeros(bits // 8, np.uint8)
        hashed = F.crc32(F.concat_ws("\t", "lang", "word").cast("binary"))
        place = F.pmod(hashed, F.lit(bits)).alias("place")
        rows = words.select(place).select(F.floor(F.col("place") / _BLOCK).cast("long").alias("block"), "place")

        def fill(group: pa.Table) -> pa.Table:
            block = group.column("block")[0].as_py()
            on = np.zeros(_BLOCK, np.uint8)
            on[group.column("place").to_numpy() - block * _BLOCK] = 1
            return pa.table({"block": [block], "bits": pa.array([np.packbits(on).tobytes()], pa.binary())})

        for row in rows.distinct().groupBy("block").applyInArrow(fill, "block long, bits binary").toLocalIterator():
            at = row.block * _BLOCK // 8
            self.bits[at : at + _BLOCK // 8] = np.frombuffer(row.bits, np.uint8)

    def may_hold(self, lang: str, word: bytes) -> bool:
        place = zlib.crc32(_key(lang, word)) & self.mask
        return bool(self.bits[place >> 3] >> (7 - (place & 7)) & 1)


class _Node(dict):
    """An inner node: children by word id, and the windows that end here."""

    __slots__ = ("ends",)
    ends: int


class _Numbers(dict):
    """The id of each word of a language, four bytes; RARE for rare words and breaks."""

    def __init__(self, lang: str, words: list[tuple[str, bytes]], bitmap: Bitmap):
        self.lang, self.words, self.bitmap = lang, words, bitmap
        self[_BREAK] = _RARE

    def __missing__(self, word: bytes) -> bytes:
        found = _RARE
        if self.bitmap.may_hold(self.lang, word):
            found = len(self.words).to_bytes(4, "little")
            self.words.append((self.lang, word))
        self[word] = found
        return found


class HatTrie:
    """Counts windows; containers are dicts from the ids left of a window to its count.

    Ids are numbered by the task: runs hold the words themselves.
    """

    def __init__(self, bitmap: Bitmap, burst: int = BURST):
        self.bitmap, self.burst = bitmap, burst
        self.clear()

    def clear(self) -> None:
        self.root: dict[bytes, dict] = {}
        self.numbers: dict[str, _Numbers] = {}
        self.words: list[tuple[str, bytes]] = [("", b"")]
        self.entries = 0

    def add(self, lang: str, words: list[bytes], starts: int) -> None:
        """Count the windows of two words or more that begin at the first ``starts`` words."""
        numbers = self.numbers.get(lang)
        if numbers is None:
            numbers = self.numbers[lang] = _Numbers(lang, self.words, self.bitmap)
        ids = list(map(numbers.__getitem__, words))
        start, segments = 0, []
        for _ in range(ids.count(_RARE)):
            at = ids.index(_RARE, start)
            if at > start + 1:
                segments.append((b"".join(ids[start:at]), 4 * (starts - start)))
            start = at + 1
        if len(ids) > start + 1:
            segments.append((b"".join(ids[start:]), 4 * (starts - start)))
        self._count(segments)

    def numbered(self) -> int:
        return sum(map(len, self.numbers.values()))

    def _count(self, segments: list[tuple[bytes, int]]) -> None:
        root, burst, new, width = self.root, self.burst, 0, 4 * LONGEST
        for ids, starts in segments:
            end = len(ids)
            for at in range(0, min(starts, end - 4), 4):
                place = at + 4
                above, key = root, ids[at:place]
                box = root.get(key)
                if box is None:
                    root[key] = {ids[place : at + width]: 1}
                    new += 1
                    continue
                if type(box) is _Node:
                    stop = min(at + width, end)
                    while type(box) is _Node and place < stop:
                        above, key = box, ids[place : place + 4]
                        box, place = box.get(key), place + 4
                    if type(box) is _Node:
                        box.ends += 1
                        continue
                    if box is None:
                        box = above[key] = {}
                left = ids[place : at + width]
                seen = box.get(left)
                if seen:
                    box[left] = seen + 1
                    continue
                box[left] = 1
                new += 1
                if len(box) > burst and place < at + width:
                    above[key] = self._burst(box)
        self.entries += new

    @staticmethod
    def _burst(box: dict[bytes, int]) -> _Node:
        """The container's children, each with a container of its own."""
        node = _Node()
        node.ends = 0
        for left, n in box.items():
            if not left:
                node.ends = n
            else:
                node.setdefault(left[:4], {})[left[4:]] = n
        return node

    def _take(self, box: dict, prefix: bytes, windows: list[bytes], counts: list[int]) -> None:
        """Adds all windows of a subtree, filled up to the full width."""
        if type(box) is not _Node:
            windows += [(prefix + left).ljust(4 * LONGEST, b"\0") for left in box]
            counts += box.values()
            return
        if box.ends:
            windows.append(prefix.ljust(4 * LONGEST, b"\0"))
            counts.append(box.ends)
        for key, child in box.items():
            self._take(child, prefix + key, windows, counts)

    def _size(self, box: dict) -> int:
        return sum(map(self._size, box.values())) + 1 if type(box) is _Node else len(box)

    def spill(self, keep: float) -> tuple[np.ndarray, np.ndarray]:
        """Takes out the largest subtrees until a share ``keep`` is left: ids and counts of windows."""
        keys, boxes = list(self.root), self.root.values()
        sizes = np.array([len(box) if type(box) is dict else self._size(box) for box in boxes], np.int64)
        order = np.argsort(-sizes, kind="stable")
        left = int(sizes.sum())
        after = left - np.cumsum(sizes[order])
        taken = np.searchsorted(-after, -self.entries * keep) + 1 if left else 0
        windows: list[bytes] = []
        counts: list[int] = []
        for at in order[:taken].tolist():
            self._take(self.root.pop(keys[at]), keys[at], windows, counts)
        self.entries = int(after[taken - 1]) if 0 < taken <= len(after) else 0
        return np.frombuffer(b"".join(windows), "<u4").reshape(-1, LONGEST), np.array(counts, np.int64)


def _pack(words: list[bytes], windows: np.ndarray, counts: np.ndarray) -> bytes:
    """A run: its words, and its windows as places among them, from 1, column by column."""
    kind = "<u2" if len(words) < 1 << 16 else "<u4"
    names = b"\n".join(words)
    head = np.array([len(words), len(names), len(counts)], "<i8").tobytes()
    load = head + names + windows.T.astype(kind).tobytes() + counts.astype("<i8").tobytes()
    return zstandard.ZstdCompressor(level=1).compress(load)


def _unpack(load: bytes) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    data = zstandard.ZstdDecompressor().decompress(load)
    n_words, size, n = np.frombuffer(data, "<i8", 3).tolist()
    words, at = data[24 : 24 + size].split(b"\n"), 24 + size
    kind = np.dtype("<u2" if n_words < 1 << 16 else "<u4")
    windows = np.frombuffer(data, kind, LONGEST * n, at).reshape(LONGEST, n).T
    return words, windows, np.frombuffer(data, "<i8", n, at + LONGEST * n * kind.itemsize)


def _order(windows: np.ndarray, most: int) -> np.ndarray:
    """The lexicographic order of rows of places up to ``most``, as few sort keys as hold them."""
    bits, keys, used = max(1, int(most).bit_length()), [], 64
    for column in windows.T:
        if used + bits > 63:
            keys.append(column.astype(np.int64))
            used = bits
        else:
            keys[-1] = keys[-1] << bits | column
            used += bits
    return np.lexsort(keys[::-1])


def _cuts(windows: np.ndarray, words: list[bytes], splitters: list[Phrase]) -> np.ndarray:
    """The splitter range of each row of sorted ``windows``, whose places count from 1 in ``words``."""

    def phrase(at: int) -> Phrase:
        return tuple(words[i - 1] for i in windows[at].tolist() if i)

    if len(windows) < len(splitters):
        return np.array([bisect_right(splitters, phrase(at)) for at in range(len(windows))], np.int64)
    rows = range(len(windows))
    ends = [bisect_left(rows, splitter, key=phrase) for splitter in splitters]
    return np.searchsorted(ends, np.arange(len(windows)), side="right")


def _runs(trie: HatTrie, keep: float, splitters: dict[str, list[Phrase]], offsets: dict[str, int]):
    """Rows ``part, lang, run`` of what the trie spills."""
    ids, counts = trie.spill(keep)
    rows: list[tuple[int, str, bytes]] = []
    names = sorted(trie.numbers)
    number = {lang: at for at, lang in enumerate(names)}
    langs = np.array([number.get(lang, -1) for lang, _ in trie.words])[ids[:, 0]]
    for lang in names:
        mine = np.flatnonzero(langs == number[lang])
        if not len(mine):
            continue
        windows = ids[mine]
        seen = np.zeros(len(trie.words), bool)
        seen[windows.ravel()] = True
        seen[0] = False
        used = sorted(((trie.words[i][1], i) for i in np.flatnonzero(seen).tolist()))
        named, place = [word for word, _ in used], np.zeros(len(seen), np.int64)
        place[[i for _, i in used]] = np.arange(1, len(used) + 1)
        windows = place[windows]
        order = _order(windows, len(named))
        windows, n = windows[order], counts[mine][order]
        part = _cuts(windows, named, splitters.get(lang, []))
        for start, stop in zip(*_bounds(part)):
            here = windows[start:stop]
            own = np.unique(here)
            own = own[own > 0]
            local = np.zeros(own[-1] + 1, np.int64)
            local[own] = np.arange(1, len(own) + 1)
            load = _pack([named[i - 1] for i in own.tolist()], local[here], n[start:stop])
            rows.append((offsets.get(lang, 0) + int(part[start]), lang, load))
    columns = list(zip(*rows)) or [(), (), ()]
    kinds = pa.int32(), pa.string(), pa.binary()
    arrays = [pa.array(column, kind) for column, kind in zip(columns, kinds)]
    return pa.RecordBatch.from_arrays(arrays, ["part", "lang", "run"])


def _bounds(key: np.ndarray) -> tuple[list[int], list[int]]:
    """Where runs of equal keys begin and end."""
    change = (np.flatnonzero(key[1:] != key[:-1]) + 1).tolist() if len(key) else []
    return ([0] if len(key) else []) + change, change + ([len(key)] if len(key) else [])


def merged(runs: list[bytes], edges: set[Phrase], least: int) -> tuple[list[Phrase], list[int]]:
    """The phrases of two words or more in sorted ``runs`` and how often each begins a window.

    Phrases below ``least`` are left out, but for the ``edges``, which other parts count too.
    """
    loads = [_unpack(run) for run in runs]
    words = sorted({word for names, _, _ in loads for word in names})
    place = {word: at + 1 for at, word in enumerate(words)}
    parts = [np.array([0, *map(place.__getitem__, names)], np.int64)[windows] for names, windows, _ in loads]
    windows, counts = np.concatenate(parts), np.concatenate([n for _, _, n in loads])
    del loads, parts
    order = _order(windows, len(words))
    windows, counts = windows[order], counts[order]
    new = np.ones(len(windows), bool)
    new[1:] = windows[1:, 0] != windows[:-1, 0]
    phrases, totals = [], []
    for size in range(2, LONGEST + 1):
        new[1:] |= windows[1:, size - 1] != windows[:-1, size - 1]
        first = np.flatnonzero(new)
        n = np.add.reduceat(counts, first)
        whole = windows[first, size - 1] > 0
        chosen = whole & (n >= least)
        found = [tuple(words[i - 1] for i in row) for row in windows[first[chosen], :size].tolist()]
        phrases += found
        totals += n[chosen].tolist()
        some = [edge for edge in edges if len(edge) == size and all(word in place for word in edge)]
        for edge in set(some).difference(found):
            row = np.array([place[word] for word in edge])
            low, high = 0, len(first)
            for column, want in enumerate(row.tolist()):  # narrowed word by word, as rows are sorted
                values = windows[first[low:high], column]
                low, high = low + np.searchsorted(values, want), low + np.searchsorted(values, want, side="right")
            if low < high:
                phrases.append(edge)
                totals.append(int(n[low]))
    return phrases, totals


def _sample_windows(texts: DataFrame, words: int, bitmap: Bitmap, windows: int) -> list[tuple[str, Phrase]]:
    """At most ``windows`` windows of about SAMPLED_DOCS documents, chosen by hash, sorted.

    ``words`` is the number of all words; one window in every so many of a text is looked at.
    """
    total = max(1, texts.count())
    some = texts.where(F.pmod(F.xxhash64("text"), F.lit(total)) < SAMPLED_DOCS)
    step = max(1, int(words * min(1, SAMPLED_DOCS / total)) // (4 * windows))

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, found, hashes = [], [], []
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                data = text.as_py()
                parts = tokens(data)
                for at in range(zlib.crc32(data) % step, len(parts), step):
                    window = []
                    for word in parts[at : at + LONGEST]:
                        if word == _BREAK or not bitmap.may_hold(lang, word):
                            break
                        window.append(word)
                    if len(window) > 1:
                        langs.append(lang)
                        found.append(b" ".join(window))
                        hashes.append(zlib.crc32(found[-1] + b"%d" % at))
            arrays = [pa.array(langs, pa.string()), pa.array(found, pa.binary()), pa.array(hashes, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, ["lang", "window", "hash"])

    found = some.mapInArrow(sample, "lang string, window binary, hash long")
    chosen = found.orderBy("hash", "lang", "window").limit(windows).select("lang", "window").collect()
    return sorted((row.lang, tuple(bytes(row.window).split(b" "))) for row in chosen)


def phrase_counts(texts: DataFrame, words: DataFrame, least: int, part: int = PART) -> DataFrame:
    """``lang, phrase, size, n`` of the phrases of two to five words with at least ``least``.

    ``words`` has ``lang, word, n`` of all words; ``part`` is the number of windows that a part
    of the shuffle should merge.
    """
    frequent = words.where(F.col("n") >= least)
    known = frequent.agg(F.count("*").alias("words"), F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()
    bitmap = Bitmap(frequent, known.words)
    wanted = max(1, -(-known.n // part))
    sample = _sample_windows(texts, known.n, bitmap, min(SAMPLED, PER_SPLITTER * wanted))
    chosen = sorted({sample[len(sample) * i // wanted] for i in range(1, wanted)}) if sample else []
    splitters: dict[str, list[Phrase]] = {}
    for lang, phrase in chosen:
        splitters.setdefault(lang, []).append(phrase)
    offsets, at = {}, 0  # parts are numbered in the order of languages; every language begins one
    for lang in sorted(splitters):
        offsets[lang] = at + 1
        at += len(splitters[lang]) + 1

    def spill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = HatTrie(bitmap)
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = tokens(text.as_py())
                for at in range(0, len(words), SLICE):
                    trie.add(lang, words[at : at + SLICE + LONGEST - 1], SLICE)
                    if trie.entries > HELD:
                        yield _runs(trie, 0.5, splitters, offsets)
                if trie.numbered() > NUMBERED:
                    yield _runs(trie, 0, splitters, offsets)
                    trie.clear()
        yield _runs(trie, 0, splitters, offsets)

    def merge(group: pa.Table) -> pa.Table:
        langs, found, sizes, totals = [], [], [], []
        by_lang: dict[str, list[bytes]] = {}
        for lang, run in zip(group.column("lang").to_pylist(), group.column("run").to_pylist()):
            by_lang.setdefault(lang, []).append(run)
        number = group.column("part")[0].as_py()
        for lang, runs in by_lang.items():
            mine, place = splitters.get(lang, []), number - offsets.get(lang, 0)
            near = [mine[i] for i in (place - 1, place) if 0 <= i < len(mine)]
            edges = {splitter[:size] for splitter in near for size in range(2, len(splitter) + 1)}
            phrases, n = merged(runs, edges, least)
            langs += [lang] * len(phrases)
            found += [b" ".join(phrase) for phrase in phrases]
            sizes += map(len, phrases)
            totals += n
        return pa.table(
            [pa.array(langs, pa.string()), pa.array(found, pa.binary()), pa.array(sizes, pa.int32()), pa.array(totals, pa.int64())],
            ["lang", "phrase", "size", "n"],
        )

    runs = texts.mapInArrow(spill, "part int, lang string, run binary")
    counts = runs.groupBy("part").applyInArrow(merge, "lang string, phrase binary, size int, n long")
    phrase = F.col("phrase").cast("string").alias("phrase")
    counts = counts.groupBy("lang", phrase, "size").agg(F.sum("n").alias("n"))
    return counts.where(F.col("n") >= least)


def _words(phrase: str, start: Column | int, size: Column) -> Column:
    """``size`` words of a phrase from the place ``start``, counted from 1."""
    return F.array_join(F.slice(F.split(phrase, " "), start, size), " ")


def scored(phrases: DataFrame, words: DataFrame) -> DataFrame:
    """``lang, phrase, size, a, l, r, n, score`` at each phrase's weakest cut.

    Products take up to 38 digits: enough while a language has fewer than 10**17 words.
    """
    parts = words.select("lang", F.col("word").alias("part"), "n").unionByName(
        phrases.select("lang", F.col("phrase").alias("part"), "n")
    )
    totals = words.groupBy("lang").agg(F.sum("n").alias("total"))
    cut = F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k")
    cuts = phrases.select("lang", "phrase", "size", F.col("n").alias("a"), cut)
    cuts = cuts.withColumn("first", _words("phrase", 1, F.col("k")))
    cuts = cuts.withColumn("rest", _words("phrase", F.col("k") + 1, F.col("size") - F.col("k")))
    left = parts.select("lang", F.col("part").alias("first"), F.col("n").alias("l"))
    right = parts.select("lang", F.col("part").alias("rest"), F.col("n").alias("r"))
    cuts = cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"]).join(F.broadcast(totals), "lang")
    exact = lambda name: F.col(name).cast("decimal(19,0)")
    over = (exact("a") * exact("total")).cast("decimal(35,0)") * F.lit(1000).cast("decimal(4,0)")
    under = exact("l") * exact("r")
    score = F.expr("cast(over div under as bigint)")
    cuts = cuts.withColumn("over", over.cast("decimal(38,0)")).withColumn("under", under.cast("decimal(38,0)"))
    best = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("best")
    found = cuts.groupBy("lang", "phrase", "size", "a", "total").agg(best)
    return found.select("lang", "phrase", "size", "a", "best.l", "best.r", F.col("total").alias("n"), "best.score")


def _alone(found: DataFrame, share: int) -> DataFrame:
    """Leaves out phrases within a longer one that has at least ``share`` percent of their count."""
    size = F.explode(F.sequence(F.lit(2), F.col("size") - 1)).alias("inner")
    inner = found.where(F.col("size") > 2).select("lang", "phrase", "size", "a", size)
    at = F.explode(F.sequence(F.lit(1), F.col("size") - F.col("inner") + 1)).alias("at")
    inner = inner.select("*", at).select("lang", _words("phrase", F.col("at"), F.col("inner")).alias("phrase"), "a")
    inner = inner.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = found.join(inner, ["lang", "phrase"], "left")
    return kept.where(F.coalesce(F.col("longer") * 100 < F.col("a") * share, F.lit(True))).drop("longer")


def first_of_each(rows: DataFrame, count: int, top: int, lot: int = LOT) -> DataFrame:
    """The first ``top`` rows of each language with their ``rank``, of at most ``count`` rows.

    No task ranks a whole language. Shares of it, by hash of the phrase, pass on their own first
    rows, among which the language's must be, until what is left of it is some ``lot * top`` rows.
    """
    order = F.desc("score"), F.desc("a"), F.col("phrase")
    shares = count // (lot * top)
    while shares > 1:
        share = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(shares))).orderBy(*order)
        rows = rows.withColumn("rank", F.row_number().over(share)).where(F.col("rank") <= top).drop("rank")
        shares //= lot
    whole = Window.partitionBy("lang").orderBy(*order)
    return rows.withColumn("rank", F.row_number().over(whole).cast("long")).where(F.col("rank") <= top)


def mine(docs: DataFrame, least: int = 100, top: int = 2000, share: int = 100, part: int = PART) -> DataFrame:
    """The first ``top`` collocations of each language: ``lang, rank, phrase, a, l, r, n, score, size``.

    Candidates are phrases of two to five words within a piece of text that occur ``least``
    times or more. Each is scored ``floor(1000 * a * n / (l * r))`` at the cut where that is
    lowest, ties at the first such cut. Candidates inside a longer one with ``share`` percent of
    their count are left out. Order: score and count descending, then phrase in byte order.

    A null language counts as ``und``, a null text as empty. doc_id is not looked at: rows
    given twice count twice, and null ids like others. An empty table, or one without a
    phrase of ``least`` occurrences, gives an empty result. Other columns are not looked at.
    """
    texts = texts_of(docs)
    words = materialise(word_counts(texts), "phrase-words")
    phrases = materialise(phrase_counts(texts, words, least, part), "phrases")
    found = materialise(scored(phrases, words), "phrase-scores")
    kept = first_of_each(_alone(found, share), found.count(), top)
    return kept.select("lang", "rank", "phrase", "a", "l", "r", "n", "score", "size")
