"""Pack token sequences into windows by Karmarkar-Karp multiway differencing.

Documents become token ids, full windows are cut off, and what is left over is packed within
bundles of bounded size by merging partial partitions with opposing imbalances.
"""

from __future__ import annotations

import heapq
import os
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from posttags.llm.common import lean, whole_text
from posttags.session import materialise

WINDOW = 1024
# Pieces per bundle: bounds the memory and time of a task, whatever the number of documents.
BUNDLE = 1500
# Words a worker remembers with their ids before it starts anew.
REMEMBER = 500_000
# Bytes of text handled at once; a longer text is handled alone.
SLICE = 4_000_000
PIECE = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]

_loaded: dict[str, "WordIds"] = {}


def _byte_alphabet() -> dict[int, str]:
    """Byte-level vocabularies write printable bytes as themselves, others from U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + n) for n, b in enumerate(hidden)}


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class WordIds:
    """Ids of texts by a tokenizer file, remembering the ids of the parts of texts.

    Texts are cut where the tokenizer never joins what stands on both sides: before a run of
    white space, and before a full stop or comma that follows a letter or digit.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.alphabet = _byte_alphabet()
        self.known: dict[str, bytes] = {}
        self.newline = self._plain("\n")

    @classmethod
    def of(cls, path: str) -> "WordIds":
        """One per worker process and file."""
        if path not in _loaded:
            _loaded[path] = cls(path)
        return _loaded[path]

    def _plain(self, word: str) -> bytes:
        """Ids of a word that the tokenizer does not split before merging."""
        mapped = word.encode().decode("latin-1").translate(self.alphabet)
        return _packed([token.id for token in self.tokenizer.model.tokenize(mapped)])

    def encode(self, words: pa.Array) -> list[bytes]:
        """The ids of each part as little-endian 32-bit numbers."""
        known, parts = self.known, words.to_pylist()
        if len(known) > REMEMBER:
            known.clear()
        found = list(map(known.get, parts))
        new = np.array([i for i, ids in enumerate(found) if ids is None], dtype=np.int64)
        if not len(new):
            return found
        simple = pc.match_substring_regex(words.take(pa.array(new)), r"^[ \n]?\pL+$")
        simple = simple.to_numpy(zero_copy_only=False)
        for i in new[simple].tolist():
            part = parts[i]
            if part[0] == "\n":
                ids = self.newline + self._plain(part[1:])
            else:
                ids = self._plain(part)
            found[i] = known[part] = ids
        mixed = new[~simple].tolist()
        for at in range(0, len(mixed), 10_000):
            some = [parts[i] for i in mixed[at : at + 10_000]]
            encoded = self.tokenizer.encode_batch_fast(some, add_special_tokens=False)
            for i, part, one in zip(mixed[at : at + 10_000], some, encoded):
                found[i] = known[part] = _packed(one.ids)
        return found

    def texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of all ``texts`` one after another, and how many each text has."""
        marked = texts
        for cut in (" ", "\n", ".", ","):
            marked = pc.replace_substring(marked, cut, "\x01" + cut)
        parts = pc.split_pattern(marked, "\x01")
        words, index, offsets = _dictionary(parts)
        odd = _odd_cuts(words, index, offsets)
        odd |= pc.match_substring(texts, "\x01").to_numpy(zero_copy_only=False)
        if odd.any():
            lists = parts.to_pylist()
            for at in np.flatnonzero(odd).tolist():
                lists[at] = re.findall(r"\s*\S+|\s+", texts[at].as_py())
            words, index, offsets = _dictionary(pa.array(lists, pa.list_(pa.string())))
        ids = self.encode(words)
        size = np.fromiter((len(i) // 4 for i in ids), np.int64, len(ids))
        pool = np.frombuffer(b"".join(ids), dtype="<u4")
        first = np.cumsum(size) - size
        take = size[index]
        ends = np.cumsum(take)
        places = np.arange(int(take.sum())) + np.repeat(first[index] - (ends - take), take)
        return pool[places], np.diff(np.concatenate([[0], ends])[offsets])


def _dictionary(parts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct parts, the number of each part in turn, and where each text's parts begin."""
    words = pc.dictionary_encode(parts.flatten())
    words = words.combine_chunks() if isinstance(words, pa.ChunkedArray) else words
    offsets = parts.offsets.to_numpy()
    index = words.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    return words.dictionary, index, (offsets - offsets[0]).astype(np.int64)


def _odd_cuts(words: pa.Array, index: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Texts with a cut inside white space, or before a stop that no letter or digit precedes."""

    def like(pattern: str) -> np.ndarray:
        found = pc.match_substring_regex(words, pattern).to_numpy(zero_copy_only=False)
        return found[index]

    if not len(index):
        return np.zeros(len(offsets) - 1, bool)
    white = r"\s\pZ\x0b\x1c-\x1f\x{85}"
    within = np.ones(len(index), bool)
    within[offsets[:-1][offsets[:-1] < len(index)]] = False  # the first part of a text
    before_ok, after_stop = like(r"[\pL\pN]$"), like(r"^[.,]")
    before_white, after_white = like(f"[{white}]$"), like(r"^[ \n]")
    bad = np.zeros(len(index), bool)
    bad[1:] = (after_stop[1:] & ~before_ok[:-1]) | (after_white[1:] & before_white[:-1])
    sums = np.concatenate([[0], np.cumsum(bad & within)])
    return sums[offsets[1:]] > sums[offsets[:-1]]


def _slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    size = pc.binary_length(texts).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for at, n in enumerate(size):
        if held and held + n > SLICE:
            yield start, at
            start, held = at, 0
        held += int(n)
    if start < len(size):
        yield start, len(size)


def token_pieces(docs: DataFrame, tokenizer: str, window: int = WINDOW) -> DataFrame:
    """Pieces of each document's ids: every full window, and the rest in half windows.

    Rows ``doc_id, start, length, ids_crc32, doc_tokens``. A document's ids end with id 0, so
    each has at least one piece. Nulls count as empty texts.
    """

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordIds.of(tokenizer)
        for batch in batches:
            doc_ids, texts = batch.column(0).to_pylist(), batch.column(1)
            for begin, end in _slices(texts):
                ids, counts = words.texts(texts.slice(begin, end - begin))
                rows, at = [], 0
                for doc_id, n in zip(doc_ids[begin:end], counts.tolist()):
                    own = ids[at : at + n].tobytes() + b"\0\0\0\0"
                    at += n
                    full = (n + 1) // window * window
                    cuts = [*range(0, full, window), *range(full, n + 1, window // 2)]
                    for start, end_at in zip(cuts, [*cuts[1:], n + 1]):
                        piece = own[start * 4 : end_at * 4]
                        rows.append((doc_id, start, end_at - start, zlib.crc32(piece), n + 1))
                columns = zip(*rows) if rows else [[]] * 5
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in columns], PIECE
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    return rows.mapInArrow(lean(pieces), ", ".join(f"{name} long" for name in PIECE))


def differencing(sizes: list[int], windows: int) -> list[list[int]]:
    """Split item positions into ``windows`` groups of near-equal sums.

    Multiway differencing: each item begins as a partial partition holding one group; the
    two partitions with the widest spread merge, the fullest groups of one meeting the
    emptiest of the other, until one is left. Groups that are empty on both sides of a merge
    are not stored, so a merge costs what its non-empty groups cost.
    """
    heap = [(-size, at, [(size, [at])]) for at, size in enumerate(sizes)]
    heapq.heapify(heap)
    order = len(heap)
    while len(heap) > 1:
        _, _, a = heapq.heappop(heap)
        _, _, b = heapq.heappop(heap)
        # a and b: non-empty groups in descending order of their sums
        meet = max(0, len(a) + len(b) - windows)
        merged = a[: len(a) - meet] + b[: len(b) - meet]
        for (x, p), (y, q) in zip(a[len(a) - meet :], reversed(b[len(b) - meet :])):
            merged.append((x + y, p + q))
        merged.sort(key=lambda g: -g[0])
        lowest = merged[-1][0] if len(merged) == windows else 0
        heapq.heappush(heap, (lowest - merged[0][0], order, merged))
        order += 1
    return [members for _, members in heap[0][2]] if heap else []


def pack_sizes(sizes: list[int], window: int) -> list[list[int]]:
    """``differencing`` into as few windows as hold the sizes, one more whenever one overflows."""
    windows = max(1, -(-sum(sizes) // window))
    while True:
        groups = differencing(sizes, windows)
        if all(sum(sizes[i] for i in g) <= window for g in groups):
            return groups
        windows += 1


def pack(docs: DataFrame, tokenizer: str, window: int = WINDOW, bundle: int = BUNDLE) -> DataFrame:
    """Pack all ``docs`` into sequences of at most ``window`` tokens.

    Returns one row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id,
    offset``. Full windows are sequences of their own; the pieces of what is left are at most
    half a window and are packed by differencing within bundles of about ``bundle`` pieces,
    dealt by document and start. Sequence numbers are unique, not gapless.

    Null and empty texts are one piece of length 1. Long texts spread over bundles. Rows
    given twice are packed twice; null doc_ids are packed like others. An empty table gives
    an empty result. Other columns are not looked at.
    """
    pieces = materialise(token_pieces(docs, tokenizer, window), "pieces")
    bundles = max(1, -(-pieces.count() // bundle))

    def sequences(group: pa.Table) -> pa.Table:
        group = group.sort_by([("length", "descending"), ("doc_id", "ascending"), ("start", "ascending")])
        lengths = group.column("length").to_pylist()
        full = sum(n == window for n in lengths)
        windows = [[at] for at in range(full)]
        windows += [[full + i for i in w] for w in pack_sizes(lengths[full:], window)]
        number, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
        first = group.column("bundle")[0].as_py() << 32
        for at, members in enumerate(windows):
            filled = 0
            for i in sorted(members):
                number[i], offset[i] = first + at, filled
                filled += lengths[i]
        group = group.drop_columns(["bundle"])
        return group.append_column("sequence_id", pa.array(number)).append_column(
            "offset", pa.array(offset)
        )

    columns = ", ".join(f"{name} long" for name in [*PIECE, "sequence_id", "offset"])
    dealt = F.pmod(F.xxhash64("doc_id", "start"), F.lit(bundles)).cast("long")
    return pieces.withColumn("bundle", dealt).groupBy("bundle").applyInArrow(sequences, columns)
