"""Cut out passages that repeat across documents, by a distributed sparse suffix array.

A suffix begins at a sampled position: the least hashed 24-byte run of some 50-byte window.
Every window so has one suffix, found from its own bytes alone, and equal windows have equal
suffixes at equal places. Suffixes are range-partitioned by their leading bytes at sampled
splitters, so windows can only be equal within a bucket; each bucket sorts its windows by
multikey quicksort, and a run of equal windows keeps the smallest doc_id's. Leading bytes so
frequent that they cross a splitter are taken apart into their windows, which are then dealt
by the whole window: equal windows meet again in one bucket, and each task sends each only
once. Before any bytes travel, buckets tell each other short hashes of their leading bytes,
and only suffixes whose leading bytes another document has are sent.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from posttags.llm.common import whole_text
from posttags.session import stage_path

WINDOW, GRAM = 50, 24
REACH = WINDOW - GRAM + 1  # runs in a window
ROW = 80  # bytes of a suffix record: up to REACH windows, padded to whole words
# Bytes of text a task looks at together, and bytes of text for each bucket.
SLICE, BUCKET = 4_000_000, 16_000_000
# Bytes of text that splitters are sampled from, and one run in so many of theirs.
SAMPLE, THIN = 4_000_000, 16
# Windows a bucket sorts at once; runs of equal leading bytes are not taken apart.
SORTED = 400_000
NO_ID = -(1 << 63)
_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
_PART = np.dtype([("doc", "<i8"), ("start", "<i8"), ("end", "<i8")])
_HEAD = np.dtype([("doc", "<i8"), ("start", "<u4"), ("at", "u1"), ("windows", "u1")])


def _mix(words: np.ndarray) -> np.ndarray:
    words = words * _A
    words ^= words >> np.uint64(32)
    return words * _B


def _words_at(data: np.ndarray, kind: str, size: int) -> np.ndarray:
    """A view of the ``size``-byte item beginning at each byte."""
    return np.ndarray((len(data) - size + 1,), kind, data.tobytes(), strides=(1,))


def suffixes(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The sampled suffixes of texts that stand one after another in ``data`` up to ``ends``.

    Returns for each the place of its leading bytes and the first and last of the windows
    that it stands for. Windows across two texts have none.
    """
    windows = len(data) - WINDOW + 1
    if windows < 1:
        return (np.empty(0, np.int64),) * 3
    word = _words_at(data, "<u8", 8).copy()
    runs = len(data) - GRAM + 1
    rank = _mix(word[:runs]) + _mix(word[8 : runs + 8] ^ _C)
    rank = _mix(rank ^ (rank >> np.uint64(29)) ^ _mix(word[16 : runs + 16] + _C))
    bits = np.uint64(max(20, int(runs).bit_length()))
    rank = (rank >> bits << bits) | np.arange(runs, dtype=np.uint64)  # ties: the leftmost
    least, width = rank, 1
    while 2 * width <= REACH:
        least, width = np.minimum(least[:-width], least[width:]), 2 * width
    least = np.minimum(least[:windows], least[REACH - width : REACH - width + windows])
    owner = (least & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    whole = np.ones(windows, bool)
    for end in ends[:-1].tolist():
        whole[max(0, end - WINDOW + 1) : end] = False
    place = np.flatnonzero(whole)
    if not len(place):
        return (np.empty(0, np.int64),) * 3
    owner = owner[place]
    change = np.flatnonzero((owner[1:] != owner[:-1]) | (place[1:] != place[:-1] + 1)) + 1
    first = np.concatenate([[0], change])
    last = np.concatenate([change, [len(place)]]) - 1
    return owner[first], place[first], place[last]


def _rows(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The bytes of each record, zeros after its length."""
    padded = np.concatenate([data, np.zeros(ROW, np.uint8)])
    rows = _words_at(padded, f"V{ROW}", ROW)[start].view(np.uint8).reshape(-1, ROW)
    rows[np.arange(ROW) >= length[:, None]] = 0
    return rows


def _digest(rows: np.ndarray, salt: np.ndarray) -> np.ndarray:
    total = salt.astype(np.uint64) * _C
    for word in rows.view("<u8").T:
        total = (total ^ (total >> np.uint64(31))) * _B + _mix(word)
    return _mix(total)


def _beyond_least(key: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Which rows have a larger doc than some row with an equal key."""
    order = np.lexsort((doc, key))
    new = np.concatenate([[True], key[order][1:] != key[order][:-1]]) if len(key) else np.empty(0, bool)
    least = doc[order][np.maximum.accumulate(np.where(new, np.arange(len(key)), 0))]
    beyond = np.empty(len(key), bool)
    beyond[order] = doc[order] > least
    return beyond


def multikey_sort(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The lexicographic order of rows of words, and where runs of equal rows begin.

    Multikey quicksort with words for keys: sort by the first, then within each run of equal
    keys by the next, until runs have one row or no word is left.
    """
    order = np.argsort(words[:, 0], kind="stable")
    new = np.ones(len(order), bool)
    new[1:] = words[order[1:], 0] != words[order[:-1], 0]
    for depth in range(1, words.shape[1]):
        run = np.cumsum(new)
        alone = new & np.concatenate([new[1:], [True]])
        open_at = np.flatnonzero(~alone)
        if not len(open_at):
            break
        rows = order[open_at]
        inner = np.lexsort((words[rows, depth], run[open_at]))
        order[open_at] = rows[inner]
        key = words[order[open_at], depth]
        new[open_at[1:]] |= (key[1:] != key[:-1]) & (run[open_at[1:]] == run[open_at[:-1]])
    return order, new


def _equal_windows(rows: np.ndarray, start: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Which windows, at ``start`` in the flat ``rows``, equal one of a smaller doc."""
    flat = np.concatenate([rows.ravel(), np.zeros(ROW, np.uint8)])
    window = np.zeros((len(start), 56), np.uint8)
    window[:, :WINDOW] = _words_at(flat, f"V{WINDOW}", WINDOW)[start].view(np.uint8).reshape(-1, WINDOW)
    order, new = multikey_sort(window.view(">u8").astype(np.uint64))
    begins = np.flatnonzero(new)
    least = np.minimum.reduceat(doc[order], begins)
    beyond = np.empty(len(start), bool)
    beyond[order] = doc[order] > np.repeat(least, np.diff(np.concatenate([begins, [len(order)]])))
    return beyond


def _merged(parts: np.ndarray) -> np.ndarray:
    """Overlapping and touching parts of a document joined."""
    if not len(parts):
        return parts
    parts = parts[np.lexsort((parts["start"], parts["doc"]))]
    change = parts["doc"][1:] != parts["doc"][:-1]
    if np.any(parts["end"][1:] < parts["end"][:-1], where=~change):
        bounds = np.concatenate([[0], np.flatnonzero(change) + 1, [len(parts)]])
        for a, b in zip(bounds[:-1], bounds[1:]):
            parts["end"][a:b] = np.maximum.accumulate(parts["end"][a:b])
    new = np.concatenate([[True], change | (parts["start"][1:] > parts["end"][:-1])])
    out = parts[new].copy()
    out["end"] = np.maximum.reduceat(parts["end"], np.flatnonzero(new))
    return out


def _parts(doc: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    out = np.empty(len(doc), _PART)
    out["doc"], out["start"], out["end"] = doc, start, end
    return out


def _slices(texts: pa.Table | pa.RecordBatch) -> Iterator[tuple[np.ndarray, ...]]:
    """``doc, text`` rows as joined bytes of about SLICE: data, ends, docs, offsets.

    Longer texts come in pieces that overlap by one byte less than a window, so each window
    is whole in exactly one; an offset is the place of a piece in its text.
    """
    held: list[tuple[int, int, bytes]] = []

    def joined() -> tuple[np.ndarray, ...]:
        data = np.frombuffer(b"".join(piece for _, _, piece in held), np.uint8)
        ends = np.cumsum([len(piece) for _, _, piece in held])
        docs, offsets = np.array([(doc, at) for doc, at, _ in held], np.int64).T
        return data, ends, docs, offsets

    size = 0
    for doc, text in zip(texts.column("doc").to_pylist(), texts.column("text")):
        data = text.as_py().encode()
        for at in range(0, max(1, len(data) - WINDOW + 1), SLICE):
            piece = data[at : at + SLICE + WINDOW - 1]
            if held and size + len(piece) > SLICE:
                yield joined()
                held, size = [], 0
            held.append((doc, at, piece))
            size += len(piece)
    if held:
        yield joined()


def _pack(*arrays: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(b"".join(a.tobytes() for a in arrays))


def _unpack(load: bytes, kind) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(load), kind)


def _by(bucket: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each bucket with the places that have it, in their order."""
    order = np.argsort(bucket, kind="stable")
    cuts = np.flatnonzero(np.diff(bucket[order])) + 1
    for part in np.split(order, cuts):
        if len(part):
            yield int(bucket[part[0]]), part


def _lead_hash(data: np.ndarray, place: np.ndarray) -> np.ndarray:
    word = _words_at(data, "<u8", 8)
    total = _mix(word[place]) ^ _C
    for at in (8, 16):
        total = _mix(total ^ (total >> np.uint64(29)) ^ word[place + at])
    return total ^ (total >> np.uint64(32))


class _Router:
    """Deals suffixes to buckets by their leading bytes."""

    def __init__(self, sample: list[bytes], buckets: int):
        sample = sorted(sample)
        at = [sample[len(sample) * i // buckets] for i in range(1, buckets)] if sample else []
        self.buckets, self.splitters = buckets, np.array(at, f"S{GRAM}")
        again = {a for a, b in zip(at, at[1:]) if a == b}
        self.hot = np.array(sorted(again), f"S{GRAM}")

    def deal(self, data: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bucket of each suffix, and whether its leading bytes are too frequent for one."""
        lead = np.ascontiguousarray(_words_at(data, f"S{GRAM}", GRAM)[place])
        bucket = np.searchsorted(self.splitters, lead, side="right")
        hot = np.zeros(len(place), bool)
        if len(self.hot):
            near = np.minimum(np.searchsorted(self.hot, lead), len(self.hot) - 1)
            hot = self.hot[near] == lead
        return bucket, hot


def _announce(router: _Router):
    """Task code for a bucket of documents: short hashes of the leading bytes it has."""

    def announce(texts: pa.Table) -> pa.Table:
        found = []
        for data, ends, _, _ in _slices(texts):
            place, _, _ = suffixes(data, ends)
            if len(place):
                bucket, hot = router.deal(data, place)
                short = (_lead_hash(data, place) >> np.uint64(32)).astype(np.int64)
                found.append(np.unique((bucket << 32 | short)[~hot]))
        both = np.unique(np.concatenate(found)) if found else np.empty(0, np.int64)
        out = []
        for bucket, part in _by(both >> 32):
            short = (both[part] & 0xFFFFFFFF).astype("<u4")
            out.append((bucket, _pack(np.diff(short, prepend=np.uint32(0)))))
        return pa.table(
            {
                "bucket": pa.array([o[0] for o in out], pa.int32()),
                "dealt": pa.array([texts.column("dealt")[0].as_py()] * len(out), pa.int64()),
                "load": pa.array([o[1] for o in out], pa.binary()),
            }
        )

    return announce


def _answer(bucket: pa.Table) -> pa.Table:
    """Task code for a bucket of leading bytes: who has some that others have too.

    Two leading bytes with one hash only cost a needless look.
    """
    lists = [np.cumsum(_unpack(x, "<u4"), dtype=np.uint32) for x in bucket.column("load").to_pylist()]
    short, times = np.unique(np.concatenate(lists), return_counts=True)
    shared = short[times > 1]
    loads = [_pack(own[np.isin(own, shared, assume_unique=True)]) for own in lists]
    return bucket.set_column(2, "load", pa.array(loads, pa.binary()))


def _collect(router: _Router):
    """Task code for a bucket of documents: suffix records for each bucket of leading bytes.

    Only suffixes whose leading bytes another document has are sent, and of equal ones here
    only the smallest document's; the others' parts are settled at once.
    """

    def collect(texts: pa.Table, answers: pa.Table) -> pa.Table:
        asked = zip(answers.column("bucket").to_pylist(), answers.column("load").to_pylist())
        wanted = [b << 32 | _unpack(x, "<u4").astype(np.int64) for b, x in asked]
        wanted = np.concatenate(wanted) if wanted else np.empty(0, np.int64)
        found = []
        for data, ends, docs, offsets in _slices(texts):
            place, first, last = suffixes(data, ends)
            if not len(place):
                continue
            bucket, hot = router.deal(data, place)
            owner = np.searchsorted(ends, first, side="right")
            found.append((data, ends, docs, offsets, place, first, last, bucket, hot, owner))
        if not found:
            return _loads([])
        lead = np.concatenate([_lead_hash(f[0], f[4]) for f in found])
        doc = np.concatenate([f[2][f[9]] for f in found])
        bucket = np.concatenate([f[7] for f in found])
        shared = np.isin(bucket << 32 | (lead >> np.uint64(32)).astype(np.int64), wanted)
        shared |= _of_many(lead, doc) | np.concatenate([f[8] for f in found])
        heads, rows, buckets, at = [], [], [], 0
        for data, ends, docs, offsets, place, first, last, bucket, hot, owner in found:
            use = np.flatnonzero(shared[at : at + len(place)])
            at += len(place)
            # a hot suffix becomes one record for each window
            many = np.where(hot[use], last[use] - first[use] + 1, 1)
            which = np.repeat(use, many)
            step = np.arange(len(which)) - np.repeat(np.cumsum(many) - many, many)
            single, begin = hot[which], first[which]
            begin = begin + np.where(single, step, 0)
            end = np.where(single, begin, last[which])
            head = np.empty(len(which), _HEAD)
            head["doc"] = docs[owner[which]]
            start_of = np.concatenate([[0], ends[:-1]])
            head["start"] = begin - start_of[owner[which]] + offsets[owner[which]]
            head["at"] = np.where(single, 0, place[which] - first[which])
            head["windows"] = end - begin + 1
            heads.append(head)
            rows.append(_rows(data, begin, end - begin + WINDOW))
            buckets.append(np.where(single, -1, bucket[which]))
        head, row, bucket = np.concatenate(heads), np.concatenate(rows), np.concatenate(buckets)
        key = _record_key(head, row)
        bucket = np.where(bucket < 0, (key >> np.uint64(40)).astype(np.int64) % router.buckets, bucket)
        settled = _beyond_least(key, head["doc"])
        parts = _merged(_spans(head[settled]))
        out = []
        if len(parts):
            out.append((texts.column("dealt")[0].as_py() % router.buckets, 2, _pack(parts)))
        left = np.flatnonzero(~settled)
        left = left[np.argsort(lead_order(head, row)[left], kind="stable")]
        for number, part in _by(bucket[left]):
            out.append((number, 1, _pack(head[left[part]], row[left[part]])))
        return _loads(out)

    return collect


def _loads(out: list[tuple[int, int, bytes]]) -> pa.Table:
    return pa.table(
        {
            "bucket": pa.array([o[0] for o in out], pa.int32()),
            "kind": pa.array([o[1] for o in out], pa.int32()),
            "load": pa.array([o[2] for o in out], pa.binary()),
        }
    )


def _of_many(key: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Which rows share their key with a row of another doc."""
    order = np.lexsort((doc, key))
    new = np.concatenate([[True], key[order][1:] != key[order][:-1]])
    begins = np.flatnonzero(new)
    sizes = np.diff(np.concatenate([begins, [len(key)]]))
    many = doc[order[begins]] != doc[order[begins + sizes - 1]]
    out = np.empty(len(key), bool)
    out[order] = np.repeat(many, sizes)
    return out


def _record_key(head: np.ndarray, rows: np.ndarray) -> np.ndarray:
    return _digest(rows, head["at"].astype(np.int64) * 256 + head["windows"])


def lead_order(head: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The first word of the leading bytes, so that records travel in suffix order."""
    place = np.arange(len(rows), dtype=np.int64) * ROW + head["at"]
    return _words_at(rows.ravel(), ">u8", 8)[place].astype(np.uint64) if len(rows) else place


def _spans(head: np.ndarray) -> np.ndarray:
    start = head["start"].astype(np.int64)
    return _parts(head["doc"], start, start + head["windows"] + WINDOW - 1)


def _settle(head: np.ndarray, rows: np.ndarray) -> list[np.ndarray]:
    """The repeated parts among the suffix records of one bucket."""
    beyond = _beyond_least(_record_key(head, rows), head["doc"])
    begin = head["start"].astype(np.int64)
    found = [_spans(head[beyond])]
    # of equal records the smallest doc's is left; only records that share their leading
    # bytes with another doc can have equal windows
    left = np.flatnonzero(~beyond)
    if not len(left):
        return found
    flat = np.concatenate([rows.ravel(), np.zeros(ROW, np.uint8)])
    lead = np.zeros((len(left), ROW), np.uint8)
    lead[:, :GRAM] = _words_at(flat, f"V{GRAM}", GRAM)[left * ROW + head["at"][left]].view(np.uint8).reshape(-1, GRAM)
    key = _digest(lead, np.zeros(len(left), np.int64))
    order = np.lexsort((head["doc"][left], key))
    left, key = left[order], key[order]
    new = np.concatenate([[True], key[1:] != key[:-1]])
    begins = np.flatnonzero(new)
    ends = np.concatenate([begins[1:], [len(left)]])
    shared = head["doc"][left[begins]] != head["doc"][left[ends - 1]]
    held: list[np.ndarray] = []
    size = 0
    runs = [(int(a), int(b)) for a, b in zip(begins[shared], ends[shared])]
    for number, (a, b) in enumerate(runs):
        held.append(left[a:b])
        size += int(head["windows"][left[a:b]].sum())
        if size >= SORTED or number + 1 == len(runs):
            at = np.concatenate(held)
            many = head["windows"][at].astype(np.int64)
            which = np.repeat(at, many)
            step = np.arange(len(which)) - np.repeat(np.cumsum(many) - many, many)
            hit = _equal_windows(rows, which * ROW + step, head["doc"][which])
            start = begin[which[hit]] + step[hit]
            found.append(_merged(_parts(head["doc"][which[hit]], start, start + WINDOW)))
            held, size = [], 0
    return found


def _judge(doc_buckets: int):
    """Task code for a bucket: all repeated parts, dealt by document."""

    def judge(bucket: pa.Table) -> pa.Table:
        heads, rows, found = [], [], []
        for kind, load in zip(bucket.column("kind").to_pylist(), bucket.column("load").to_pylist()):
            load = _unpack(load, np.uint8)
            if kind == 2:
                found.append(load.view(_PART))
                continue
            n = len(load) // (_HEAD.itemsize + ROW)
            heads.append(load[: n * _HEAD.itemsize].view(_HEAD))
            rows.append(load[n * _HEAD.itemsize :].reshape(n, ROW))
        if heads:
            found += _settle(np.concatenate(heads), np.concatenate(rows))
        parts = _merged(np.concatenate(found)) if found else np.empty(0, _PART)
        out = [(target, _pack(parts[at])) for target, at in _by(parts["doc"] % doc_buckets)]
        return pa.table(
            {
                "dealt": pa.array([o[0] for o in out], pa.int64()),
                "load": pa.array([o[1] for o in out], pa.binary()),
            }
        )

    return judge


def _cut(texts: pa.Table, loads: pa.Table) -> pa.Table:
    """Task code for a bucket of documents: take the parts out."""
    found = [_unpack(x, _PART) for x in loads.column("load").to_pylist()]
    parts = _merged(np.concatenate(found)) if found else np.empty(0, _PART)
    rows = []
    for doc, text in zip(texts.column("doc").to_pylist(), texts.column("text")):
        data = text.as_py().encode()
        a, b = np.searchsorted(parts["doc"], [doc, doc + 1]) if doc < (1 << 63) - 1 else (0, 0)
        kept, at, removed = hashlib.sha256(), 0, 0
        for start, end in parts[a:b][["start", "end"]].tolist():
            kept.update(data[at:start])
            removed += min(end, len(data)) - min(start, len(data))
            at = end
        kept.update(data[at:])
        rows.append((None if doc == NO_ID else doc, len(data), removed, int(b - a), kept.hexdigest()))
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    kinds = [pa.int64()] * 4 + [pa.string()]
    columns = zip(*rows) if rows else [[]] * 5
    return pa.table({n: pa.array(list(c), k) for n, c, k in zip(names, columns, kinds)})


def _prime(least: int) -> int:
    while any(least % d == 0 for d in range(2, int(least**0.5) + 1)):
        least += 1
    return least


def remove_repeats(docs: DataFrame, bucket_bytes: int = BUCKET) -> DataFrame:
    """Cut every 50-byte string that a document with a smaller doc_id also has.

    Returns one row per input row: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256``.
    Strings are of UTF-8 bytes, may overlap, never cross texts, and are judged on the input.

    Null and short texts keep all they have. A null doc_id counts as smaller than any other.
    Rows that share a doc_id are one document: they do not repeat each other, and a part that
    is cut from one is cut from all at the same place. An empty table gives an empty result.
    Very long texts are read in overlapping pieces. Other columns are not looked at.
    """
    spark = docs.sparkSession
    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))
    rows = docs.select(doc.alias("doc"), whole_text().alias("text"))
    total = rows.agg(F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0))).first()[0]
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(least, -(-total // bucket_bytes))
    router = _Router(_sampled(rows, total), buckets)
    doc_buckets = _prime(max(3, buckets))
    # read three times, so dealt out once and kept that way
    texts = bucketed(rows.withColumn("dealt", F.pmod("doc", F.lit(doc_buckets))), "dealt", doc_buckets)
    asked = texts.groupBy("dealt").applyInArrow(
        _announce(router), "bucket int, dealt long, load binary"
    )
    answers = asked.groupBy("bucket").applyInArrow(_answer, "bucket int, dealt long, load binary")
    records = (
        texts.groupBy("dealt")
        .cogroup(answers.groupBy("dealt"))
        .applyInArrow(_collect(router), "bucket int, kind int, load binary")
    )
    parts = records.groupBy("bucket").applyInArrow(_judge(doc_buckets), "dealt long, load binary")
    return (
        texts.groupBy("dealt")
        .cogroup(parts.groupBy("dealt"))
        .applyInArrow(
            _cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
        )
    )


def bucketed(rows: DataFrame, key: str, buckets: int) -> DataFrame:
    """``rows`` as a stage in the shared folder, one file for each bucket of ``key``."""
    spark, path = rows.sparkSession, stage_path(rows.sparkSession, "dealt")
    table = "dealt_" + path.rsplit("-", 1)[-1]
    placed = rows.repartition(buckets, key).write.bucketBy(buckets, key).option("path", path)
    placed.saveAsTable(table)
    return spark.table(table)


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for batch in batches:
        for data, ends, _, _ in _slices(batch):
            yield data, suffixes(data, ends)[0]


def _sampled(rows: DataFrame, total: int) -> list[bytes]:
    """Leading bytes of suffixes of a sample of about SAMPLE bytes of text, thinned."""

    def lead(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for data, place in _places(batches):
            found = [data[p : p + GRAM].tobytes() for p in place[:: THIN if total > SAMPLE else 1]]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary())], ["lead"])

    share = min(1.0, SAMPLE / max(1, total))
    some = rows.sample(share, seed=7) if share < 1 else rows
    return [bytes(r.lead) for r in some.mapInArrow(lead, "lead binary").collect()]
