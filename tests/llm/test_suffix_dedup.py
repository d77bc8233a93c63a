import hashlib
import random

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest

from posttags.llm import suffix_dedup
from tests.llm.conftest import table


def brute(rows):
    first = {}
    key = lambda i: suffix_dedup.NO_ID if i is None else i
    for doc_id, text in rows:
        data = (text or "").encode()
        for at in range(len(data) - 49):
            run = data[at : at + 50]
            first[run] = min(first.get(run, key(doc_id)), key(doc_id))
    out = []
    for doc_id, text in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for at in range(len(data) - 49):
            if first[data[at : at + 50]] < key(doc_id):
                gone[at : at + 50] = b"\1" * 50
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        kept = bytes(b for b, g in zip(data, gone) if not g)
        out.append((doc_id, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("bucket_bytes", [16_000_000, 2000])
def test_equals_brute_force(spark, prose, bucket_bytes):
    rows = [*prose, (20_000, None), (None, "no id here " * 9), (20_001, prose[0][1]), (20_001, prose[0][1])]
    got = suffix_dedup.remove_repeats(table(spark, rows), bucket_bytes)
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows)


def test_empty_table(spark):
    assert suffix_dedup.remove_repeats(table(spark, [])).collect() == []


def passages(rnd, n):
    """Texts put together from a few passages, parts of them, and noise."""
    shared = ["".join(rnd.choice("abcd é\n") for _ in range(rnd.choice([45, 50, 51, 60, 90, 200]))) for _ in range(6)]
    shared += ["a" * 120, "the common line that everybody has in the text, always.\n"]
    docs = {}
    for _ in range(n):
        text = ""
        for _ in range(rnd.randint(0, 6)):
            if rnd.random() < 0.6:
                text += rnd.choice(shared)[rnd.randint(0, 12) :]
            else:
                text += "".join(rnd.choice("abcdefgh ") for _ in range(rnd.randint(0, 150)))
        docs[rnd.randint(0, 10**6)] = text
    return list(docs.items())


@pytest.mark.parametrize("buckets, piece", [(1, 10**6), (4, 500), (9, 300), (40, 2000), (200, 10**6)])
def test_tasks_agree_for_any_buckets_and_pieces(monkeypatch, buckets, piece):
    """The task code alone, with texts cut into pieces and leading bytes too frequent for one."""
    monkeypatch.setattr(suffix_dedup, "SLICE", piece)
    rows, dealt = passages(random.Random(buckets), 50), 5
    groups = [
        pa.table(
            {
                "doc": pa.array([i for i, _ in rows if i % dealt == k], pa.int64()),
                "text": pa.array([t for i, t in rows if i % dealt == k], pa.string()),
                "dealt": pa.array([k for i, _ in rows if i % dealt == k], pa.int64()),
            }
        )
        for k in range(dealt)
    ]
    sample = [data[p : p + 24].tobytes() for data, at in suffix_dedup._places(groups) for p in at]
    router = suffix_dedup._Router(sample, buckets)
    assert buckets < 200 or len(router.hot)

    def of(frame, name, value):
        return frame.filter(pc.equal(frame.column(name), value))

    asked = pa.concat_tables([suffix_dedup._announce(router)(g) for g in groups])
    some = set(asked.column("bucket").to_pylist())
    told = pa.concat_tables([suffix_dedup._answer(of(asked, "bucket", b)) for b in some])
    records = [suffix_dedup._collect(router)(g, of(told, "dealt", k)) for k, g in enumerate(groups)]
    records = pa.concat_tables(records)
    judge = suffix_dedup._judge(dealt)
    parts = pa.concat_tables([judge(of(records, "bucket", b)) for b in set(records.column("bucket").to_pylist())])
    cut = [suffix_dedup._cut(g, of(parts, "dealt", k)) for k, g in enumerate(groups)]
    got = [tuple(row.values()) for part in cut for row in part.to_pylist()]
    assert sorted(got, key=repr) == brute(rows)


def test_multikey_sort_is_lexicographic():
    rnd = np.random.default_rng(2)
    words = rnd.integers(0, 3, (500, 6)).astype(np.uint64)
    order, new = suffix_dedup.multikey_sort(words)
    rows = [tuple(r) for r in words[order].tolist()]
    assert rows == sorted(map(tuple, words.tolist()))
    assert new.tolist() == [True] + [a != b for a, b in zip(rows, rows[1:])]
