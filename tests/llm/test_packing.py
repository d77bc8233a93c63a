import random
import zlib
from itertools import product

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest

from posttags.llm import packing
from tests.llm.conftest import table

PATH = str(public_tokenizers.path("byte_bpe_50k.json"))
ODD = [
    "a\n \n b ...x", "  x \n\n  y 's don't  ", "é  　x\x1c y <|endoftext|> z", "\n\n", "", "a . b,c ,d",
    "x\x01y. z", "1.5, 2,5 .,. end.", "tab\tand  space \n", "THE!! END!!,\n.", " ",
]


def plain(text):
    return packing.WordIds.of(PATH).tokenizer.encode(text, add_special_tokens=False).ids


def test_ids_equal_the_tokenizer(prose):
    texts = ODD + [t for _, t in prose]
    ids, counts = packing.WordIds.of(PATH).texts(pa.array(texts))
    parts = np.split(ids, np.cumsum(counts)[:-1])
    assert [p.tolist() for p in parts] == [plain(t) for t in texts]


@pytest.mark.parametrize("window, bundle", [(1024, 1500), (64, 20)])
def test_pack(spark, messy, window, bundle):
    rows = [*messy, *((40_000 + i, t) for i, t in enumerate(ODD))]
    got = packing.pack(table(spark, rows), PATH, window, bundle).collect()
    pieces, sequences = {}, {}
    for r in got:
        pieces.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append(r)
    texts = {i: t for i, t in rows if i is not None and i != 20_001}
    for doc_id, text in texts.items():
        ids, at = [*plain(text or ""), 0], 0
        for r in sorted(pieces[doc_id], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            part = np.array(ids[at : at + r.length], "<u4").tobytes()
            assert r.ids_crc32 == zlib.crc32(part)
            at += r.length
        assert at == len(ids)
    assert len(pieces[20_001]) % 2 == 0 and None in pieces
    for found in sequences.values():
        at = 0
        for r in sorted(found, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= window


def test_empty_table(spark):
    assert packing.pack(table(spark, []), PATH).collect() == []


def test_differencing_is_near_the_best_split():
    rnd = random.Random(1)
    for _ in range(20):
        sizes = [rnd.randint(1, 60) for _ in range(7)]
        groups = packing.differencing(sizes, 3)
        assert sorted(i for g in groups for i in g) == list(range(7))
        widest = max(sum(sizes[i] for i in g) for g in groups)
        best = min(max(sum(s for s, k in zip(sizes, way) if k == j) for j in range(3)) for way in product(range(3), repeat=7))
        assert widest <= 7 / 6 * best + 1


def test_windows_rise_until_all_fit():
    groups = packing.pack_sizes([600, 600, 600], 1000)
    assert sorted(map(len, groups)) == [1, 1, 1]
    assert packing.pack_sizes([], 1000) == []
    rnd = random.Random(2)
    sizes = [rnd.randint(1, 512) for _ in range(900)]
    groups = packing.pack_sizes(sizes, 1024)
    assert all(sum(sizes[i] for i in g) <= 1024 for g in groups)
    assert len(groups) * 1024 <= sum(sizes) * 1.02
