import math
import random
import string
from itertools import combinations

import numpy as np
import pytest

from posttags.llm import minhash
from posttags.llm.components import components
from posttags.llm.shingles import shingle_set
from tests.llm.conftest import as_dict, table

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def shingles(text):
    words = (text or "").translate(LOWER).encode().split()
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def classes(nodes, links):
    label = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            if label[a] != low or label[b] != low:
                label[a] = label[b] = low
                changed = True
    return label


def brute(rows):
    sets = {i: shingles(t) for i, t in rows}
    links = []
    for a, b in combinations(sets, 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
            links.append((a, b))
    label = classes(sets, links)
    return {i: (len(sets[i]), label[i], label[i] == i) for i in sets}


def check(spark, rows, **options):
    got = minhash.near_duplicates(table(spark, rows), **options).collect()
    known = [(i, t) for i, t in rows if i is not None]
    assert sorted(r.doc_id or -1 for r in got) == sorted(i or -1 for i, _ in rows)
    want = brute(known)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id, r.kept) == want[r.doc_id]


def test_equals_brute_force(spark, messy):
    check(spark, messy)


@pytest.mark.parametrize("tile", [1500, 5])
def test_chain_of_near_copies(spark, tile):
    """Copies drift away from the first, so buckets hold several components after round one."""
    rnd = random.Random(8)
    words = [f"w{i}" for i in range(300)]
    rows, text = [], [rnd.choice(words) for _ in range(120)]
    for i in range(60):
        rows.append((1000 - 7 * i, " ".join(text)))
        for _ in range(2):
            text[rnd.randrange(120)] = rnd.choice(words)
    check(spark, rows, tile=tile)


def test_large_group_of_copies(spark):
    rnd = random.Random(9)
    base = [f"v{rnd.randrange(200)}" for _ in range(80)]
    rows = [(i, " ".join(base)) for i in range(300)]
    for i in range(300, 420):
        copy = list(base)
        copy[rnd.randrange(80)] = "other"
        rows.append((i, " ".join(copy)))
    check(spark, rows)


def test_empty_table(spark):
    assert minhash.near_duplicates(table(spark, [])).collect() == []


def test_signatures_estimate_similarity():
    rnd = np.random.default_rng(4)
    both, left, right = (rnd.integers(0, 1 << 63, n).astype(np.uint64) for n in (300, 50, 50))
    a = minhash.signature(np.concatenate([both, left]))
    b = minhash.signature(np.concatenate([both, right]))
    assert abs((a == b).mean() - 0.75) < 0.16 and len(a) == 128


def test_shingles_of_short_and_repeated_texts():
    assert len(shingle_set("")) == 0 and len(shingle_set(" \t\n")) == 0
    assert len(shingle_set("a b")) == 1 == len(shingle_set("a a a a a a a a"))
    assert shingle_set("A b") == shingle_set("a B") and shingle_set("a b") != shingle_set("a b b")
    assert len(shingle_set("a\x0bb\x0cc\rd\te f")) == 2


def test_components(spark):
    rnd = random.Random(5)
    links = [(rnd.randrange(80), rnd.randrange(80)) for _ in range(60)] + [(100 + i, 101 + i) for i in range(40)]
    links += [(500, i) for i in range(600, 660)]
    got = as_dict(components(spark.createDataFrame(links, "a bigint, b bigint")), "node")
    nodes = {n for pair in links for n in pair if pair[0] != pair[1]}
    want = classes(nodes, [p for p in links if p[0] != p[1]])
    assert {n: r.component for n, r in got.items()} == want
    assert components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


def test_promising_loses_no_more_links_than_the_bands():
    """At each threshold the binomial tail stays under the chance of the bands at 0.75."""
    for similar in (50, 75, 90):
        share, least = similar / 100, minhash.promising(similar)
        tail = sum(math.comb(128, k) * share**k * (1 - share) ** (128 - k) for k in range(least))
        assert tail <= 1 / 190_000 and least < 128 * share
