import hashlib
import random
import re
import zlib

import pytest
from tests.llm.conftest import as_dict, table
from hypothesis import given, settings, strategies as st

from posttags.llm import periodic_runs as pr
from posttags.llm.queries import op12_periodic_runs


def plain_runs(words):
    """All runs, by looking at every period."""
    n, found = len(words), []
    for period in range(1, n // 3 + 1):
        i = 0
        while i + period < n:
            if words[i] != words[i + period]:
                i += 1
                continue
            start = i
            while i + period < n and words[i] == words[i + period]:
                i += 1
            part = words[start : i + period]
            least = next(p for p in range(1, period + 1) if part[p:] == part[:-p])
            if least == period and len(part) >= max(24, 3 * period):
                found.append((start, len(part), period))
    return sorted(found, key=lambda run: (run[0], run[2]))


def plain(doc_id, text):
    """The contract's row, written out."""
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n and doc_id is not None:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = plain_runs(words)
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=(None, None, None))
    gone = {i for s, k, q in runs for i in range(s + q, s + k)}
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    listed = "".join(f"{s},{k},{q}\n" for s, k, q in runs)
    milli = None if best[0] is None else 1000 * best[1] // best[2]
    digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return doc_id, len(runs), *best, milli, digest(listed), digest(kept)


pieces = st.tuples(st.lists(st.integers(0, 2), min_size=1, max_size=9), st.integers(1, 9))


@settings(max_examples=300, deadline=None)
@given(st.lists(pieces, max_size=6))
def test_runs_against_all_periods(parts):
    words = [word for part, times in parts for word in part * times]
    wanted = plain_runs(words)
    assert sorted(pr.runs_of(words), key=lambda run: (run[0], run[2])) == wanted
    assert pr.detect([str(word).encode() for word in words]).runs == wanted


def test_squares_are_the_primitive_ones():
    rnd = random.Random(2)
    for _ in range(100):
        words = [rnd.randrange(2) for _ in range(60)]
        automaton = pr.SuffixAutomaton()
        got = {square for word in words for square in automaton.append(word)}
        wanted = set()
        for end in range(1, 61):
            for d in range(1, end // 2 + 1):
                root = words[end - d : end]
                if root == words[end - 2 * d : end - d]:
                    if not any(d % p == 0 and root == root[:p] * (d // p) for p in range(1, d)):
                        wanted.add((end, d))
        assert got == wanted


def test_trimming_never_cuts_a_run(monkeypatch):
    rnd = random.Random(4)
    unit = [rnd.randrange(50) for _ in range(30)]
    words = unit * 4 + [99] + unit * 2 + list(range(100, 130)) + [7, 8] * 15 + unit
    data = [str(w).encode() for w in words]
    monkeypatch.setattr(pr, "LOOKS", 0)
    assert pr.detect(data).runs == plain_runs(words) == [(0, 120, 30), (211, 30, 2)]


CASES = [
    (1, None), (2, ""), (3, " \n\t"), (4, "a " * 23), (5, "a " * 24), (6, "a b " * 12), (7, "x" * 50_000),
    (8, "a b c d e f g h i " * 3 + "z"), (9, "Ü é " * 40), (11, "a\x1cb c " * 30), (12, "w " * 20_000),
    (13, "p q " * 20 + "r " * 30), (13, "p q " * 20 + "r " * 30), (14, "a " * 24 + "b " + "c " * 24),
    (None, "m n o " * 20), (None, None),
]


def test_query_against_the_contract_written_out(spark, messy, monkeypatch, tmp_path):
    rows = messy + CASES + [(1000 + i, " ".join(f"w{k % (7 + i)}" for k in range(40 + 5 * i))) for i in range(80)]
    short = [r for r in rows if r[1] is None or len(r[1]) < 20_000 or r[0] == 12]
    table(spark, short).write.parquet(f"{tmp_path}/documents.parquet")
    frame = op12_periodic_runs(spark, str(tmp_path))
    names = "doc_id n_runs start length period exponent_milli runs_sha256 collapsed_sha256".split()
    got = sorted((tuple(row[name] for name in names) for row in frame.collect()), key=repr)
    keep = lambda r: r[0] != 12  # noqa: E731  (brute force over all periods of the long one takes too long)
    wanted = sorted((plain(*r) for r in short if keep(r)), key=repr)
    assert [r for r in got if keep(r)] == wanted
    assert sum(zlib.crc32(str(r[0]).encode()) % 10 == 0 for r in short) > 5


def test_long_and_special_texts(spark):
    got = as_dict(pr.find_runs(table(spark, CASES[:-2])))
    assert got[12][3:6] == (0, 20_000, 1) and got[12].exponent_milli == 20_000_000
    assert got[4].n_runs == 0 and got[5][3:6] == (0, 24, 1) and got[6][3:6] == (0, 24, 2)
    assert got[8][3:6] == (0, 27, 9) and got[7].n_runs == 0 and got[1].n_words == 0
    assert got[14][3:6] == (0, 24, 1) and got[14].n_runs == 2  # equal exponents: the first
    assert got[12].collapsed_sha256 == hashlib.sha256(b"w").hexdigest()


def test_empty_table(spark):
    assert pr.find_runs(table(spark, [])).count() == 0


@pytest.mark.parametrize("words", [[], [1], [1] * 24, list(range(100)), [1, 2] * 50 + [3] + [1, 2] * 50])
def test_small_lists(words):
    assert sorted(pr.runs_of(words)) == sorted(plain_runs(words))
