import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from posttags.llm import collocations as c

CLASHING = "word string, part string, n string, phrase string, run string"


def docs_of(spark, rows):
    schema = f"doc_id bigint, lang string, text string, {CLASHING}"
    return spark.createDataFrame([(*row, *"xxxxx") for row in rows], schema)


def low(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def plain(rows, least, top):
    """The contract, written out."""
    f, n = defaultdict(Counter), Counter()
    for _, lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", low(text)):
            words = [w for w in re.split("[\x20\x09]+", piece) if w]
            n[lang] += len(words)
            for i in range(len(words)):
                for k in range(1, min(5, len(words) - i) + 1):
                    f[lang][tuple(words[i : i + k])] += 1
    out = []
    for lang, counts in f.items():
        often = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        inside = {
            p[i : i + k] for p, a in often.items() for k in range(2, len(p)) for i in range(len(p) - k + 1)
            if 100 * a >= 100 * counts[p[i : i + k]]
        }
        found = []
        for p, a in often.items():
            if p not in inside:
                parts = [(counts[p[:k]], counts[p[k:]]) for k in range(1, len(p))]
                score, k = min((1000 * a * n[lang] // (x * y), k) for k, (x, y) in enumerate(parts))
                found.append((-score, -a, " ".join(p).encode(), *parts[k]))
        for rank, (score, a, phrase, x, y) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, x, y, n[lang], -score))
    return sorted(out)


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(5)
    words = ["alpha", "Beta", "gamma", "delta", "of", "the", "The", "ÉTÉ", "été", "x\x1cy", "#", "zeta"]

    def text(n):
        return "".join(rnd.choice(words) + rnd.choice([" ", " ", " ", "  ", "\t", ". ", "\n", ",", "!"]) for _ in range(n))

    out = [(i, rnd.choice(["en", "en", "de", None]), text(rnd.randint(0, 120))) for i in range(120)]
    line = "one line that very many of these texts hold, word for word. "
    out += [(200 + i, "en", line + f"rare{i} word{i} of the rest{i}") for i in range(60)]
    out += [(300, None, None), (301, "fr", ""), (302, "fr", " \n.,;"), (None, "en", line), (303, None, "a b " * 3000)]
    return out + [(304, "en", line)] * 3


def found(frame):
    return sorted(tuple(r)[:8] for r in frame.collect())


@pytest.mark.parametrize("part", [40, 700, 10**9])
def test_against_the_contract_written_out(spark, rows, part, monkeypatch):
    """Many small parts, whose borders fall within frequent phrases, or one; the same rows."""
    for least, top in ((8, 2000), (20, 5)):
        wanted = plain(rows, least, top)
        assert len(wanted) > 10
        assert found(c.mine(docs_of(spark, rows), least, top, part=part)) == wanted


class All:
    def may_hold(self, lang, word):
        return word != b"rare"


@pytest.mark.parametrize("held", [1, 50, 10**6])
@pytest.mark.parametrize("burst", [1, 3, 10**6])
def test_trie_bursts_and_spills_whole_subtrees(rows, held, burst):
    trie, got, wanted = c.HatTrie(All(), burst), Counter(), Counter()

    def spill(keep):
        before = set(trie.root)
        ids, counts = trie.spill(keep)
        gone = before - set(trie.root)
        assert {int(i).to_bytes(4, "little") for i in ids[:, 0]} <= gone
        for row, n in zip(ids.tolist(), counts.tolist()):
            got[tuple(trie.words[i] for i in row if i)] += n

    for _, lang, text in rows[:150]:
        words = c.tokens((text or "").encode())
        for at in range(0, len(words), 7):
            trie.add(lang or "und", words[at : at + 7 + 4], 7)
            full = trie.entries
            if full > held:
                spill(0.5)
                assert trie.entries <= full / 2
    spill(0)
    assert trie.entries == 0 and not trie.root
    for _, lang, text in rows[:150]:
        for piece in re.split("[.,;:!?\x0a-\x0d]", low(text)):
            words = piece.encode().split()
            for i in range(len(words) - 1):
                wanted[tuple((lang or "und", w) for w in words[i : i + 5])] += 1
    assert got == wanted


def test_rare_words_end_windows():
    trie = c.HatTrie(All())
    trie.add("en", b"a b rare c d e rare f".split(), 99)
    ids, counts = trie.spill(0)
    got = {b" ".join(trie.words[i][1] for i in row if i): n for row, n in zip(ids.tolist(), counts.tolist())}
    assert got == {b"a b": 1, b"c d e": 1, b"d e": 1}


def test_runs_are_cut_at_splitters_and_read_back():
    trie = c.HatTrie(All())
    trie.add("en", c.tokens(b"a b c. a b d. b a. c a b c d e f. a\x00b c"), 99)
    splitters = {"en": [(b"a", b"b", b"d"), (b"b",), (b"c", b"a")]}
    batch = c._runs(trie, 0, splitters, {"en": 7})
    got = {}
    for row in batch.to_pylist():
        words, windows, counts = c._unpack(row["run"])
        phrases = [tuple(words[i - 1] for i in w if i) for w in windows.tolist()]
        assert phrases == sorted(phrases) and counts.sum() == len(phrases)
        got[row["part"]] = phrases
    assert got[7] == [(b"a", b"b", b"c"), (b"a", b"b", b"c", b"d", b"e")]
    assert got[8] == [(b"a", b"b", b"d"), (b"a\x00b", b"c")]
    assert got[9] == [(b"b", b"a"), (b"b", b"c"), (b"b", b"c", b"d", b"e", b"f"), (b"b", b"d")]
    assert got[10][0] == (b"c", b"a", b"b", b"c", b"d")


@pytest.mark.parametrize("most", [3, 2**13, 2**33])
def test_order_with_any_number_of_places(most):
    rng = np.random.default_rng(1)
    windows = rng.integers(0, 4, (500, 5)) * (most // 4)
    assert windows[c._order(windows, most)].tolist() == sorted(windows.tolist())


def test_products_beyond_64_bits(spark):
    big = 3 * 10**13
    words = spark.createDataFrame([("en", "a", big), ("en", "b", big - 7)], "lang string, word string, n long")
    phrases = spark.createDataFrame([("en", "a b", 2, big - 11)], "lang string, phrase string, size int, n long")
    row = c.scored(phrases, words).first()
    assert row.score == 1000 * (big - 11) * (2 * big - 7) // (big * (big - 7)) and row.n == 2 * big - 7


def test_equal_cuts_take_the_first(spark):
    rows = [(i, "en", "a a a") for i in range(10)]
    got = found(c.mine(docs_of(spark, rows), least=10))
    assert got == plain(rows, 10, 2000) == [("en", 1, "a a", 20, 30, 30, 30, 666), ("en", 2, "a a a", 10, 30, 20, 30, 500)]


def test_empty_and_without_phrases(spark):
    assert c.mine(docs_of(spark, [])).count() == 0
    assert c.mine(docs_of(spark, [(1, "en", "only a few words"), (2, None, None)])).count() == 0


@pytest.mark.parametrize("lot", [2, 5, 1000])
def test_shares_of_a_language_are_ranked_before_the_whole(spark, lot):
    """Several rounds over one hot language with ties in score and count, or none."""
    rnd = random.Random(3)
    rows = [("en" if i % 9 else "de", f"w{i:04d} é{i % 7}", rnd.randint(0, 40), rnd.randint(1, 3)) for i in range(900)]
    frame = spark.createDataFrame(rows, "lang string, phrase string, score bigint, a bigint")
    wanted = []
    for lang in ("de", "en"):
        mine = sorted((-score, -a, phrase.encode()) for of, phrase, score, a in rows if of == lang)
        wanted += [(lang, rank, phrase.decode()) for rank, (_, _, phrase) in enumerate(mine[:20], 1)]
    ranked = c.first_of_each(frame, len(rows), 20, lot)
    assert sorted(tuple(r) for r in ranked.select("lang", "rank", "phrase").collect()) == wanted
    plan = ranked._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window [") == {2: 5, 5: 2, 1000: 1}[lot]
