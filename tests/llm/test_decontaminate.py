import random

import numpy as np
import pytest

from posttags.llm import decontaminate
from tests.llm.conftest import table


def plain_alignment(item, passage):
    score = [[0] * (len(passage) + 1) for _ in range(len(item) + 1)]
    best = 0
    for i in range(1, len(item) + 1):
        for j in range(1, len(passage) + 1):
            same = 2 if item[i - 1] == passage[j - 1] else -1
            score[i][j] = max(0, score[i - 1][j - 1] + same, score[i - 1][j] - 1, score[i][j - 1] - 1)
            best = max(best, score[i][j])
    return best


def test_alignment_equals_the_plain_table():
    rnd = np.random.default_rng(6)
    for _ in range(200):
        item, passage = rnd.integers(0, 5, rnd.integers(0, 12)), rnd.integers(0, 5, rnd.integers(0, 15))
        assert decontaminate.align(item, passage)[0] == plain_alignment(item.tolist(), passage.tolist())


def test_alignment_tells_where():
    item, passage = np.array([1, 2, 3, 4]), np.array([9, 9, 1, 2, 8, 3, 4, 9])
    assert decontaminate.align(item, passage) == (7, 2, 7)


@pytest.fixture(scope="module")
def planted():
    rnd = random.Random(7)
    words = [f"word{i}" for i in range(500)]
    items = {i: [rnd.choice(words) for _ in range(rnd.randint(15, 40))] for i in range(12)}
    docs, wanted = {}, set()
    for doc_id in range(300):
        text = [rnd.choice(words) for _ in range(rnd.randint(0, 200))]
        if doc_id % 5 == 0:
            item = rnd.randrange(12)
            copy = list(items[item])
            if doc_id % 10 == 0:  # edited: one word in eight replaced, dropped or doubled
                for at in sorted(rnd.sample(range(len(copy)), len(copy) // 8), reverse=True):
                    copy[at : at + 1] = rnd.choice([["changed"], [], [copy[at]] * 2])
            at = rnd.randint(0, len(text))
            text[at:at] = [w.upper() + "," for w in copy]
            wanted.add((doc_id, item))
        docs[doc_id] = " ".join(text)
    return list(docs.items()), [(i, " ".join(t)) for i, t in items.items()], wanted


@pytest.mark.parametrize("held", [1_000_000, 100])
def test_finds_exact_and_edited_copies_only(spark, planted, held):
    docs, items, wanted = planted
    bench = spark.createDataFrame([(*i, "x") for i in items], "item_id bigint, text string, seed string")
    got = decontaminate.leaks(table(spark, docs), bench, held=held).collect()
    assert {(r.doc_id, r.item_id) for r in got} == wanted and len(got) == len(wanted)
    assert all(0.5 <= r.score <= 1 and r.n_words > 0 for r in got)


def test_odd_rows(spark):
    docs = [(1, None), (None, "a b c d e f"), (2, ""), (3, "a b c d e f"), (3, "a b c d e f"), (4, "x " * 30_000 + "a b c d e f")]
    bench = spark.createDataFrame(
        [(7, "A b, c d e f!"), (8, None), (9, ""), (None, "x x x"), (10, "a b")], "item_id bigint, text string"
    )
    got = decontaminate.leaks(table(spark, docs), bench).collect()
    assert sorted((r.doc_id or 0, r.item_id, r.score) for r in got) == [(0, 7, 1.0), (3, 7, 1.0), (3, 7, 1.0), (4, 7, 1.0)]
    assert decontaminate.leaks(table(spark, []), bench).collect() == []
    assert decontaminate.leaks(table(spark, docs), bench.limit(0)).collect() == []


def test_an_item_copied_everywhere_still_has_seeds(spark):
    text = "these are the very words of an item that many copy"
    docs = [(i, f"head{i} {text} tail{i}") for i in range(100)]
    bench = spark.createDataFrame([(1, text)], "item_id bigint, text string")
    assert decontaminate.leaks(table(spark, docs), bench).count() == 100


def test_equals_aligning_every_document_with_every_item(spark):
    """Copies with 20 to 33 % other words, halves, and words put in after every second one."""
    rnd = random.Random(21)
    words = [f"w{i}" for i in range(400)] + ["the", "of", "and"] * 60
    items = [[rnd.choice(words) for _ in range(rnd.choice([3, 16, 25, 39, 70]))] for _ in range(16)]
    docs = [[rnd.choice(words) for _ in range(rnd.choice([0, 3, 40, 400, 1500]))] for _ in range(30)]
    for i in range(160):
        copy, text = list(rnd.choice(items)), [rnd.choice(words) for _ in range(rnd.choice([0, 20, 200, 900]))]
        if i % 4 == 0:
            copy = copy[: -(-len(copy) // 2)]
        elif i % 4 == 1:
            copy = [x for at, w in enumerate(copy) for x in ([w, "put"] if at % 2 else [w])]
        else:
            for at in rnd.sample(range(len(copy)), round(len(copy) * rnd.uniform(0.2, 0.33))):
                copy[at] = rnd.choice(["changed", rnd.choice(words)])
        at = rnd.randint(0, len(text))
        docs.append(text[:at] + copy + text[at:])
    number = {w: at for at, w in enumerate(sorted({*words, "put", "changed"}))}
    coded = [np.array([number[w] for w in text], np.int64) for text in docs]
    wanted = {}
    for i, item in enumerate(items):
        plain = np.array([number[w] for w in item])
        for d, text in enumerate(coded):
            score = decontaminate.align(plain, text)[0] / (2 * len(item))
            if score >= 0.5:
                wanted[d, i] = round(score, 6)
    bench = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(items)], "item_id bigint, text string")
    got = decontaminate.leaks(table(spark, [(d, " ".join(t)) for d, t in enumerate(docs)]), bench).collect()
    assert len(wanted) > 120 and {(r.doc_id, r.item_id): r.score for r in got} == wanted and len(got) == len(wanted)
