import hashlib
import random

import numpy as np
import pytest

from posttags.llm import secrets
from tests.llm.conftest import table


@pytest.fixture(scope="module")
def planted():
    rnd = random.Random(12)
    hexa = lambda n: "".join(rnd.choice("0123456789abcdef") for _ in range(n))
    words = ["".join(rnd.choice("abcdelmnor") for _ in range(rnd.randint(2, 9))) for _ in range(300)]
    rows, truth = [], {}
    for i in range(400):
        text = [rnd.choice(words) for _ in range(30)]
        kind = i % 8
        run = {
            0: hexa(40), 1: "AKIA" + "".join(rnd.choice("ABCDEFGHJK234567") for _ in range(16)), 2: hexa(18),
            3: str(rnd.randrange(10**15, 10**16)), 4: "chapterheading" + str(rnd.randrange(100)),
            5: f"{rnd.randrange(1000)}-{rnd.randrange(1000)}-{rnd.randrange(10**8)}",
        }.get(kind)
        if run:
            text.insert(15, {0: f'token = "{run}"', 2: f"password={run}"}.get(kind, run))
            truth[i] = (run, kind < 3)
        rows.append((i, " ".join(text)))
    return rows, truth


def test_held_out_findings(spark, planted):
    """Train on findings of two documents in three, judge the others."""
    rows, truth = planted
    docs = table(spark, rows)
    transitions, words = secrets.corpus_statistics(docs.selectExpr("doc_id", "text"))
    found = secrets.find(docs.selectExpr("doc_id", "text"), transitions, words)
    got = secrets.scan(docs, found.where("doc_id % 3 != 1")).where("doc_id % 3 = 1").collect()
    judged = {(r.doc_id, r.sha256): r.secret for r in got}
    wanted = {(i, hashlib.sha256(run.encode()).hexdigest()): yes for i, (run, yes) in truth.items() if i % 3 == 1 and len(run) >= 12}
    assert wanted.keys() <= judged.keys()
    assert np.mean([judged[k] == yes for k, yes in wanted.items()]) >= 0.97


def test_candidates_are_whole_runs(planted):
    for _, text in planted[0]:
        for start, end in secrets.candidates(text):
            assert end - start >= 12 and any(c.isdigit() for c in text[start:end])
            assert (start == 0 or text[start - 1] not in secrets._KEYLIKE) and "\n" not in text[start:end]
    assert secrets.candidates("x" * 500 + "1" + "y" * 500 + "== 1 2 3") == [(0, 1003)]


def test_odd_rows(spark):
    run = "9f86d081884c7d659a2feaa0c55ad015"
    rows = [(1, None), (2, ""), (None, f"token={run}"), (3, "a" * 100_000 + " " + run), (4, f"x {run}"), (4, f"x {run}")]
    got = secrets.scan(table(spark, rows)).collect()
    assert sorted((r.doc_id or 0, r.start, r.length) for r in got) == [(0, 6, 32), (3, 100_001, 32), (4, 2, 32), (4, 2, 32)]
    assert all(r.secret and r.score == 1.0 for r in got)  # nothing learnt, nothing removed
    assert secrets.scan(table(spark, [])).collect() == []


def test_dictionary_coverage():
    assert secrets.covered("helloworld12", frozenset(["hello", "world"])) == pytest.approx(10 / 12)
    assert secrets.covered("qqqq", frozenset(["hello"])) == 0


@pytest.mark.parametrize(
    "text, value",
    [
        ("so password=Tr0ub4dor is", "Tr0ub4dor"),
        ("secret: correcthorsebattery", "correcthorsebattery"),
        ('{"pwd": "P@ss.w0rd!2024", "x": 1}', "P@ss.w0rd!2024"),
        ("api_key = 'two words' here", "two words"),
        ("token := é", "é"),
        ("passwd: \"it \\\"is\\\" so\"", 'it \\"is\\" so'),
        ("(auth=ab#cd)", "ab#cd"),
        ("password" + " " * 99 + "= x1;", "x1"),
        ("key QwErTyUiOpAsDfGhJk there", "QwErTyUiOpAsDfGhJk"),
        ("key qwertyuiopasdfghjklzxcvbnm there", "qwertyuiopasdfghjklzxcvbnm"),
        ("xoxb-abcdefghij", "xoxb-abcdefghij"),
    ],
)
def test_values_of_names_and_keys_without_digits_are_candidates(text, value):
    assert [text[a:b] for a, b in secrets.candidates(text)] == [value]


def test_words_are_no_candidates_and_runs_in_values_stay():
    assert secrets.candidates("Internationally authors: tokens, ---------------------- " + "a" * 50) == []
    text = "?token=9f86d081884c7d659a2f&user=5 x"
    assert [text[a:b] for a, b in secrets.candidates(text)] == ["9f86d081884c7d659a2f", "9f86d081884c7d659a2f&user=5"]


def test_short_values_come_out_judged(spark):
    rows = [(1, "password=Tr0ub4dor"), (2, "secret: correcthorsebattery"), (3, "pwd=x"), (4, "page 1234-5678-9012")]
    got = secrets.scan(table(spark, rows)).collect()
    assert sorted((r.doc_id, r.start, r.length) for r in got) == [(1, 9, 9), (2, 8, 19), (3, 4, 1), (4, 5, 14)]


def test_dictionary_holds_whole_words_of_several_documents(spark):
    rows = [
        (1, "Capital letters, extraordinarily long words; für-immer " + "onlyhere " * 50),
        (2, "capital EXTRAORDINARILY x1word word2x immer für"),
        (3, None),
        (None, "Immer wieder"),
    ]
    _, words = secrets.corpus_statistics(table(spark, rows).selectExpr("doc_id", "coalesce(text, '') AS text"))
    assert words == {"capital", "extraordinarily", "immer"}
    assert secrets.covered("extraordinarilyX", words) == pytest.approx(15 / 16)
    _, none = secrets.corpus_statistics(table(spark, []).selectExpr("doc_id", "text"))
    assert none == frozenset()
