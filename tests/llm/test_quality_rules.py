import re
from collections import Counter

import pytest
from tests.llm.conftest import as_dict, table

from posttags.llm import quality_rules as q

BLANK = re.compile(r"[\x20\x09-\x0D]+")


def plain(text):
    """The contract's measures, written out."""
    text = text or ""
    words = [w for w in BLANK.split(text) if w]
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {
        i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)
    }
    seen, again = set(), 0
    lines = [line for line in text.split("\n") if BLANK.sub("", line)]
    for line in lines:
        again += line in seen
        seen.add(line)
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_dup_lines": again,
        "n_repeat_words": len(covered),
        "n_lines": len(lines),
        "n_letterless": sum(not any(c.isalpha() for c in w) for w in words),
        "n_exclamations": text.count("!"),
        "longest_word": max(map(len, words), default=0),
    }


ODD = [
    (1, None), (2, ""), (3, " \t\n\x0b\x0c\r "), (4, "a a a a"), (5, "a b c a b c"), (6, "a\n\na\n a\na\r"),
    (7, "#*$%&|<> 😀 é é x"), (8, "x\x1cy\x00z"), (9, "y" * 60_000), (10, "w " * 30_000),
    (11, "one two three\n" * 40), (12, "\n".join("- item %d" % i for i in range(60))),
    (13, "\n".join("it goes on %d..." % i for i in range(60))), (13, "a row given twice"), (13, "a row given twice"),
]


def test_measures_against_plain_python(spark, messy):
    rows = [r for r in messy if r[0] is not None] + [(30_000 + i, t) for i, t in ODD]
    found = {}
    for row in q.measured(table(spark, rows)).collect():
        found.setdefault(row.doc_id, []).append(row)
    assert sum(map(len, found.values())) == len(rows)
    for doc_id, text in rows:
        wanted = plain(text)
        assert wanted in [{name: row[name] for name in wanted} for row in found[doc_id]], doc_id


def test_failure_bits_and_base(spark):
    prose = " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60))
    rows = [
        (1, prose), (2, "too few words"), (3, "go on then " * 30), (4, prose.replace(" ", "### ")),
        (5, prose.upper()), (6, prose.replace(" ", "! ")), (7, prose.replace(" ", " | ")), (8, None),
        (None, prose), (9, prose + " " + "z" * 1200),
    ]
    got = as_dict(q.judge(q.ledger(table(spark, rows)), q.POLICIES[-1]))
    names = {i: {r.name for at, r in enumerate(q.RULES) if row.failed >> at & 1} for i, row in got.items()}
    assert names[1] == names[None] == set()
    assert names[2] == names[8] == {"few words"}
    assert "repeated windows" in names[3] and names[4] == {"symbols"} and names[5] == {"capitals"}
    assert names[6] == {"exclamations"} and names[7] == {"symbols", "words without letters"}
    assert "one endless word" in names[9]
    assert {i for i, row in got.items() if row.kept} == {1, None}
    assert {i for i, row in got.items() if row.base_failed} == {2, 3, 8}


def test_policies_differ_without_reading_again(spark):
    text = " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60))
    strict, base, own = q.POLICIES[-1], q.POLICIES[0], q.Policy(3, q.bits(["capitals"]))
    loud = text.upper()
    entries = q.ledger(table(spark, [(1, loud), (2, text)]))
    for policy, kept in ((base, {1, 2}), (own, {2}), (strict, {2})):
        assert {i for i, row in as_dict(q.judge(entries, policy)).items() if row.kept} == kept


def test_ablations_against_counting(spark):
    masks = [0, 0, 1, 1, 4, 5, 512, 1536, 1536, 1540]
    entries = spark.createDataFrame([(i, m) for i, m in enumerate(masks)], "doc_id long, failed long")

    def drops(policy, mask):
        return bool(mask & policy.fatal) or bin(mask & policy.soft).count("1") > policy.allowed

    got = {(r.version, r.rule): r for r in q.ablations(entries).collect()}
    assert len(got) == len(q.POLICIES) * len(q.RULES)
    for policy in q.POLICIES:
        for at, rule in enumerate(q.RULES):
            row, bit = got[policy.version, rule.name], 1 << at
            assert row.n_failed == sum(bool(m & bit) for m in masks)
            assert row.n_dropped == sum(drops(policy, m) for m in masks)
            assert row.n_only == sum(drops(policy, m) and not drops(policy, m & ~bit) for m in masks)
    shared = q.shared_failures(entries.selectExpr("doc_id % 2 AS side", "failed"), "side")
    got = {r.side: (r.n, r.any_failed, r.all_failed) for r in shared.collect()}
    for side in (0, 1):
        part = [m for i, m in enumerate(masks) if i % 2 == side]
        assert got[side][1] == eval("|".join(map(str, part))) and got[side][2] == eval("&".join(map(str, part)))


def test_empty_table(spark):
    assert q.judge(q.ledger(table(spark, [])), q.POLICIES[-1]).count() == 0
    assert q.ablations(q.ledger(table(spark, []))).count() == 0


def test_no_python_in_the_plan(spark):
    plan = q.ledger(table(spark, [(1, "a")]))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_unknown_rule_has_no_bit():
    with pytest.raises(KeyError):
        q.bits(["no such rule"])
