"""Heuristic quality rules as a ledger of measurements and failure bits.

Every rule is evaluated once for each document: the ledger holds what was measured and one bit
for each rule that failed. Which failures drop a document is a policy, a pair of bit masks, so
that policies can be versioned, compared and taken apart without reading a text again. A
rule's bit is its place in RULES and never changes: new rules go to the end.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from posttags.functions.rows import hold
from posttags.llm.common import whole_text

BLANKS = r"[\x20\x09-\x0D]+"
SYMBOLS = "[#*$%&|<>]"
WINDOW = 3  # words of a window that may repeat


@dataclass(frozen=True)
class Rule:
    """Fails where ``times * measure > most * base``; all whole numbers, so nothing rounds."""

    name: str
    measure: str
    times: int
    most: int
    base: str | None = None

    def fails(self) -> Column:
        base = F.lit(1) if self.base is None else F.col(self.base)
        return F.col(self.measure) * F.lit(self.times) > base * F.lit(self.most)


RULES = (
    Rule("few words", "n_words", -1, -50),
    Rule("repeated windows", "n_repeat_words", 100, 50, "n_words"),
    Rule("short words", "word_chars", -1, -3, "n_words"),
    Rule("long words", "word_chars", 1, 10, "n_words"),
    Rule("symbols", "n_symbols", 10, 1, "n_words"),
    Rule("repeated lines", "n_dup_lines", 2, 1, "n_lines"),
    Rule("words without letters", "n_letterless", 5, 1, "n_words"),
    Rule("capitals", "n_capitals", 2, 1, "word_chars"),
    Rule("exclamations", "n_exclamations", 10, 1, "n_words"),
    Rule("bullet lines", "n_bullets", 10, 9, "n_lines"),
    Rule("cut lines", "n_cut_lines", 10, 3, "n_lines"),
    Rule("one endless word", "longest_word", 1, 1000),
)
MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines",
    "n_letterless", "n_capitals", "n_exclamations", "n_bullets", "n_cut_lines", "longest_word",
)


def bits(names: Sequence[str], rules: Sequence[Rule] = RULES) -> int:
    """The mask of the rules with these names."""
    places = {rule.name: at for at, rule in enumerate(rules)}
    return sum(1 << places[name] for name in set(names))


@dataclass(frozen=True)
class Policy:
    """Drops what fails any rule of ``fatal``, or more than ``allowed`` rules of ``soft``."""

    version: int
    fatal: int
    soft: int = 0
    allowed: int = 0

    def drops(self, failed: Column, without: Column | int = 0) -> Column:
        """Whether the failures ``failed`` drop a document, the rules ``without`` left out."""
        without = F.lit(without).cast("long") if isinstance(without, int) else without
        left = failed.bitwiseAND(F.bitwise_not(without))
        many = F.bit_count(left.bitwiseAND(F.lit(self.soft).cast("long"))) > self.allowed
        return (left.bitwiseAND(F.lit(self.fatal).cast("long")) != 0) | many


BASE = bits(["few words", "repeated windows"])
_LINES = bits(["bullet lines", "cut lines"])
POLICIES = (
    Policy(1, BASE),
    Policy(2, (1 << len(RULES)) - 1 - _LINES, _LINES, 1),  # layout alone is no fault, both marks are
)


def _repeats(rows: DataFrame) -> DataFrame:
    """Adds ``n_repeat_words`` to rows of ``doc, words, ...``.

    The windows are sorted with their places; equal ones then stand side by side. Each place
    of a repeated window covers the words up to the next such place, at most a window's.
    """
    word = lambda at: F.get("words", at)

    def window(at: Column) -> Column:
        text = F.concat_ws(" ", *[word(at + k) for k in range(WINDOW)])
        return F.struct(text.alias("text"), at.alias("at"))

    count = F.size("words")
    windows = F.when(count >= WINDOW, F.transform(F.sequence(F.lit(0), count - WINDOW), window))
    keep = [c for c in rows.columns]
    rows = hold(rows, F.sort_array(windows), "windows", *keep)

    def again(item: Column, at: Column) -> Column:
        near = [F.get("windows", at - 1)["text"], F.get("windows", at + 1)["text"]]
        return reduce(lambda a, b: a | b, [F.coalesce(n == item["text"], F.lit(False)) for n in near])

    places = F.transform(F.filter("windows", again), lambda item: item["at"])
    rows = hold(rows, F.sort_array(places), "places", *keep)

    def covered(at: Column, i: Column) -> Column:
        return F.least(F.coalesce(F.get("places", i + 1) - at, F.lit(WINDOW)), F.lit(WINDOW))

    steps = F.transform("places", covered)
    total = F.aggregate(steps, F.lit(0).cast("long"), lambda sum_, step: sum_ + step)
    return rows.select(*keep, F.coalesce(total, F.lit(0)).cast("long").alias("n_repeat_words"))


def measured(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the MEASURES of every row."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("whole"))
    words = F.filter(F.split("whole", BLANKS), lambda word: word != "")
    rows = hold(rows, words, "words", "doc_id", "whole")
    lines = F.filter(F.split("whole", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    rows = _repeats(hold(rows, lines, "lines", "doc_id", "whole", "words"))
    counts = {
        "n_words": F.size("words"),
        "word_chars": F.length(F.regexp_replace("whole", BLANKS, "")),
        "n_symbols": F.regexp_count("whole", F.lit(SYMBOLS)),
        "n_dup_lines": F.size("lines") - F.size(F.array_distinct("lines")),
        "n_repeat_words": F.col("n_repeat_words"),
        "n_lines": F.size("lines"),
        "n_letterless": F.size(F.filter("words", lambda word: ~word.rlike(r"\p{L}"))),
        "n_capitals": F.length(F.regexp_replace("whole", r"\P{Lu}+", "")),
        "n_exclamations": F.regexp_count("whole", F.lit("!")),
        "n_bullets": F.size(F.filter("lines", lambda line: line.rlike("^[\x20\x09]*[-*•]"))),
        "n_cut_lines": F.size(F.filter("lines", lambda line: line.rlike(r"(\.\.\.|…)[\x20\x09\x0D]*$"))),
        "longest_word": F.coalesce(F.array_max(F.transform("words", F.length)), F.lit(0)),
    }
    return rows.select("doc_id", *[counts[name].cast("long").alias(name) for name in MEASURES])


def ledger(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """One row per input row: ``doc_id``, the MEASURES and ``failed``, a bit for each rule.

    A null text is empty: it has no words, so "few words" fails and rules on shares do not.
    Null doc_ids, rows given twice and ties each keep their own row; an empty table gives an
    empty ledger. Other columns are not looked at, whatever their names.
    """
    failed = reduce(
        lambda mask, at: mask.bitwiseOR(F.when(rules[at].fails(), F.lit(1 << at)).otherwise(0).cast("long")),
        range(len(rules)),
        F.lit(0).cast("long"),
    )
    return measured(docs).withColumn("failed", failed)


def judge(entries: DataFrame, policy: Policy) -> DataFrame:
    """The ledger with ``base_failed`` and the ``kept`` of a policy, which never keeps a base failure."""
    failed = F.col("failed")
    base = failed.bitwiseAND(F.lit(BASE).cast("long")) != 0
    return entries.withColumn("base_failed", base).withColumn("kept", ~(base | policy.drops(failed)))


def patterns(entries: DataFrame, *keys: str) -> DataFrame:
    """``failed, n`` of each pattern of failures: few rows, whatever the number of documents."""
    return entries.groupBy(*keys, "failed").agg(F.count("*").alias("n"))


def ablations(entries: DataFrame, policies: Sequence[Policy] = POLICIES, rules: Sequence[Rule] = RULES) -> DataFrame:
    """What each rule does under each policy, from the counted patterns of failure bits.

    One row per policy and rule: ``version, rule, n_failed`` (rows that fail the rule),
    ``n_dropped`` (rows the policy drops), ``n_only`` (dropped, but kept without the rule).
    """
    named = [
        F.struct(F.lit(rule.name).alias("rule"), F.lit(1 << at).cast("long").alias("bit"))
        for at, rule in enumerate(rules)
    ]
    found = patterns(entries).select("failed", "n", F.inline(F.array(*named)))
    n = F.col("n")
    parts = []
    for policy in policies:
        dropped = policy.drops(F.col("failed"))
        without = policy.drops(F.col("failed"), F.col("bit"))
        parts.append(
            found.groupBy("rule", "bit").agg(
                F.lit(policy.version).alias("version"),
                F.sum(F.when(F.col("failed").bitwiseAND(F.col("bit")) != 0, n).otherwise(0)).alias("n_failed"),
                F.sum(F.when(dropped, n).otherwise(0)).alias("n_dropped"),
                F.sum(F.when(dropped & ~without, n).otherwise(0)).alias("n_only"),
            )
        )
    return reduce(DataFrame.unionByName, parts).select("version", "rule", "n_failed", "n_dropped", "n_only")


def shared_failures(entries: DataFrame, *keys: str) -> DataFrame:
    """For each group, the rules that any of its rows fails and those that all of them fail."""
    found = patterns(entries, *keys).groupBy(*keys)
    return found.agg(
        F.sum("n").alias("n"), F.bit_or("failed").alias("any_failed"), F.bit_and("failed").alias("all_failed")
    )
