"""Scan texts for secrets; a random forest removes false positives.

Candidates are long runs of key-like characters that are no plain words, and every value
given to a secret's name. The forest judges each by its length, its character transitions
against those of the corpus, how much of it dictionary words cover, whether it stands in a
path, and the words beside it.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, functions as F

from posttags.llm.common import few, lean, whole_text
from posttags.session import materialise

LEAST = 12  # characters of a key-like run
# Characters, and different ones, of a key-like run whose letters are of one case, without a digit.
LONG, VARIED = 20, 8
# Labelled findings the forest is trained on at most, of each label.
SAMPLE = 5000
# A word is in the dictionary if its documents are at least one in DICTIONARY of those of all
# words together, so at most DICTIONARY words are. Words a task counts before it passes them on.
DICTIONARY, COUNTED = 200_000, 400_000
SHORTEST_WORD, LONGEST_WORD = 4, 24
TREES, DEPTH, NEIGHBOURS = 40, 8, 32
CLASSES = 39  # letters, digit, and the signs + / _ - = , and anything else
FINDING = "doc_id long, start long, length long, sha256 string, label int, features array<double>"

_KEYLIKE = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-")
_RUN = re.compile(r"[A-Za-z0-9+/_-]{%d,}+=*" % LEAST)
_DIGIT = re.compile(r"[0-9]")
_MIXED = re.compile(r"(?=.*[a-z]).+[A-Z]")
_WORD = re.compile(r"(?<![^\W\d_])[a-z]{%d,%d}(?![^\W\d_])" % (SHORTEST_WORD, LONGEST_WORD))

# Formats that are secrets, names that secrets are given to, and formats that are not.
SECRET_FORMATS = re.compile(
    r"(AKIA|ASIA)[0-9A-Z]{16}|gh[pousr]_[0-9A-Za-z]{36}|xox[abpr]-[0-9A-Za-z-]{10,}|sk-[0-9A-Za-z]{20,}"
)
_NAMES = r"(password|passwd|pwd|secret|token|api_?key|access_?key|auth)[\"']?"
SECRET_NAMES = re.compile(_NAMES + r"\s*[=:]\s*[\"']?$", re.I)
_NAMED, _LONGEST_NAME = re.compile(_NAMES + "$", re.I), 16
_GIVEN = re.compile(r"[=:]+>?")
_VALUE = re.compile(r"""\s*(?:"((?:[^"\\\n]|\\.)+)"|'((?:[^'\\\n]|\\.)+)'|["']?(\S+))""")
_ENDS = ",;.)]}>\"'"  # after a value without quotes
PLAIN_FORMATS = re.compile(r"[0-9+/_-]+|[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}|[A-Za-z/_-]+[0-9]{1,4}")


def _class_table() -> np.ndarray:
    table = np.full(256, CLASSES - 1, np.int64)
    for i in range(26):
        table[97 + i] = table[65 + i] = i
    table[48:58] = 26
    for i, sign in enumerate(b"+/_-="):
        table[sign] = 27 + i
    return table


_TABLE = _class_table()


def candidates(text: str) -> list[tuple[int, int]]:
    """Where candidates begin and end in ``text``.

    Key-like runs of at least LEAST characters with a digit or letters of both cases (beyond
    an initial), in a known format, or long and varied; and every value given to a secret's
    name, whatever its length and characters, up to the closing quote or else white space.
    Key-like runs within such a value are candidates of their own.
    """
    found = {run.span() for run in _RUN.finditer(text) if _is_keylike(run[0])}
    return sorted(found | set(_named_values(text)))


def _is_keylike(run: str) -> bool:
    if _DIGIT.search(run) or _MIXED.match(run) or SECRET_FORMATS.fullmatch(run):
        return True
    return len(run) >= LONG and len(set(run)) >= VARIED


def _named_values(text: str) -> Iterator[tuple[int, int]]:
    for given in _GIVEN.finditer(text):
        name = given.start()
        while name and text[name - 1].isspace():
            name -= 1
        if not _NAMED.search(text[max(0, name - _LONGEST_NAME) : name]):
            continue
        if value := _VALUE.match(text, given.end()):
            start, end = value.span(value.lastindex)
            if value.lastindex == 3:
                end = start + len(value[3].rstrip(_ENDS))
            if end > start:
                yield start, end


def corpus_statistics(docs: DataFrame) -> tuple[np.ndarray, frozenset[str]]:
    """Log chances of one character class after another, and the dictionary, over all texts.

    The dictionary holds whole words, lower-cased, that at least two documents have and that
    make up one part in DICTIONARY of all documents' words, each counted once a document.
    Collected are one number for each pair of classes and at most DICTIONARY words.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, words = np.zeros(CLASSES * CLASSES, np.int64), Counter()
        for batch in batches:
            for text in few(batch.column(1)):
                codes = _TABLE[np.frombuffer(text.encode(), np.uint8)]
                pairs += np.bincount(codes[:-1] * CLASSES + codes[1:], minlength=len(pairs))
                words.update(set(_WORD.findall(text.lower())))
                if len(words) > COUNTED:
                    yield counted(words)
                    words.clear()
        yield counted(words)
        yield counted({f"#{at}": n for at, n in enumerate(pairs.tolist()) if n})

    def counted(some: dict) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(some), pa.string()), pa.array(list(some.values()), pa.int64())], ["name", "n"]
        )

    names = docs.mapInArrow(lean(count), "name string, n long").groupBy("name").agg(F.sum("n").alias("n"))
    names = materialise(names, "corpus-counts")
    pairs = np.full(CLASSES * CLASSES, 0.5)
    for row in names.where(F.col("name").startswith("#")).collect():
        pairs[int(row.name[1:])] += row.n
    pairs = pairs.reshape(CLASSES, CLASSES)
    words = names.where(~F.col("name").startswith("#"))
    total = words.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    words = words.where((F.col("n") > 1) & (F.col("n") * DICTIONARY >= total))
    return np.log(pairs / pairs.sum(axis=1, keepdims=True)), frozenset(r.name for r in words.collect())


def covered(candidate: str, words: frozenset[str]) -> float:
    """Share of a candidate's characters in dictionary words, taken longest first from the left."""
    low, at, inside = candidate.lower(), 0, 0
    while at < len(low):
        size = next((n for n in range(LONGEST_WORD, SHORTEST_WORD - 1, -1) if low[at : at + n] in words), 0)
        inside += size
        at += size or 1
    return inside / len(low)


def features(text: str, start: int, end: int, transitions: np.ndarray, words: frozenset[str]) -> list[float]:
    """What the forest sees of one candidate."""
    run = text[start:end]
    codes = _TABLE[np.frombuffer(run.encode(), np.uint8)]
    steps = transitions[codes[:-1], codes[1:]] if len(codes) > 1 else np.zeros(1)
    shares = np.array(list(Counter(run).values())) / len(run)
    before, after = text[max(0, start - 60) : start], text[end : end + 60]
    beside = [0.0] * NEIGHBOURS
    for word in [*re.findall(r"[^\W\d_]+", before.lower())[-2:], *re.findall(r"[^\W\d_]+", after.lower())[:1]]:
        beside[xxhash.xxh32_intdigest(word) % NEIGHBOURS] = 1.0
    assigned = re.search(r"[=:]\s*[\"']?$", before) is not None
    return [
        float(len(run)), float(steps.mean()), float(steps.min()), -float((shares * np.log2(shares)).sum()),
        sum(c.isdigit() for c in run) / len(run), sum(c.isupper() for c in run) / len(run),
        covered(run, words),
        float("/" in run or before.endswith(("/", "\\", "."))), float("://" in before),
        float(assigned), float(before.endswith(('"', "'"))),
        *beside,
    ]


def weak_label(text: str, start: int, end: int) -> int | None:
    """1 for a known secret format or a value given to a secret's name, 0 for a plain number,
    identifier or numbered word, else None."""
    run = text[start:end]
    if SECRET_FORMATS.fullmatch(run) or SECRET_NAMES.search(text[max(0, start - 60) : start]):
        return 1
    return 0 if PLAIN_FORMATS.fullmatch(run) else None


def find(docs: DataFrame, transitions: np.ndarray, words: frozenset[str]) -> DataFrame:
    """All candidates with their features and weak labels; the secrets themselves stay behind."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc_id, text in zip(batch.column(0).to_pylist(), few(batch.column(1))):
                for start, end in candidates(text):
                    digest = hashlib.sha256(text[start:end].encode()).hexdigest()
                    seen = features(text, start, end, transitions, words)
                    out.append((doc_id, start, end - start, digest, weak_label(text, start, end), seen))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.list_(pa.float64())]
            columns = list(zip(*out)) if out else [[]] * 6
            names = ["doc_id", "start", "length", "sha256", "label", "features"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return docs.mapInArrow(lean(scan), FINDING)


def train(findings: DataFrame, sample: int = SAMPLE) -> RandomForestClassificationModel | None:
    """A forest fitted on at most ``sample`` labelled ``findings`` of each label, spread by hash.

    None without both labels.
    """
    parts = []
    for label in (0, 1):
        some = findings.where(F.col("label") == label)
        order = (F.xxhash64("sha256", "doc_id", "start"), F.col("sha256"))
        parts.append(some.orderBy(*order).limit(sample))
    rows = parts[0].unionByName(parts[1]).select(
        F.col("label").cast("double").alias("label"), array_to_vector("features").alias("features"),
        F.xxhash64("sha256", "doc_id", "start").alias("at"),
    )
    # few rows: in one part and in one order the forest does not depend on partitions
    rows = materialise(rows.repartition(1).sortWithinPartitions("at").drop("at"), "labelled-findings")
    if rows.select("label").distinct().count() < 2:
        return None
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=11, featureSubsetStrategy="sqrt")
    return forest.fit(rows)


def scan(docs: DataFrame, labelled: DataFrame | None = None, cut: float = 0.5) -> DataFrame:
    """All candidates in ``docs``, judged: ``doc_id, start, length, sha256, score, secret``.

    ``start`` and ``length`` count characters of the text; ``sha256`` is that of the
    candidate. ``labelled`` are findings as from ``find`` with a ``label``; without them the
    forest learns from the weak labels of this scan. Without findings of both labels every
    candidate scores 1: nothing is removed unlearnt.

    Null and empty texts have no candidates, so no rows. Null doc_ids are kept; rows given
    twice come back twice; an empty table gives an empty result. Texts are scanned whole.
    Other columns are not looked at.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    found = materialise(find(rows, *corpus_statistics(rows)), "findings")
    forest = train(found if labelled is None else labelled)
    if forest is None:
        judged = found.withColumn("score", F.lit(1.0))
    else:
        judged = forest.transform(found.withColumn("features", array_to_vector("features")))
        judged = judged.withColumn("score", F.round(vector_to_array("probability")[1], 6))
    return judged.select(
        "doc_id", "start", "length", "sha256", "score", (F.col("score") >= cut).alias("secret")
    )
