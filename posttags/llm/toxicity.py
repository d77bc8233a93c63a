"""Toxicity by weak supervision.

Voters, each a word, a word beginning or a pattern, fire on texts. A generative label model
estimates from the votes on all documents how often each fires on toxic and on clean texts
and which fire together, without seeing a label. A linear classifier is then trained on its
posterior labels.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from posttags.llm.common import whole_text
from posttags.llm.quality import labelled_sample
from posttags.session import materialise

# At most this many labelled rows propose words for voters.
SAMPLE = 20_000
# Texts of each kind, by posterior, that the linear classifier is trained on at most.
TRAIN_TOXIC, TRAIN_CLEAN = 3000, 5000
BUCKETS = 1 << 16
ROUNDS, STEPS = 12, 150
# Pull of the weights of hashed features to zero, so that many small ones do not add up.
SHRINK = 1e-2
# What a clean text with a feature takes from the feature's rank.
CLEAN_COST = 4.0
REMEMBER = 300_000
LENGTHS = (3, 4, 5, 6)
SIGNS = "\"'.,;:!?()[]{}<>|/\\*#$%&+-=_~^@`"

# Fixed words that insult in several languages; mined ones add to them.
INSULTS = "idiot moron scum worthless pathetic disgusting stupid dumb loser trash"
INSULTS_OTHER = "dummkopf abschaum wertlos débile imbécile ordure estúpido basura inútil"

NONE, SEVERAL, DENSE, SHOUTING = range(4)
PATTERNS = 4


def features_of(token: str) -> list[str]:
    """A token without signs around it, and its beginnings (marked by a star)."""
    word = token.strip(SIGNS)
    if not word or not word[0].isalpha():
        return []
    return [word, *(word[:n] + "*" for n in LENGTHS if len(word) > n)]


@dataclass
class Voters:
    """Firing words and word beginnings, after the four patterns."""

    lexicon: list[str]
    _votes: dict[str, int] = field(default_factory=dict, repr=False)
    _hashed: dict[str, list[int]] = field(default_factory=dict, repr=False)
    _both: dict[str, tuple[int, list[int]]] = field(default_factory=dict, repr=False)

    def __post_init__(self):
        self.bit = {word: 1 << (PATTERNS + i) for i, word in enumerate(self.lexicon)}

    def __len__(self) -> int:
        return PATTERNS + len(self.lexicon)

    def packed(self, text: str) -> bytes:
        """The votes on a whole text, eight to a byte."""
        return self.votes(text).to_bytes(-(-len(self) // 8), "little")

    def __getstate__(self):
        return {"lexicon": self.lexicon, "bit": self.bit, "_votes": {}, "_hashed": {}, "_both": {}}

    def _token_votes(self, token: str) -> int:
        """The votes a token casts, and SHOUTING if it is in upper case."""
        if len(self._votes) >= REMEMBER:
            self._votes.clear()
        votes = 0
        for name in features_of(token.lower()):
            votes |= self.bit.get(name, 0)
        votes = self._votes[token] = votes | token.isupper() << SHOUTING
        return votes

    def _token_features(self, token: str) -> list[int]:
        if len(self._hashed) >= REMEMBER:
            self._hashed.clear()
        names = features_of(token.lower())
        found = self._hashed[token] = [xxhash.xxh32_intdigest(name) % BUCKETS for name in names]
        return found

    def votes(self, text: str) -> int:
        """The votes on a whole text as bits; patterns count distinct tokens."""
        tokens = set(text.split())
        votes, hits, upper = 0, 0, 0
        for token in tokens:
            cast = self._votes.get(token)
            if cast is None:
                cast = self._token_votes(token)
            if cast:
                votes |= cast
                hits += cast >> PATTERNS != 0
                upper += cast >> SHOUTING & 1
        return self._settled(votes, hits, upper, len(tokens))

    @staticmethod
    def _settled(votes: int, hits: int, upper: int, tokens: int) -> int:
        """``votes`` of tokens with those of the patterns."""
        votes &= ~(1 << SHOUTING)
        votes |= (hits == 0) << NONE | (hits >= 2) << SEVERAL
        votes |= (hits * 50 >= max(1, tokens)) << DENSE
        return votes | (2 * upper > tokens) << SHOUTING

    def _token_both(self, token: str) -> tuple[int, list[int]]:
        if len(self._both) >= REMEMBER:
            self._both.clear()
        names, votes = features_of(token.lower()), 0
        for name in names:
            votes |= self.bit.get(name, 0)
        hashed = [xxhash.xxh32_intdigest(name) % BUCKETS for name in names]
        found = self._both[token] = votes | token.isupper() << SHOUTING, hashed
        return found

    def both(self, text: str) -> tuple[bytes, np.ndarray]:
        """``packed`` and ``features`` of a whole text, which is split and looked up once."""
        tokens, known = set(text.split()), self._both
        votes, hits, upper = 0, 0, 0
        hashed: set[int] = set()
        for token in tokens:
            cast, names = known.get(token) or self._token_both(token)
            hashed.update(names)
            if cast:
                votes |= cast
                hits += cast >> PATTERNS != 0
                upper += cast >> SHOUTING & 1
        votes = self._settled(votes, hits, upper, len(tokens))
        return votes.to_bytes(-(-len(self) // 8), "little"), np.fromiter(hashed, np.int32, len(hashed))

    def features(self, text: str) -> np.ndarray:
        """The distinct features of a whole text."""
        hashed: set[int] = set()
        for token in set(text.split()):
            found = self._hashed.get(token)
            hashed.update(self._token_features(token) if found is None else found)
        return np.fromiter(hashed, np.int32, len(hashed))


def mine(sample: DataFrame) -> tuple[list[str], float]:
    """Words and beginnings that mark label 1 in ``sample``, and the share of label 1.

    Tasks count documents per feature; features whose evidence exceeds what chance would
    give the best of so many are all taken, in its order, those that occur in clean texts
    later, but one that begins a chosen one, or begins with it, adds nothing.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: list[Counter] = [Counter(), Counter()]
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                names = {name for token in set(text.lower().split()) for name in features_of(token)}
                seen[label].update(names)
            names = list(seen[0].keys() | seen[1].keys())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(names, pa.string()),
                    pa.array([seen[1][n] for n in names], pa.int64()),
                    pa.array([seen[0][n] for n in names], pa.int64()),
                ],
                ["name", "pos", "neg"],
            )

    sample = materialise(sample.select("text", F.col("label").cast("int").alias("label")), "labelled")
    sizes = sample.agg(F.count("*").alias("n"), F.sum("label").alias("pos")).first()
    if not sizes.n or not sizes.pos or sizes.pos == sizes.n:
        return [], 0.1
    prior = sizes.pos / sizes.n
    counted = sample.mapInArrow(count, "name string, pos long, neg long")
    counted = counted.groupBy("name").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    counted = materialise(counted.where("pos > 1"), "marks")
    precision = F.col("pos") / (F.col("pos") + F.col("neg"))
    # how much more likely the counts are at their own share of label 1 than at the prior
    evidence = F.col("pos") * F.log(precision / prior) + F.when(
        F.col("neg") > 0, F.col("neg") * F.log((1 - precision) / (1 - prior))
    ).otherwise(0.0)
    chance = math.log(20.0 * max(1, counted.count()))
    ranked = (
        counted.withColumn("evidence", evidence)
        .where((precision >= 0.75) & (F.col("evidence") >= chance))
        .orderBy(F.desc(F.col("evidence") - CLEAN_COST * F.col("neg")), F.desc(F.length("name")), "name")
        .collect()
    )
    chosen: list[str] = []
    for row in ranked:
        stem = row.name.rstrip("*")
        if not any(stem.startswith(c.rstrip("*")) or c.startswith(stem) for c in chosen):
            chosen.append(row.name)
    return chosen, prior


@dataclass
class LabelModel:
    """How often each voter fires on toxic and clean texts, and what its vote counts for.

    A voter that does not fire abstains: that is no evidence.
    """

    prior: float
    fires: np.ndarray  # 2 x voters: on clean, on toxic
    counts_for: np.ndarray  # 1, down to a half for voters that fire together with others

    def posterior(self, votes: np.ndarray | list[bytes]) -> np.ndarray:
        """The chance that a text with these votes is toxic."""
        cast = unpacked(votes, len(self.counts_for))
        clean, toxic = self.fires
        logit = math.log(self.prior / (1 - self.prior))
        logit = logit + cast @ (self.counts_for * np.log(toxic / clean))
        return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))


def unpacked(votes: np.ndarray | list[bytes], voters: int) -> np.ndarray:
    """A column for each voter, from numbers or from bytes as ``Voters.packed`` gives them."""
    if isinstance(votes, np.ndarray) and votes.dtype != object:
        return (votes[:, None] >> np.arange(voters) & 1).astype(float)
    rows = np.frombuffer(b"".join(votes), np.uint8).reshape(len(votes), -(-voters // 8))
    return np.unpackbits(rows, axis=1, count=voters, bitorder="little").astype(float)


def fit_label_model(patterns: DataFrame, voters: int, prior: float) -> LabelModel:
    """Fit on ``votes, n``: the vote patterns of all documents and how many have each.

    Expectation-maximisation; each round is one pass over the patterns that adds up first and
    second moments of the votes for both kinds of text, so what is collected depends on the
    number of voters alone. Bounds keep the two kinds apart: words fire rarely on clean
    texts, and texts without any hit are rarely toxic. A voter's weight falls with its
    correlations to others among toxic texts.
    """
    low, high = np.full((2, voters), 1e-4), np.full((2, voters), 0.999)
    high[0, PATTERNS:] = 0.03
    high[0, SEVERAL], high[0, DENSE], high[1, NONE], low[0, NONE] = 0.05, 0.05, 0.05, 0.6
    fires = np.full((2, voters), 0.05)
    fires[0, PATTERNS:], fires[1, PATTERNS:] = 0.005, 0.1
    fires[:, NONE], fires[:, SEVERAL], fires[:, DENSE] = (0.9, 0.02), (0.01, 0.5), (0.01, 0.4)
    model = LabelModel(prior, fires, np.ones(voters))
    size = voters * voters

    def moments(model: LabelModel):
        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((2, 1 + size))
            for batch in batches:
                votes, n = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy()
                cast, toxic = unpacked(votes, voters), model.posterior(votes)
                for kind, share in enumerate((1 - toxic, toxic)):
                    weight = share * n
                    total[kind, 0] += weight.sum()
                    total[kind, 1:] += ((cast * weight[:, None]).T @ cast).ravel()
            total = total.ravel()
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["at", "value"])

        return add

    for _ in range(ROUNDS):
        rows = patterns.mapInArrow(moments(model), "at long, value double")
        total = np.zeros(2 * (1 + size))
        for row in rows.groupBy("at").agg(F.sum("value").alias("value")).collect():
            total[row["at"]] = row["value"]
        total = total.reshape(2, 1 + size)
        weight = np.maximum(total[:, 0], 1e-9)
        second = total[:, 1:].reshape(2, voters, voters) / weight[:, None, None]
        first = np.einsum("kii->ki", second)
        fires = np.clip((first * weight[:, None] + 0.01) / (weight[:, None] + 1), low, high)
        spread = np.sqrt(np.maximum(first[1] * (1 - first[1]), 1e-9))
        together = (second[1] - np.outer(first[1], first[1])) / np.outer(spread, spread)
        np.fill_diagonal(together, 0)
        share = min(max(weight[1] / weight.sum(), 1e-3), 0.5)
        model = LabelModel(share, fires, np.maximum(0.5, 1 / (1 + np.maximum(together, 0).sum(axis=1))))
    return model


@dataclass
class Linear:
    """A logistic classifier over hashed features and votes."""

    weights: np.ndarray
    bias: float
    votes: np.ndarray

    def score(self, votes: list[bytes], features: list[np.ndarray]) -> np.ndarray:
        logit = self.bias + unpacked(votes, len(self.votes)) @ self.votes
        logit = logit + np.array([self.weights[f].sum(dtype=float) for f in features])
        return np.round(1 / (1 + np.exp(-np.clip(logit, -30, 30))), 6)


def train(votes: list[bytes], features: list[np.ndarray], target: np.ndarray, weight: np.ndarray, voters: int) -> Linear:
    """Logistic regression on posterior labels by full-batch gradients with momentum."""
    column = np.concatenate(features) if features else np.empty(0, np.int32)
    row = np.repeat(np.arange(len(features)), [len(f) for f in features])
    cast, weight = unpacked(votes, voters), weight / max(weight.sum(), 1e-9)
    params = np.zeros(BUCKETS + voters + 1)
    first, second = np.zeros_like(params), np.zeros_like(params)
    for step in range(1, STEPS + 1):
        logit = np.bincount(row, params[column], len(features)) + cast @ params[BUCKETS:-1] + params[-1]
        error = weight * (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - target)
        gradient = np.concatenate(
            [np.bincount(column, error[row], BUCKETS), error @ cast, [error.sum()]]
        )
        gradient[:BUCKETS] += SHRINK * params[:BUCKETS]
        first = 0.9 * first + 0.1 * gradient
        second = 0.99 * second + 0.01 * gradient**2
        rate = 0.05 * (1 - step / (STEPS + 1))
        params -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-5)
    return Linear(params[:BUCKETS].astype(np.float32), float(params[-1]), params[BUCKETS:-1])


def classify(docs: DataFrame, labels: DataFrame, held_out: Column, cut: float = 0.3) -> DataFrame:
    """Score every row of ``docs``: ``doc_id, score, predicted``.

    ``held_out`` is a condition on doc_id; labels of such rows are never read, and their
    texts are not trained on. Labels only propose words for voters; without labels of both
    kinds the fixed words and the patterns vote alone. A null or empty text casts the vote
    of texts without any hit. Null doc_ids are scored; rows given twice come back twice; an
    empty table gives an empty result. No column but doc_id and text is looked at.
    """
    sample = labelled_sample(docs, labels, "toxic", held_out, SAMPLE)
    mined, prior = mine(sample)
    fixed = [w for w in f"{INSULTS} {INSULTS_OTHER}".split() if not any(w.startswith(m.rstrip("*")) for m in mined)]
    voters = Voters(mined + fixed)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [voters.packed(text) for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.binary())], ["doc_id", "votes"]
            )

    cast = materialise(rows.mapInArrow(vote, "doc_id long, votes binary"), "votes")
    patterns = materialise(cast.groupBy("votes").agg(F.count("*").alias("n")), "vote-patterns")
    model = fit_label_model(patterns, len(voters), prior)
    linear = _train_on_posteriors(rows, cast, voters, model, held_out)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [voters.both(text) for text in batch.column(1).to_pylist()]
            scores = linear.score([votes for votes, _ in found], [features for _, features in found])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores), pa.array((scores >= cut).astype(np.int32))],
                ["doc_id", "score", "predicted"],
            )

    return rows.mapInArrow(score, "doc_id long, score double, predicted int")


def _train_on_posteriors(
    rows: DataFrame, cast: DataFrame, voters: Voters, model: LabelModel, held_out: Column
) -> Linear:
    """Train on the texts of both kinds whose doc_id has the least hash, weighted to the whole."""

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            toxic = model.posterior(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(toxic)], ["doc_id", "votes", "toxic"])

    judged = cast.where(~held_out).mapInArrow(judge, "doc_id long, votes binary, toxic double")
    judged = materialise(judged.where("doc_id is not null"), "posteriors")
    parts = []
    for most, kind in ((TRAIN_TOXIC, F.col("toxic") >= 0.5), (TRAIN_CLEAN, F.col("toxic") < 0.5)):
        total = judged.where(kind).count()
        part = judged.where(kind).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
        parts.append(part.withColumn("weight", F.lit(total / max(1, min(most, total)))))
    chosen = F.broadcast(materialise(parts[0].unionByName(parts[1]), "training"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.sort(voters.features(text)).tobytes() for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.select(["doc_id", "votes", "toxic", "weight"]).columns, pa.array(found, pa.binary())],
                ["doc_id", "votes", "toxic", "weight", "features"],
            )

    texts = rows.join(chosen, "doc_id").select("doc_id", "text", "votes", "toxic", "weight")
    texts = texts.mapInArrow(read, "doc_id long, votes binary, toxic double, weight double, features binary")
    found = texts.orderBy("doc_id", "votes").limit(TRAIN_TOXIC + TRAIN_CLEAN).collect()
    return train(
        [bytes(r.votes) for r in found],
        [np.frombuffer(r.features, np.int32) for r in found],
        np.array([r.toxic for r in found]), np.array([r.weight for r in found]), len(voters),
    )
