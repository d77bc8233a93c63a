"""Quality by nearest-neighbour voting among labelled latent-semantic vectors.

Texts become weighted term vectors over a fixed number of hashed terms, projected on the
leading singular directions of a bounded labelled sample. Every document meets every labelled
vector in blocks of exact cosine products; its neighbours vote by similarity.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from posttags.llm.common import few, give_back, lean, whole_text

# Hashed terms: word shapes and marks of the whole text, then words.
SHAPES, WORDS = 1024, 8192
TERMS = SHAPES + WORDS
# At most this many labelled rows are learnt from, spread over the labelled rows by hash.
SAMPLE = 3000
DIMENSIONS, NEIGHBOURS = 64, 15
REMEMBER = 500_000
BLOCK = 512



def _shape(word: str) -> str:
    """Runs of upper case, lower case and digits become A, a and 0; other signs stay once."""
    out = []
    for sign in word:
        kind = "a" if sign.islower() else "A" if sign.isupper() else "0" if sign.isdigit() else sign
        if not out or out[-1] != kind:
            out.append(kind)
    return "".join(out[:12])


class _Terms(dict):
    """The hashed shape and word of each word, remembered up to a bound."""

    def __missing__(self, word: str) -> int:
        if len(self) >= REMEMBER:
            self.clear()
        shape = xxhash.xxh32_intdigest(_shape(word)) % SHAPES
        term = SHAPES + xxhash.xxh32_intdigest(word.lower()) % WORDS
        found = self[word] = shape << 32 | term
        return found


_TERMS = _Terms()


def forget() -> None:
    _TERMS.clear()


def term_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The terms of a whole text and how often each occurs."""
    words = text.split()
    if not words:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    both = np.fromiter(map(_TERMS.__getitem__, words), np.int64, len(words))
    # how much of the text repeats itself, as one of eleven marks
    repeats = int(10 * (1 - len(set(words)) / len(words)))
    mark = xxhash.xxh32_intdigest(f"repeats {repeats}") % SHAPES
    terms = np.concatenate([both >> 32, both & 0xFFFFFFFF, [mark] * max(1, len(words) // 4)])
    return np.unique(terms, return_counts=True)


def document_counts(docs: DataFrame) -> tuple[np.ndarray, int]:
    """In how many of all documents each term occurs, and the number of documents.

    Tasks count into one array each; what is collected is one number per term.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(TERMS + 1, np.int64)
        for batch in batches:
            for text in few(batch.column(0)):
                seen[term_counts(text)[0]] += 1
            seen[TERMS] += batch.num_rows
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(seen[at])], ["term", "n"])

    rows = docs.select(whole_text().alias("text")).mapInArrow(lean(count, forget), "term long, n long")
    counts = np.zeros(TERMS + 1, np.int64)
    for row in rows.groupBy("term").agg(F.sum("n").alias("n")).collect():
        counts[row.term] = row.n
    return counts[:TERMS], int(counts[TERMS])


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, held_out: Column, most: int
) -> DataFrame:
    """``doc_id, text, label`` of at most ``most`` rows that are not held out.

    The rows are those with the least hash of their doc_id, so the choice does not depend on
    partitions; being that few, they are broadcast to the documents.
    """
    rows = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).alias("label"))
    rows = rows.where(~held_out & F.col("label").isin(0, 1))
    rows = rows.groupBy("doc_id").agg(F.max("label").alias("label"))
    rows = rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    return texts.join(F.broadcast(rows), "doc_id")


@dataclass
class Model:
    """``weights`` of terms, ``directions`` to project on, and the labelled vectors."""

    weights: np.ndarray
    directions: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray

    def project(self, texts: list[str]) -> np.ndarray:
        """Unit vectors of ``texts``; zero where a text has no known term."""
        found = [term_counts(text) for text in texts]
        out = np.zeros((len(texts), self.directions.shape[1]), np.float32)
        for at, (terms, counts) in enumerate(found):
            if len(terms):
                weight = (1 + np.log(counts)) * self.weights[terms]
                out[at] = weight.astype(np.float32) @ self.directions[terms]
        norm = np.linalg.norm(out, axis=1, keepdims=True)
        return out / np.where(norm > 0, norm, 1)

    def score(self, texts: list[str]) -> np.ndarray:
        """The similarity-weighted share of label 1 among the nearest labelled vectors."""
        prior = float(self.labels.mean()) if len(self.labels) else 0.5
        scores = np.full(len(texts), prior)
        k = min(NEIGHBOURS, len(self.labels))
        for at in range(0, len(texts) if k else 0, BLOCK):
            similar = self.project(texts[at : at + BLOCK]) @ self.vectors.T
            near = np.argpartition(-similar, k - 1, axis=1)[:, :k]
            weight = np.maximum(np.take_along_axis(similar, near, axis=1), 0).astype(float) ** 2
            total = weight.sum(axis=1)
            share = (weight * self.labels[near]).sum(axis=1) / np.where(total > 0, total, 1)
            scores[at : at + BLOCK] = np.where(total > 0, share, prior)
        return np.round(scores, 6)

    def score_column(self, texts: pa.Array) -> np.ndarray:
        """``score`` of an Arrow column, a block of texts at a time; nulls are empty."""
        found = [np.empty(0)]
        for at in range(0, len(texts), BLOCK):
            found.append(self.score([text or "" for text in texts.slice(at, BLOCK).to_pylist()]))
        return np.concatenate(found)


def _leading(products: np.ndarray, most: int, rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """The greatest eigenvalues and their vectors, by iterating a subspace somewhat larger than ``most``.

    A full decomposition would take several times the memory of ``products``.
    """
    width = min(len(products), most + 32)
    space = np.random.default_rng(5).standard_normal((len(products), width)).astype(products.dtype)
    for _ in range(rounds if width else 0):
        space = np.linalg.qr(products @ space)[0]
    values, inner = np.linalg.eigh(space.T @ products @ space) if width else (np.empty(0), np.empty((0, 0)))
    return values, space @ inner


def fit(docs: DataFrame, labels: DataFrame, held_out: Column, label: str = "quality") -> Model:
    """Fit on a labelled sample of at most SAMPLE rows, with term weights from all ``docs``."""
    counts, total = document_counts(docs)
    weights = np.log((1 + total) / (1 + counts))

    def terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [term_counts(text) for text in few(batch.column(1))]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(2),
                    pa.array([f[0].astype("<i4").tobytes() for f in found], pa.binary()),
                    pa.array([f[1].astype("<i4").tobytes() for f in found], pa.binary()),
                ],
                ["doc_id", "label", "terms", "counts"],
            )

    sample = labelled_sample(docs, labels, label, held_out, SAMPLE).select("doc_id", "text", "label")
    sample = sample.withColumn("label", F.col("label").cast("long"))
    rows = sample.mapInArrow(lean(terms, forget), "doc_id long, label long, terms binary, counts binary")
    rows = rows.orderBy("doc_id", "label").limit(SAMPLE).collect()
    loads = [(np.frombuffer(r.terms, "<i4"), np.frombuffer(r.counts, "<i4")) for r in rows]
    found = np.array([row.label for row in rows], float)

    def block(at: int) -> np.ndarray:
        """Some unit rows of the sample; the driver never holds all of them."""
        out = np.zeros((len(loads[at : at + BLOCK]), TERMS), np.float32)
        for row, (terms, counts) in zip(out, loads[at : at + BLOCK]):
            row[terms] = (1 + np.log(counts)) * weights[terms]
        return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)

    # singular directions by way of the rows' products, which are fewer than the terms
    starts = range(0, len(loads), BLOCK)
    products = np.zeros((len(loads), len(loads)), np.float32)
    for at in starts:
        left = block(at)
        for other in range(0, at + 1, BLOCK):
            part = left @ (left if other == at else block(other)).T
            products[at : at + BLOCK, other : other + BLOCK] = part
            products[other : other + BLOCK, at : at + BLOCK] = part.T
    values, vectors = _leading(products, DIMENSIONS)
    del products
    lead = [i for i in np.argsort(-values)[:DIMENSIONS] if values[i] > 1e-6]
    vectors = vectors[:, lead] / np.sqrt(values[lead]) if lead else np.zeros((len(loads), 1), np.float32)
    directions = np.zeros((TERMS, vectors.shape[1]), np.float32)
    for at in starts:
        directions += block(at).T @ vectors[at : at + BLOCK].astype(np.float32)
    latent = np.concatenate([block(at) @ directions for at in starts] or [np.zeros((0, directions.shape[1]), np.float32)])
    latent /= np.maximum(np.linalg.norm(latent, axis=1, keepdims=True), 1e-9)
    del loads, rows
    give_back()
    return Model(
        weights.astype(np.float32), directions.astype(np.float32), latent.astype(np.float32),
        found,
    )


def scored(docs: DataFrame, model: Model, cut: float = 0.5) -> DataFrame:
    """``doc_id, score, predicted`` of every row."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = model.score_column(batch.column(1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores), pa.array((scores >= cut).astype(np.int32))],
                ["doc_id", "score", "predicted"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    return rows.mapInArrow(lean(score, forget), "doc_id long, score double, predicted int")


def keep_good(docs: DataFrame, model: Model, cut: float = 0.5) -> DataFrame:
    """The rows of ``docs``, with all their columns, that score at least ``cut``."""
    place = docs.columns.index("text")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = model.score_column(batch.column(place))
            yield batch.filter(pa.array(scores >= cut, pa.bool_()))

    return docs.mapInArrow(lean(keep, forget), docs.schema)


def classify(docs: DataFrame, labels: DataFrame, held_out: Column, cut: float = 0.5) -> DataFrame:
    """Score every row of ``docs``: ``doc_id, score, predicted``.

    ``held_out`` is a condition on doc_id; labels of such rows are never read. Labels other
    than 0 and 1 are ignored; of several labels of a doc_id the larger counts. A null or
    empty text gets the share of label 1 in the sample, and so does every text when nothing
    could be learnt (then 0.5). Null doc_ids are scored; rows given twice come back twice; an
    empty table gives an empty result. No column but doc_id and text is looked at.
    """
    return scored(docs, fit(docs, labels, held_out), cut)
