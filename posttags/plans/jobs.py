"""The end-to-end jobs, composed of the operators."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import PCAModel
from pyspark.sql import DataFrame, functions as F

from posttags.functions import text as tx
from posttags.operators import (
    bayes,
    evaluate,
    neighbors,
    select,
    similarity,
    tags as tg,
    tokens as tk,
    vectors as vec,
    weights as wt,
)
from posttags.session import materialise
from posttags.skew import HOT_ROWS

SELECTED_TERMS = 1000


def tfidf_of(
    posts: DataFrame,
    kind: str,
    stopwords: Sequence[str] = tx.ENGLISH_STOPWORDS,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Posts -> ``doc_id, term, cnt, df, weight``."""
    counts = tk.term_counts(tk.tokenise(posts, stopwords))
    return wt.tfidf(counts, wt.n_posts(posts), kind, hot_rows=hot_rows)


def hashed_tfidf_of(
    posts: DataFrame,
    buckets: int = wt.HASH_BUCKETS,
    stopwords: Sequence[str] = tx.ENGLISH_STOPWORDS,
) -> DataFrame:
    """Posts -> smooth TF-IDF over MD5 buckets; ``term`` is the bucket."""
    counts = wt.hashed_counts(tk.tokenise(posts, stopwords), buckets)
    return wt.hashed_tfidf(counts, wt.n_posts(posts))


def strongest_terms(
    posts: DataFrame,
    size: int = SELECTED_TERMS,
    kind: str = wt.SMOOTH,
    collapse_ties: bool = False,
    stopwords: Sequence[str] = tx.ENGLISH_STOPWORDS,
) -> DataFrame:
    """The ``size`` terms with the highest summed TF-IDF."""
    counts = tk.term_counts(tk.tokenise(posts, stopwords))
    totals = wt.term_totals(counts, wt.n_posts(posts), kind)
    return select.top_terms(totals, size, collapse_ties)


def reduce_posts(
    posts: DataFrame,
    size: int = SELECTED_TERMS,
    collapse_ties: bool = False,
    stopwords: Sequence[str] = tx.ENGLISH_STOPWORDS,
) -> DataFrame:
    """Posts -> ``doc_id, features`` (ML vector over the strongest terms)."""
    picked = strongest_terms(posts, size, wt.SMOOTH, collapse_ties, stopwords)
    return select.reduced_vectors(tk.tokenise(posts, stopwords), picked)


def pca_of(vectors: DataFrame, id_col: str, k: int = 10) -> tuple[PCAModel, DataFrame]:
    """Fitted PCA and the projected rows (``id, features`` as ML vectors)."""
    model = vec.fit_pca(vectors, k)
    return model, vec.project(model, vectors, id_col)


def similar_posts(
    posts: DataFrame,
    min_cosine: float,
    kind: str = wt.RATIO,
    repeat_weighting: bool = False,
    stopwords: Sequence[str] = tx.ENGLISH_STOPWORDS,
    group_rows: int = similarity.GROUP_ROWS,
    nested: DataFrame | None = None,
) -> DataFrame:
    """Pairs of posts with a cosine at or above the threshold; copies share one id.

    ``nested`` spares the weighting where ``nested_posts``, or ``similarity.nest``, has the posts'
    weights already; pass a stage, as it is read several times.
    """
    staged = nested is not None
    if not staged:
        nested = nested_posts(posts, kind, stopwords)
    bags = None if "bags" in nested.columns else tk.distinct_bags(tk.tokenise(posts, stopwords))
    return similarity.nested_pairs(nested, bags, min_cosine, repeat_weighting, group_rows, staged)


def nested_posts(
    posts: DataFrame, kind: str = wt.RATIO, stopwords: Sequence[str] = tx.ENGLISH_STOPWORDS
) -> DataFrame:
    """Posts -> nested posts with their weights and bags, as ``similar_posts`` searches them."""
    bags = tk.distinct_bags(tk.tokenise(posts, stopwords))
    return similarity.nest(tfidf_of(posts, kind, stopwords), bags=bags)


@dataclass
class KnnResult:
    neighbors: DataFrame
    predicted: DataFrame
    actual: DataFrame
    confusion: DataFrame
    metrics: DataFrame


def knn(
    points: DataFrame,
    k: int = 25,
    all_tags: bool = True,
    top_predicted: int | None = 20,
    pivots: int | None = None,
    block_rows: int | None = None,
) -> KnnResult:
    """Split, search, vote and judge ``id, features, tags`` points.

    The confusion table and the metrics cover the ``top_predicted`` tags predicted most
    often; None keeps every predicted tag.
    """
    split = neighbors.split_by_hash(points, "id")
    train, test = split.where("is_train"), split.where(~F.col("is_train"))
    found = materialise(neighbors.nearest(test, train, k, pivots, block_rows), "neighbors")
    ballots = neighbors.votes(found, train.select("id", "tags"), all_tags)
    predicted = neighbors.predict_tags(ballots)
    actual = tg.tag_rows(test.select(F.col("id").alias("test_id"), "tags"), "test_id")
    confusion = evaluate.tag_confusion(
        predicted, actual, wt.n_posts(test), "test_id", top_predicted
    )
    return KnnResult(found, predicted, actual, confusion, evaluate.tag_metrics(confusion))


def points_of(
    posts: DataFrame,
    size: int = SELECTED_TERMS,
    pca: int | None = None,
    stopwords: Sequence[str] = tx.ENGLISH_STOPWORDS,
) -> DataFrame:
    """Tagged posts -> ``id, features, tags`` over the strongest terms, or that many axes."""
    vectors = reduce_posts(posts, size, stopwords=stopwords)
    if pca is not None:
        _, vectors = pca_of(materialise(vectors, "reduced"), "doc_id", pca)
    points = select.dense_arrays(vectors).join(posts.select("doc_id", "tags"), "doc_id")
    return materialise(points.withColumnRenamed("doc_id", "id"), "points")


def knn_of_posts(posts: DataFrame, k: int = 25, size: int = SELECTED_TERMS) -> KnnResult:
    """Tagged posts (``doc_id, text, tags``) -> nearest-neighbour predictions and metrics."""
    return knn(points_of(posts, size), k)


def bayes_of_posts(
    posts: DataFrame, tag: str, size: int = SELECTED_TERMS, pca: int | None = 10, dims: int | None = None
) -> DataFrame:
    """Tagged posts -> ``label, predicted_false, predicted_true`` of naive Bayes for a tag."""
    return evaluate.confusion_matrix(bayes_for_tag(points_of(posts, size, pca), tag, dims=dims))


def bayes_for_tag(
    points: DataFrame, tag: str, holdout: bool = False, dims: int | None = None
) -> DataFrame:
    """``id, label, prediction`` for one tag over ``id, features, tags`` points.

    Judges the posts it was fitted on, or with ``holdout`` fits on the train split and
    judges the rest. ``dims`` uses only so many first dimensions.
    """
    judged = points.select(
        "id",
        (F.slice("features", 1, dims) if dims else F.col("features")).alias("features"),
        F.coalesce(F.array_contains("tags", tag), F.lit(False)).alias("label"),
    )
    fitted = judged
    if holdout:
        split = neighbors.split_by_hash(judged, "id")
        fitted, judged = split.where("is_train"), split.where(~F.col("is_train"))
    return bayes.predict(judged, bayes.fit(fitted)).select("id", "label", "prediction")


def bayes_for_tags(
    points: DataFrame, targets: DataFrame, tags_per_pass: int = bayes.TAGS_PER_PASS
) -> DataFrame:
    """``id, tag`` for every target tag decided true; ``targets`` holds ``tag``."""
    tagged = (
        tg.tag_rows(points, "id").join(targets.select("tag"), "tag", "left_semi").distinct()
    )
    vectors = points.select("id", "features")
    return bayes.predict_tags(vectors, bayes.fit_tags(vectors, tagged, "id"), "id", tags_per_pass)
