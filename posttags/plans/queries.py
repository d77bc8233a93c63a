"""The registered queries: every operator on the whole driver tables.

``documents`` and ``labels`` make the tagged posts; ``embeddings`` gives ready vectors.
Computed doubles are rounded so that engines can be compared.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from posttags.functions import text as tx, vectors as vx
from posttags.functions.rows import unfold_numbered
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
from posttags.plans import jobs
from posttags.session import materialise, spread, stage_path
from posttags.skew import with_position
from posttags.sources import posts as src

K = 10
TOP_TERMS = 1000
MIN_COSINE = 0.3
NB_TAG = "even"
TEXT_TAG = "quality"
TOP_PERCENT = 25
LIST_ROWS = 40
TEXT_DIMS = 6


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(_table(spark, sf_dir, "documents"), "doc_id")


def _posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return src.posts_from_tables(_documents(spark, sf_dir), _table(spark, sf_dir, "labels"))


def _tokenised(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tk.tokenise(_documents(spark, sf_dir))


def _counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tk.term_counts(_tokenised(spark, sf_dir))


def _n(spark: SparkSession, sf_dir: str) -> Column:
    return wt.n_posts(_table(spark, sf_dir, "documents"))


def _points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``id, features, tags`` of the embeddings: tag t0..t9 by label, even or odd."""
    parity = F.when(F.col("label") % 2 == 0, F.lit("even")).otherwise(F.lit("odd"))
    return _table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"),
        vx.as_doubles(F.col("embedding")).alias("features"),
        F.array(F.concat(F.lit("t"), F.col("label").cast("string")), parity).alias("tags"),
    )


def _text_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``id, features, tags`` of the documents over their strongest terms."""
    return jobs.points_of(_posts(spark, sf_dir), TOP_TERMS)


def _rounded(df: DataFrame, *names: str, digits: int = 6) -> DataFrame:
    return df.withColumns({name: F.round(name, digits) for name in names})


# --- reading and parsing -------------------------------------------------------------


def parse_posts(spark, sf_dir):
    lines = src.post_lines(_posts(spark, sf_dir))
    posts = tg.with_primary_tag(src.parse_lines(lines))
    return posts.select(
        "doc_id", "text", F.array_join("tags", " ").alias("tag_text"), "primary_tag"
    )


def text_source(spark, sf_dir):
    path = stage_path(spark, "lines")
    src.post_lines(_posts(spark, sf_dir)).select("value").write.text(path)
    return src.read_posts(spark, path).select("text", F.array_join("tags", " ").alias("tag_text"))


def stage_roundtrip(spark, sf_dir):
    path = stage_path(spark, "stage")
    src.save_stage(_posts(spark, sf_dir).select("doc_id", F.explode("tags").alias("tag")), path)
    src.save_stage(tg.tag_rows(_posts(spark, sf_dir)), path, overwrite=True)
    return src.load_stage(spark, path)


def peek(spark, sf_dir):
    rows, first = src.peek(_table(spark, sf_dir, "documents"), "doc_id")
    return first.select("doc_id", "text", F.lit(rows).cast("bigint").alias("n_rows"))


# --- tokens and weights --------------------------------------------------------------


def tokenize(spark, sf_dir):
    return tk.token_rows(_tokenised(spark, sf_dir))


def inverted_index(spark, sf_dir):
    return tk.inverted_rows(_tokenised(spark, sf_dir))


def token_total(spark, sf_dir):
    return tk.token_total(_tokenised(spark, sf_dir))


def vocabulary(spark, sf_dir):
    return tk.vocabulary(_tokenised(spark, sf_dir))


def document_frequency(spark, sf_dir):
    return wt.doc_frequency(_counts(spark, sf_dir))


def tf_normalised(spark, sf_dir):
    return _rounded(_counts(spark, sf_dir), "tf")


def idf_ratio(spark, sf_dir):
    return _rounded(wt.idf(_counts(spark, sf_dir), _n(spark, sf_dir), wt.RATIO), "idf")


def idf_smooth(spark, sf_dir):
    return _rounded(wt.idf(_counts(spark, sf_dir), _n(spark, sf_dir), wt.SMOOTH), "idf")


def tfidf_ratio(spark, sf_dir):
    weights = jobs.tfidf_of(_documents(spark, sf_dir), wt.RATIO)
    return _rounded(weights.select("doc_id", "term", "weight"), "weight")


def tfidf_ratio_hot(spark, sf_dir):
    """As ``tfidf_ratio``, with every term of 50 posts or more taking the hot-key path."""
    weights = jobs.tfidf_of(_documents(spark, sf_dir), wt.RATIO, hot_rows=50)
    return _rounded(weights.select("doc_id", "term", "weight"), "weight")


def tfidf_smooth(spark, sf_dir):
    weights = jobs.tfidf_of(_documents(spark, sf_dir), wt.SMOOTH)
    return _rounded(weights.select("doc_id", "term", "weight"), "weight")


def tf_hashed(spark, sf_dir):
    return wt.hashed_counts(_tokenised(spark, sf_dir)).withColumnRenamed("term", "bucket")


def tfidf_hashed(spark, sf_dir):
    weights = jobs.hashed_tfidf_of(_documents(spark, sf_dir))
    return _rounded(
        weights.select("doc_id", F.col("term").alias("bucket"), "weight"), "weight"
    )


def term_totals(spark, sf_dir):
    totals = wt.term_totals(_counts(spark, sf_dir), _n(spark, sf_dir), wt.SMOOTH)
    return _rounded(totals.select("term", "cf", "df", "total"), "total")


def top_terms(spark, sf_dir):
    top = jobs.strongest_terms(_documents(spark, sf_dir), TOP_TERMS)
    return _rounded(top.select("term", "total", "rank"), "total")


def top_terms_collapsed(spark, sf_dir):
    top = jobs.strongest_terms(_documents(spark, sf_dir), TOP_TERMS, collapse_ties=True)
    return _rounded(top.select("term", "total", "rank"), "total")


def top_terms_collapsed_ratio(spark, sf_dir):
    top = jobs.strongest_terms(_documents(spark, sf_dir), TOP_TERMS, wt.RATIO, collapse_ties=True)
    return _rounded(top.select("term", "total", "rank"), "total")


# --- vectors -------------------------------------------------------------------------


def vocab_vectors(spark, sf_dir):
    weights = materialise(jobs.tfidf_of(_documents(spark, sf_dir), wt.RATIO), "weights")
    return _rounded(select.vocab_vectors(weights), "weight")


def reduced_vectors(spark, sf_dir):
    docs = _documents(spark, sf_dir)
    picked = jobs.strongest_terms(docs, TOP_TERMS)
    counts = tk.term_counts(tk.tokenise(docs))
    return _rounded(select.reduced_rows(counts, picked, wt.SMOOTH), "value")


def reduced_vectors_dense(spark, sf_dir):
    dense = select.dense_arrays(jobs.reduce_posts(_documents(spark, sf_dir), TOP_TERMS))
    return _rounded(
        vec.to_sparse(dense, "doc_id", "features").withColumnRenamed("idx", "rank"), "value"
    )


def doc_norms(spark, sf_dir):
    return _rounded(vec.norms(jobs.tfidf_of(_documents(spark, sf_dir), wt.RATIO)), "norm")


def _sparse_points(spark, sf_dir):
    return vec.to_sparse(_points(spark, sf_dir), "id", "features")


def sparse_from_dense(spark, sf_dir):
    return _rounded(_sparse_points(spark, sf_dir), "value")


def vector_sum(spark, sf_dir):
    return _rounded(vec.sum_vectors(_sparse_points(spark, sf_dir)), "total")


def vec_add(spark, sf_dir):
    """Each vector plus itself with the odd slots negated: those sums vanish."""
    rows = _sparse_points(spark, sf_dir)
    sign = F.when(F.col("idx") % 2 == 0, 1.0).otherwise(-1.0)
    return _rounded(
        vec.add_sparse(rows, rows.withColumn("value", F.col("value") * sign), "id"), "value"
    )


def pca_covariance(spark, sf_dir):
    return _rounded(vec.covariance(_points(spark, sf_dir), "features"), "cov")


def _pca_points(spark, sf_dir):
    points = _points(spark, sf_dir)
    vectors = vec.as_ml_vectors(points, "id", F.col("features"))
    model, projected = jobs.pca_of(vectors, "id", 10)
    path = stage_path(spark, "pca")
    src.save_model(model, path)
    return vec.project(src.load_model(path), vectors, "id").select(
        "id", vector_to_array("features").alias("features")
    )


def pca_transform(spark, sf_dir):
    rows = unfold_numbered(_pca_points(spark, sf_dir), F.col("features"), "axis", "value", "id")
    return _rounded(rows.withColumn("value", F.abs("value")), "value")


def pca_axes(spark, sf_dir):
    """What makes axes principal: unit length, right angles, no covariance, all variance.

    Over all axes of the embeddings; ``falling`` says that no axis has more variance than the
    one before it.
    """
    vectors = vec.as_ml_vectors(_points(spark, sf_dir), "id", F.col("features"))
    width = len(vectors.first()["features"])
    model, projected = jobs.pca_of(vectors, "id", width)
    axes = model.pc.toArray()
    dots = (axes.T @ axes).tolist()
    dots = spark.createDataFrame(
        [(i, j, dots[i][j]) for i in range(width) for j in range(i, width)], "i int, j int, dot double"
    )
    values = projected.select(vector_to_array("features").alias("features"))
    cov = vec.covariance(values, "features")
    spread = cov.where("i = j").agg(
        F.sum("cov").alias("total"),
        F.transform(F.array_sort(F.collect_list(F.struct("i", "cov"))), lambda s: s["cov"]).alias("each"),
    )
    falling = F.forall(F.sequence(F.lit(1), F.size("each") - 1), lambda k: F.col("each")[k] <= F.col("each")[k - 1] + 1e-9)
    spread = spread.select(F.struct("total", falling.alias("falling")).alias("s")).scalar()
    off = F.when(F.col("i") != F.col("j"), F.abs(F.round("cov", 6))).alias("off")
    found = dots.join(cov, ["i", "j"]).withColumn("s", spread)
    return found.select(
        "i", "j", F.abs(F.round("dot", 6)).alias("dot"), off,
        F.round("s.total", 5).alias("total"), F.col("s.falling").alias("falling"),
    )


def pca_documents(spark, sf_dir):
    vectors = jobs.reduce_posts(_documents(spark, sf_dir), TOP_TERMS)
    vectors = materialise(vectors, "reduced")
    _, projected = jobs.pca_of(vectors, "doc_id", 10)
    return unfold_numbered(projected, vector_to_array("features"), "axis", "value", "doc_id")


def pca_nb(spark, sf_dir):
    points = _points(spark, sf_dir).drop("features").join(_pca_points(spark, sf_dir), "id")
    return evaluate.confusion_matrix(jobs.bayes_for_tag(points, NB_TAG))


# --- similarity ----------------------------------------------------------------------


def _neighbouring_ids(spark, sf_dir):
    """Each post with the one before it in the order of ids: one cell per post."""
    ids = with_position(_table(spark, sf_dir, "documents").select("doc_id"), F.col("doc_id"))
    after = ids.select((F.col("position") - 1).alias("position"), F.col("doc_id").alias("id0"))
    return after.join(ids.withColumnRenamed("doc_id", "id1"), "position").select("id0", "id1")


def _nested(spark, sf_dir):
    weights = jobs.tfidf_of(_documents(spark, sf_dir), wt.RATIO)
    return similarity.nest(weights)


def common_tokens(spark, sf_dir):
    return similarity.common_tokens(_neighbouring_ids(spark, sf_dir), _nested(spark, sf_dir))


def cosine_of_pairs(spark, sf_dir):
    pairs = _neighbouring_ids(spark, sf_dir)
    return _rounded(similarity.cosine_of(pairs, _nested(spark, sf_dir)), "cosine")


def _similar_ids(spark, sf_dir, nested):
    """The pairs of different posts that the prefix filter proposes and the cosine confirms."""
    pairs = jobs.similar_posts(_documents(spark, sf_dir), MIN_COSINE, nested=nested).where("id0 != id1")
    return materialise(pairs.select("id0", "id1"), "similar-ids")


def common_tokens_similar(spark, sf_dir):
    """What every pair of similar posts shares."""
    nested = materialise(jobs.nested_posts(_documents(spark, sf_dir)), "nested")
    return similarity.common_tokens(_similar_ids(spark, sf_dir, nested), nested)


def cosine_of_similar(spark, sf_dir):
    """The pair operator on every pair of similar posts, as ``cosine_pairs`` gives them."""
    nested = materialise(jobs.nested_posts(_documents(spark, sf_dir)), "nested")
    pairs = _similar_ids(spark, sf_dir, nested)
    return _rounded(similarity.cosine_of(pairs, nested), "cosine")


def post_copies(spark, sf_dir):
    return tk.post_copies(_tokenised(spark, sf_dir))


def cosine_pairs(spark, sf_dir):
    return _rounded(jobs.similar_posts(_documents(spark, sf_dir), MIN_COSINE), "cosine")


def cosine_pairs_grid(spark, sf_dir):
    """As ``cosine_pairs``, with the rows of every prefix term dealt into groups of five."""
    pairs = jobs.similar_posts(_documents(spark, sf_dir), MIN_COSINE, group_rows=5)
    return _rounded(pairs, "cosine")


def cosine_pairs_repeat(spark, sf_dir):
    pairs = jobs.similar_posts(_documents(spark, sf_dir), MIN_COSINE, repeat_weighting=True)
    return _rounded(pairs, "cosine")


# --- tags ----------------------------------------------------------------------------


def tag_counts(spark, sf_dir):
    return tg.tag_counts(_posts(spark, sf_dir))


def tag_total(spark, sf_dir):
    return tg.distinct_tags(_posts(spark, sf_dir)).agg(F.count(F.lit(1)).alias("n_tags"))


def top_percent_tags(spark, sf_dir):
    return tg.top_percent_tags(_posts(spark, sf_dir), TOP_PERCENT)


def posts_with_tag(spark, sf_dir):
    return tg.posts_with_tag(_posts(spark, sf_dir), TEXT_TAG).select("doc_id")


def non_tag_anti(spark, sf_dir):
    return tg.posts_without_tag(_posts(spark, sf_dir), TEXT_TAG).select("doc_id")


def train_test_split(spark, sf_dir):
    return neighbors.split_by_hash(_posts(spark, sf_dir).select("doc_id"), "doc_id")


def train_semi(spark, sf_dir):
    posts = _posts(spark, sf_dir)
    train = neighbors.split_by_hash(posts, "doc_id").where("is_train").select("doc_id")
    return tg.tag_rows(posts.join(train, "doc_id", "left_semi"))


# --- nearest neighbours --------------------------------------------------------------


def knn_neighbors(spark, sf_dir):
    return _rounded(jobs.knn(_points(spark, sf_dir), K).neighbors, "distance")


def knn_neighbors_cells(spark, sf_dir):
    """As ``knn_neighbors``, with 16 cells cut into blocks of 64 rows."""
    found = jobs.knn(_points(spark, sf_dir), K, pivots=16, block_rows=64).neighbors
    return _rounded(found, "distance")


def knn_predict_all(spark, sf_dir):
    return jobs.knn(_points(spark, sf_dir), K).predicted


def knn_predict_first(spark, sf_dir):
    return jobs.knn(_points(spark, sf_dir), K, all_tags=False).predicted


def tag_postings(spark, sf_dir):
    return jobs.knn(_points(spark, sf_dir), K).predicted.select("tag", "test_id")


def tag_posting_lists(spark, sf_dir):
    lists = tg.posting_lists(tg.tag_rows(_posts(spark, sf_dir)), "doc_id", LIST_ROWS)
    ids = F.array_join(F.transform("ids", lambda i: i.cast("string")), ",")
    return lists.select("tag", "part", ids.alias("ids"))


def top_predicted_tags(spark, sf_dir):
    return evaluate.most_frequent(jobs.knn(_points(spark, sf_dir), K).predicted, 20)


def top_actual_tags(spark, sf_dir):
    split = neighbors.split_by_hash(_points(spark, sf_dir), "id")
    return evaluate.most_frequent(tg.tag_rows(split.where(~F.col("is_train")), "id"), 50)


def tag_confusion(spark, sf_dir):
    return jobs.knn(_points(spark, sf_dir), K).confusion


def tag_metrics(spark, sf_dir):
    metrics = jobs.knn(_points(spark, sf_dir), K).metrics
    return _rounded(metrics, "precision", "recall", "accuracy", "f_score")


def tag_metrics_all(spark, sf_dir):
    """Metrics of every predicted tag, saved and loaded again."""
    metrics = jobs.knn(_points(spark, sf_dir), K, top_predicted=None).metrics
    path = stage_path(spark, "metrics")
    src.save_stage(metrics, path)
    return _rounded(src.load_stage(spark, path), "precision", "recall", "accuracy", "f_score")


def knn_hit_rate(spark, sf_dir):
    points = _points(spark, sf_dir)
    tested = neighbors.split_by_hash(points, "id").where(~F.col("is_train"))
    tested = tested.select(F.col("id").alias("test_id"), "tags")
    rate = evaluate.hit_rate(jobs.knn(points, K).predicted, tested, "test_id")
    return _rounded(rate, "hit_rate")


def knn_documents(spark, sf_dir):
    return _rounded(jobs.knn(_text_points(spark, sf_dir), K).neighbors, "distance")


def knn_documents_metrics(spark, sf_dir):
    metrics = jobs.knn_of_posts(_posts(spark, sf_dir), K, TOP_TERMS).metrics
    return _rounded(metrics, "precision", "recall", "accuracy", "f_score")


# --- naive Bayes ---------------------------------------------------------------------


def _judged(spark, sf_dir):
    return _points(spark, sf_dir).select(
        "id", "features", F.array_contains("tags", NB_TAG).alias("label")
    )


def class_prior(spark, sf_dir):
    return _rounded(bayes.class_prior(_judged(spark, sf_dir)), "prior")


def column_stats(spark, sf_dir):
    return _rounded(bayes.column_stats(_judged(spark, sf_dir)), "mean", "variance")


def nb_predict(spark, sf_dir):
    return jobs.bayes_for_tag(_points(spark, sf_dir), NB_TAG)


def nb_predict_holdout(spark, sf_dir):
    return jobs.bayes_for_tag(_points(spark, sf_dir), NB_TAG, holdout=True)


def nb_confusion(spark, sf_dir):
    return evaluate.confusion_matrix(jobs.bayes_for_tag(_points(spark, sf_dir), NB_TAG))


def nb_documents(spark, sf_dir):
    """Naive Bayes from posts to confusion matrix, on all selected terms."""
    return jobs.bayes_of_posts(_posts(spark, sf_dir), TEXT_TAG, TOP_TERMS, None)


def nb_documents_numdim(spark, sf_dir):
    """The same on the first TEXT_DIMS of the selected terms."""
    return jobs.bayes_of_posts(_posts(spark, sf_dir), TEXT_TAG, TOP_TERMS, None, TEXT_DIMS)


def nb_documents_pca(spark, sf_dir):
    """The same by way of ten principal axes."""
    return jobs.bayes_of_posts(_posts(spark, sf_dir), TEXT_TAG, TOP_TERMS, 10)


def nb_predict_all_tags_passes(spark, sf_dir):
    """As ``nb_predict_all_tags``, three tags to a pass."""
    points = _points(spark, sf_dir)
    return jobs.bayes_for_tags(points, tg.distinct_tags(points), tags_per_pass=3)


def nb_predict_all_tags(spark, sf_dir):
    points = _points(spark, sf_dir)
    return jobs.bayes_for_tags(points, tg.distinct_tags(points))


def nb_top_tag_metrics(spark, sf_dir):
    """Judges the classifiers of the most frequent half of the tags."""
    points = _points(spark, sf_dir)
    targets = materialise(tg.top_percent_tags(points, 50).select("tag"), "targets")
    predicted = materialise(jobs.bayes_for_tags(points, targets), "predicted")
    actual = tg.tag_rows(points, "id")
    confusion = evaluate.tag_confusion(
        predicted, actual, wt.n_posts(points), "id", top_predicted=None
    )
    return _rounded(evaluate.tag_metrics(confusion), "precision", "recall", "accuracy", "f_score")


QUERIES = {
    fn.__name__: fn
    for fn in (
        parse_posts, text_source, stage_roundtrip, peek,
        tokenize, inverted_index, token_total, vocabulary, document_frequency,
        tf_normalised, idf_ratio, idf_smooth, tfidf_ratio, tfidf_ratio_hot, tfidf_smooth,
        tf_hashed, tfidf_hashed, term_totals, top_terms, top_terms_collapsed,
        top_terms_collapsed_ratio,
        vocab_vectors, reduced_vectors, reduced_vectors_dense, doc_norms,
        sparse_from_dense, vector_sum, vec_add,
        pca_covariance, pca_axes, pca_transform, pca_documents, pca_nb,
        common_tokens, cosine_of_pairs, common_tokens_similar, cosine_of_similar, post_copies, cosine_pairs, cosine_pairs_grid,
        cosine_pairs_repeat,
        tag_counts, tag_total, top_percent_tags, posts_with_tag, non_tag_anti,
        train_test_split, train_semi,
        knn_neighbors, knn_neighbors_cells, knn_predict_all, knn_predict_first, tag_postings, tag_posting_lists,
        top_predicted_tags, top_actual_tags, tag_confusion, tag_metrics, tag_metrics_all,
        knn_hit_rate,
        knn_documents, knn_documents_metrics,
        class_prior, column_stats, nb_predict, nb_predict_holdout, nb_confusion,
        nb_documents, nb_documents_numdim, nb_documents_pca, nb_predict_all_tags, nb_predict_all_tags_passes,
        nb_top_tag_metrics,
    )
}
