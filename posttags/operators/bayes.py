"""One-vs-rest Gaussian naive Bayes: fit once by aggregation, score by a map."""

from __future__ import annotations

import math

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, functions as F

from posttags.functions import vectors as vx
from posttags.functions.rows import unfold, unfold_numbered
from posttags.session import materialise

TAGS_PER_PASS = 500  # tags whose parameters one scoring pass carries
# A difference of sums below this share of the corpus spread has lost too many digits: the
# negatives of such a tag are summed directly.
SWAMPED = 1e-6


def class_stats(judged: DataFrame) -> DataFrame:
    """``is_pos, n, mean, variance`` (sample variance) from boolean ``label, features``."""
    return (
        judged.groupBy(F.col("label").alias("is_pos"))
        .agg(_summary(F.col("features")).alias("s"))
        .select("is_pos", *_summary_columns())
    )


def column_stats(judged: DataFrame) -> DataFrame:
    """``is_pos, dim, mean, variance``: class statistics in long form."""
    both = F.arrays_zip("mean", "variance")
    rows = unfold_numbered(class_stats(judged), both, "dim", "s", "is_pos")
    return rows.select("is_pos", "dim", "s.mean", "s.variance")


def class_prior(judged: DataFrame) -> DataFrame:
    return judged.agg(F.avg(F.col("label").cast("double")).alias("prior"))


def fit(judged: DataFrame) -> DataFrame:
    """One-row model: ``n_pos, n_neg, pos_mean, pos_var, neg_mean, neg_var``."""
    stats = class_stats(judged)

    def of_class(column: str, positive: bool) -> Column:
        return F.max(F.when(F.col("is_pos") == positive, F.col(column)))

    return stats.agg(
        F.coalesce(of_class("n", True), F.lit(0)).alias("n_pos"),
        F.coalesce(of_class("n", False), F.lit(0)).alias("n_neg"),
        of_class("mean", True).alias("pos_mean"),
        of_class("variance", True).alias("pos_var"),
        of_class("mean", False).alias("neg_mean"),
        of_class("variance", False).alias("neg_var"),
    )


def decide(point: Column, model: Column) -> Column:
    """True if the positive class scores strictly higher.

    Log scores keep products of small densities from vanishing. A class without spread
    in some dimension gives NULL and so false; an empty class loses to the other one.
    """
    n = model["n_pos"] + model["n_neg"]
    fits = F.size(point) == F.size(F.coalesce(model["pos_mean"], model["neg_mean"]))
    point = F.when(fits, point).otherwise(F.raise_error(F.lit("point and model differ in size")))
    positive = vx.normal_log_score(point, model["pos_mean"], model["pos_var"]) + F.log(
        F.when(model["n_pos"] > 0, model["n_pos"] / n)
    )
    negative = vx.normal_log_score(point, model["neg_mean"], model["neg_var"]) + F.log(
        F.when(model["n_neg"] > 0, model["n_neg"] / n)
    )
    return (model["n_neg"] == 0) | F.coalesce(positive > negative, F.lit(False))


def predict(vectors: DataFrame, model: DataFrame) -> DataFrame:
    """Adds ``prediction``. The one-row model is a scalar subquery: no join, no shuffle."""
    row = model.select(F.struct(*model.columns)).scalar()
    return (
        vectors.withColumn("_model", row)
        .withColumn("prediction", decide(F.col("features"), F.col("_model")))
        .drop("_model")
    )


def fit_tags(vectors: DataFrame, tagged: DataFrame, id_col: str) -> DataFrame:
    """One model row per tag; ``tagged`` holds distinct ``(id, tag)`` rows.

    The positives of all tags come from one aggregation. The negatives of a tag are the
    corpus less its positives, so no post is counted once per tag it lacks; only tags whose
    negatives are so tight that the difference loses its digits sum them directly.
    """
    everything = (
        vectors.agg(_summary(F.col("features")).alias("s"))
        .select(*_summary_columns())
        .select(F.struct("n", "mean", "variance"))
    )
    positives = (
        tagged.join(vectors, id_col)
        .groupBy("tag")
        .agg(_summary(F.col("features")).alias("s"))
        .select("tag", *_summary_columns())
        .withColumn("all", everything.scalar())
    )
    n_pos, n_all = F.col("n"), F.col("all.n")
    n_neg = n_all - n_pos
    # Sums of squares about the mean split as: all = positives + negatives + gap.
    parts = F.transform(
        F.arrays_zip(
            F.col("mean").alias("pm"),
            F.col("variance").alias("pv"),
            F.col("all.mean").alias("am"),
            F.col("all.variance").alias("av"),
        ),
        lambda s: F.struct(
            F.when(n_neg > 0, (n_all * s["am"] - n_pos * s["pm"]) / n_neg).alias("mean"),
            s["pm"].alias("pm"),
            (s["av"] * (n_all - 1)).alias("spread"),
            (s["pv"] * (n_pos - 1)).alias("pos_spread"),
        ),
    )

    def left(s: Column) -> Column:
        gap = (s["pm"] - s["mean"]) * (s["pm"] - s["mean"]) * n_pos * n_neg / n_all
        return s["spread"] - s["pos_spread"] - gap

    derived = positives.withColumn("_neg", parts).select(
        "tag",
        n_pos.alias("n_pos"),
        n_neg.alias("n_neg"),
        F.col("mean").alias("pos_mean"),
        F.col("variance").alias("pos_var"),
        F.transform("_neg", lambda s: s["mean"]).alias("neg_mean"),
        F.transform("_neg", lambda s: F.when(n_neg > 1, left(s) / (n_neg - 1))).alias("neg_var"),
        F.exists("_neg", lambda s: (n_neg > 0) & (left(s) <= SWAMPED * s["spread"])).alias("swamped"),
    )
    derived = materialise(derived, "tag-models")
    direct = _direct_negatives(vectors, tagged, derived.where("swamped"), id_col)
    return derived.join(direct, "tag", "left").select(
        "tag", "n_pos", "n_neg", "pos_mean", "pos_var",
        F.coalesce("direct_mean", "neg_mean").alias("neg_mean"),
        F.coalesce("direct_var", "neg_var").alias("neg_var"),
    )


def _direct_negatives(
    vectors: DataFrame, tagged: DataFrame, models: DataFrame, id_col: str
) -> DataFrame:
    """``tag, direct_mean, direct_var`` summed over the posts that lack the tag."""
    tags = models.agg(F.collect_list("tag")).scalar()
    rows = vectors.withColumn("tag", F.explode(tags))
    return (
        rows.join(tagged, [id_col, "tag"], "left_anti")
        .groupBy("tag")
        .agg(_summary(F.col("features")).alias("s"))
        .select("tag", *_summary_columns())
        .select("tag", F.col("mean").alias("direct_mean"), F.col("variance").alias("direct_var"))
    )


def predict_tags(
    vectors: DataFrame, models: DataFrame, id_col: str, tags_per_pass: int = TAGS_PER_PASS
) -> DataFrame:
    """``id, tag`` for every tag decided true.

    One map over the posts scores up to about ``tags_per_pass`` tags, whose parameters
    travel as one scalar; more tags take further passes over the stored models, so the size
    carried is bounded and nothing is fitted twice.
    """
    models = materialise(models, "models")
    passes = max(1, math.ceil(models.count() / tags_per_pass))
    found = None
    for number in range(passes):
        share = models.where(F.pmod(F.xxhash64("tag"), F.lit(passes)) == number)
        packed = share.agg(F.collect_list(F.struct(*models.columns)))
        chosen = F.filter("_models", lambda model: decide(F.col("features"), model))
        scored = unfold(vectors.withColumn("_models", packed.scalar()), chosen, "_model", id_col)
        part = scored.select(id_col, F.col("_model.tag").alias("tag"))
        found = part if found is None else found.unionByName(part)
    return found


def _summary(features: Column) -> Column:
    return Summarizer.metrics("count", "mean", "variance").summary(array_to_vector(features))


def _summary_columns() -> list[Column]:
    return [
        F.col("s.count").alias("n"),
        vector_to_array(F.col("s.mean")).alias("mean"),
        vector_to_array(F.col("s.variance")).alias("variance"),
    ]
