"""Confusion counts and quality measures. Counting rows replaces sets of ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from posttags.functions import text as tx, vectors as vx


def most_frequent(tag_pairs: DataFrame, size: int) -> DataFrame:
    """The ``size`` tags with the most rows, by count then name."""
    return (
        tag_pairs.groupBy("tag")
        .agg(F.count("*").alias("n"))
        .orderBy(F.col("n").desc(), F.col("tag").asc())
        .limit(size)
    )


def tag_confusion(
    predicted: DataFrame,
    actual: DataFrame,
    n_tested: Column,
    id_col: str,
    top_predicted: int | None = 20,
) -> DataFrame:
    """``tag, tp, fp, fn, tn`` for tags both predicted and carried by a tested post.

    ``predicted`` and ``actual`` hold ``(id, tag)`` rows; ``n_tested`` is the number of
    tested posts. Only the ``top_predicted`` most predicted tags are judged; None takes all.
    """
    flagged = (
        predicted.select(id_col, "tag", F.lit(1).alias("p"), F.lit(0).alias("a"))
        .unionByName(actual.select(id_col, "tag", F.lit(0).alias("p"), F.lit(1).alias("a")))
        .groupBy(id_col, "tag")
        .agg(F.max("p").alias("p"), F.max("a").alias("a"))
    )
    counted = (
        flagged.groupBy("tag")
        .agg(
            F.sum(F.col("p") * F.col("a")).alias("tp"),
            F.sum("p").alias("np"),
            F.sum("a").alias("na"),
        )
        .where((F.col("np") > 0) & (F.col("na") > 0))
    )
    if top_predicted is not None:
        judged = most_frequent(predicted, top_predicted).select("tag")
        counted = counted.join(F.broadcast(judged), "tag", "left_semi")
    return counted.select(
        "tag",
        "tp",
        (F.col("np") - F.col("tp")).alias("fp"),
        (F.col("na") - F.col("tp")).alias("fn"),
        (n_tested - F.col("np") - F.col("na") + F.col("tp")).alias("tn"),
    )


def tag_metrics(confusion: DataFrame) -> DataFrame:
    """Adds precision, recall, accuracy and F; each 0 on an empty denominator."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    precision, recall = F.col("precision"), F.col("recall")
    return (
        confusion.withColumn("precision", vx.safe_ratio(tp, tp + fp))
        .withColumn("recall", vx.safe_ratio(tp, tp + fn))
        .withColumn("accuracy", vx.safe_ratio(tp + tn, tp + tn + fp + fn))
        .withColumn("f_score", vx.safe_ratio(2 * precision * recall, precision + recall))
    )


def hit_rate(predicted: DataFrame, actual: DataFrame, id_col: str) -> DataFrame:
    """``n_tested, hits, hit_rate``: share of tested posts with at least one right tag.

    ``predicted`` holds distinct ``(id, tag)`` rows and ``actual`` one ``(id, tags)`` row
    per tested post. A post without a prediction counts as missed.
    """
    guessed = predicted.groupBy(id_col).agg(F.collect_list("tag").alias("guessed"))
    judged = actual.join(guessed, id_col, "left").select(
        tx.any_shared(F.col("tags"), F.col("guessed")).alias("hit")
    )
    return judged.agg(
        F.count("*").alias("n_tested"),
        F.coalesce(F.sum("hit"), F.lit(0)).alias("hits"),
        F.avg("hit").alias("hit_rate"),
    )


def confusion_matrix(judged: DataFrame) -> DataFrame:
    """Boolean ``label, prediction`` rows -> one row per label, false first."""
    return (
        judged.groupBy("label")
        .pivot("prediction", [False, True])
        .agg(F.count(F.lit(1)))
        .select(
            "label",
            F.coalesce(F.col("false"), F.lit(0)).alias("predicted_false"),
            F.coalesce(F.col("true"), F.lit(0)).alias("predicted_true"),
        )
    )
