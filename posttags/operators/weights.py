"""TF, the two IDFs, and TF-IDF, all in long form.

The ratio form is tf * N / df with tf the share of the post. The smooth form is
cnt * ln((N + 1) / (df + 1)), where a term found in fewer than ``min_df`` posts weighs 0.
The two are never mixed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from posttags.functions import text as tx
from posttags.operators.tokens import value_counts
from posttags.session import materialise
from posttags.skew import HOT_ROWS, lookup, rows_of_most

RATIO, SMOOTH = "ratio", "smooth"
HASH_BUCKETS = 1 << 20


def n_posts(posts: DataFrame) -> Column:
    """Number of posts, empty ones included, as a scalar subquery."""
    return posts.agg(F.count("*")).scalar()


def doc_frequency(counts: DataFrame) -> DataFrame:
    return counts.groupBy("term").agg(F.count("*").alias("df"))


def idf_of(df: Column, n: Column, kind: str, min_df: int = 2) -> Column:
    if kind == RATIO:
        return n / df
    if kind == SMOOTH:
        return F.when(df >= min_df, F.log((n + 1.0) / (df + 1.0))).otherwise(F.lit(0.0))
    raise ValueError(f"idf kind must be {RATIO!r} or {SMOOTH!r}, not {kind!r}")


def idf(counts: DataFrame, n: Column, kind: str, min_df: int = 2) -> DataFrame:
    """``term, df, idf``."""
    return doc_frequency(counts).withColumn("idf", idf_of(F.col("df"), n, kind, min_df))


def tfidf(
    counts: DataFrame, n: Column, kind: str, min_df: int = 2, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """``doc_id, term, cnt, df, weight``; rows of weight 0 are dropped in smooth form.

    df is the number of rows a term has, so the hot terms are known without a count. The most
    frequent terms, which have most of the rows, take the hot path too.
    Terms of weight 0 never reach the join. ``counts`` is read twice, for the IDF table and
    for the join; from ``tokens.term_counts`` that is a scan of the posts without a shuffle.
    """
    table = materialise(idf(counts, n, kind, min_df), "idf")
    if kind == SMOOTH:
        table = table.where(F.col("idf") != 0)
    sizes = table.select("term", F.col("df").alias("n"))
    hot_rows = min(hot_rows, rows_of_most(sizes))
    base = F.col("cnt") if kind == SMOOTH else F.col("tf")
    return lookup(counts, table, "term", sizes, hot_rows).select(
        "doc_id", "term", "cnt", "df", (base * F.col("idf")).alias("weight")
    )


def hashed_tfidf(counts: DataFrame, n: Column, min_df: int = 2) -> DataFrame:
    """Smooth TF-IDF over buckets, whose number bounds the IDF table: it is broadcast."""
    table = idf(counts, n, SMOOTH, min_df).where(F.col("idf") != 0)
    weighed = counts.join(F.broadcast(table), "term")
    return weighed.select("doc_id", "term", "cnt", "df", (F.col("cnt") * F.col("idf")).alias("weight"))


def hashed_counts(tokenised: DataFrame, buckets: int = HASH_BUCKETS) -> DataFrame:
    """``doc_id, term, cnt`` with the term replaced by its MD5 bucket."""
    hashed = F.transform("tokens", lambda token: tx.md5_bucket(token, buckets))
    return value_counts(tokenised, hashed).select("doc_id", F.col("value").alias("term"), "cnt")


def term_totals(counts: DataFrame, n: Column, kind: str, min_df: int = 2) -> DataFrame:
    """``term, cf, df, idf, total``: weight of each term summed over the corpus.

    IDF is constant per term, so the sum needs one aggregation and no join.
    """
    base = F.col("cf") if kind == SMOOTH else F.col("_tf")
    aggs = [F.sum("cnt").alias("cf"), F.count("*").alias("df")]
    if kind == RATIO:
        aggs.append(F.sum("tf").alias("_tf"))
    return (
        counts.groupBy("term")
        .agg(*aggs)
        .withColumn("idf", idf_of(F.col("df"), n, kind, min_df))
        .withColumn("total", base * F.col("idf"))
        .select("term", "cf", "df", "idf", "total")
    )
