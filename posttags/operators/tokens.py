"""Token lists, token rows and their counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from posttags.functions import text as tx
from posttags.functions.rows import hold, unfold, unfold_numbered
from posttags.session import materialise
from posttags.skew import lookup


def tokenise(
    posts: DataFrame,
    stopwords: Sequence[str] = tx.ENGLISH_STOPWORDS,
    unicode_blanks: bool = False,
) -> DataFrame:
    """``doc_id, text`` -> ``doc_id, tokens`` (ordered, repeats kept)."""
    words = tx.words_of(F.col("text"), unicode_blanks)
    return posts.select("doc_id", tx.drop_words(words, stopwords).alias("tokens"))


def token_rows(tokenised: DataFrame) -> DataFrame:
    """One row per token with its place in the post."""
    return unfold_numbered(tokenised, F.col("tokens"), "pos", "token", "doc_id")


def inverted_rows(tokenised: DataFrame) -> DataFrame:
    """``token, doc_id`` for every occurrence."""
    return unfold(tokenised, F.col("tokens"), "token", "doc_id").select("token", "doc_id")


def token_total(tokenised: DataFrame) -> DataFrame:
    return tokenised.agg(F.coalesce(F.sum(F.size("tokens")), F.lit(0)).alias("n_tokens"))


def vocabulary(tokenised: DataFrame) -> DataFrame:
    """The distinct tokens."""
    return unfold(tokenised, F.array_distinct("tokens"), "token").distinct()


def term_counts(tokenised: DataFrame) -> DataFrame:
    """``doc_id, term, cnt, tf``: count of a term in its post, and its share of the post."""
    return value_counts(tokenised, F.col("tokens")).select(
        "doc_id", F.col("value").alias("term"), "cnt", (F.col("cnt") / F.col("n")).alias("tf")
    )


def value_counts(rows: DataFrame, values: Column) -> DataFrame:
    """``doc_id, n, value, cnt``: how often each value occurs in the row's own list.

    A post is one row, so its counts need no shuffle: the list is sorted, the starts of its
    runs are found and unfolded, and each run ends where the next one starts.
    """
    ordered = hold(rows, F.sort_array(values), "_sorted", "doc_id").where(F.size("_sorted") > 0)
    starts = F.filter(
        F.sequence(F.lit(0), F.size("_sorted") - 1),
        lambda i: (i == 0) | (F.get("_sorted", i) != F.get("_sorted", i - 1)),
    )
    cut = hold(ordered, starts, "_starts", "doc_id", "_sorted")
    n = F.size("_sorted")
    runs = cut.select(
        "doc_id", n.alias("n"), "_sorted", "_starts", F.posexplode_outer("_starts").alias("_run", "_start")
    )
    end = F.coalesce(F.get("_starts", F.col("_run") + 1), F.col("n"))
    return runs.select(
        "doc_id",
        "n",
        F.get("_sorted", F.col("_start")).alias("value"),
        (end - F.col("_start")).cast("bigint").alias("cnt"),
    )


def post_copies(tokenised: DataFrame) -> DataFrame:
    """``doc_id, rep_id``: posts with the same bag of tokens share their lowest id.

    Linear in the posts however many copies there are. Posts without tokens are left out.
    """
    keyed = materialise(_with_bag_key(tokenised), "bag-keys")
    reps = keyed.groupBy("bag").agg(F.min("doc_id").alias("rep_id"))
    return lookup(keyed, reps, "bag").select("doc_id", "rep_id")


def distinct_bags(tokenised: DataFrame) -> DataFrame:
    """One row per distinct bag of tokens: lowest id, highest id, number of posts."""
    return (
        _with_bag_key(tokenised)
        .groupBy("bag")
        .agg(
            F.min("doc_id").alias("rep_id"),
            F.max("doc_id").alias("last_id"),
            F.count("*").alias("n_posts"),
        )
        .drop("bag")
    )


def _with_bag_key(tokenised: DataFrame) -> DataFrame:
    # No token holds a blank, so the joined sorted list identifies the bag.
    bag = F.sha2(F.array_join(F.sort_array("tokens"), " "), 256)
    return tokenised.where(F.size("tokens") > 0).select("doc_id", bag.alias("bag"))
