"""Tag rows, counts, and the most frequent tags."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, functions as F

from posttags.functions import text as tx
from posttags.session import materialise
from posttags.skew import lookup, with_position

LIST_ROWS = 10_000  # ids in a list of posting_lists()


def tag_rows(posts: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``tag, id`` for every tag of every post, repeats kept."""
    return posts.select(F.explode("tags").alias("tag"), id_col)


def tag_counts(posts: DataFrame) -> DataFrame:
    tags = posts.select(F.explode("tags").alias("tag"))
    return tags.groupBy("tag").agg(F.count("*").alias("n"))


def distinct_tags(posts: DataFrame) -> DataFrame:
    return posts.select(F.explode("tags").alias("tag")).distinct()


def top_percent_tags(posts: DataFrame, percent: float) -> DataFrame:
    """The floor(percent / 100 * distinct tags) most frequent tags, by count then name.

    The cut grows with the number of tags, so tags are ranked by a distributed sort.
    """
    ranked = with_position(tag_counts(posts), F.col("n").desc(), F.col("tag").asc(), name="rank")
    cut = math.floor(0.01 * percent * ranked.count())
    return ranked.where(F.col("rank") < cut).select("tag", "n", "rank")


def posts_with_tag(posts: DataFrame, tag: str) -> DataFrame:
    return posts.where(F.array_contains("tags", tag))


def posts_without_tag(posts: DataFrame, tag: str) -> DataFrame:
    """Posts that do not carry the tag, untagged posts included."""
    return posts.where(~F.coalesce(F.array_contains("tags", tag), F.lit(False)))


def with_primary_tag(posts: DataFrame) -> DataFrame:
    return posts.withColumn("primary_tag", tx.primary_tag(F.col("tags")))


def posting_lists(tagged: DataFrame, id_col: str, list_rows: int = LIST_ROWS) -> DataFrame:
    """``tag, part, ids``: the ids of each tag in order, ``list_rows`` to a list.

    A frequent tag has several lists, numbered from 0, so no task gathers a whole tag. Rows
    are numbered by a distributed sort; the place of a row among its tag's says its list.
    """
    placed = with_position(tagged.select("tag", id_col), F.col("tag"), F.col(id_col), name="place")
    placed = materialise(placed, "postings")
    first = placed.groupBy("tag").agg(F.min("place").alias("first"), F.count("*").alias("n"))
    first = materialise(first, "posting-sizes")
    found = lookup(placed, first.select("tag", "first"), "tag", first.select("tag", "n"))
    part = F.floor((F.col("place") - F.col("first")) / list_rows).cast("bigint")
    return (
        found.select("tag", part.alias("part"), id_col)
        .groupBy("tag", "part")
        .agg(F.array_sort(F.collect_list(id_col)).alias("ids"))
    )
