"""Reading posts from text lines or tables; saving and loading stages and models."""

from __future__ import annotations

from pyspark.ml.feature import PCAModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from posttags.functions import text as tx
from posttags.skew import zip_with_index


def read_lines(spark: SparkSession, path: str, partitions: int | None = None) -> DataFrame:
    """Text lines; ``partitions`` spreads an input that does not split by itself."""
    lines = spark.read.text(path)
    return lines.repartition(partitions) if partitions else lines


def parse_lines(lines: DataFrame) -> DataFrame:
    """``value`` lines -> ``text, tags``; tags are NULL on a line without a splitter."""
    kept = [name for name in lines.columns if name != "value"]
    return lines.select(
        *kept,
        tx.body_of(F.col("value")).alias("text"),
        tx.words_of(tx.tag_text_of(F.col("value"))).alias("tags"),
    )


def malformed(posts: DataFrame) -> DataFrame:
    """Posts whose line had no splitter."""
    return posts.where(F.col("tags").isNull())


def read_posts(spark: SparkSession, path: str) -> DataFrame:
    """Posts of a text file, with ``doc_id`` the position of the line, fixed once."""
    return parse_lines(zip_with_index(read_lines(spark, path), "doc_id"))


def post_lines(posts: DataFrame) -> DataFrame:
    """Posts -> one raw line each; line breaks inside a body become blanks."""
    body = F.regexp_replace("text", r"[\r\n]+", " ")
    return posts.select(
        "doc_id", F.concat(body, F.lit(tx.SPLITTER), F.array_join("tags", " ")).alias("value")
    )


def posts_from_tables(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """``documents`` with tags from their language, source and quality/toxic labels."""
    tags = F.array_compact(
        F.array(
            F.col("lang"),
            F.col("source"),
            F.when(F.col("quality") == 1, F.lit("quality")),
            F.when(F.col("toxic") == 1, F.lit("toxic")),
        )
    )
    return documents.join(labels, "doc_id", "left").select("doc_id", "text", tags.alias("tags"))


def peek(df: DataFrame, *order: str, rows: int = 3) -> tuple[int, DataFrame]:
    """Row count and the first rows."""
    return df.count(), df.orderBy(*order).limit(rows)


def save_stage(df: DataFrame, path: str, overwrite: bool = False) -> None:
    df.write.mode("overwrite" if overwrite else "errorifexists").parquet(path)


def load_stage(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def save_model(model: PCAModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PCAModel:
    return PCAModel.load(path)
