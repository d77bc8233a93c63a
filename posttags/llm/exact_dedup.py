"""Exact deduplication against a persistent digest index.

The index is a Parquet table bucketed and sorted by digest, so a batch of new texts meets it
by a sort-merge join that shuffles the batch's digests only, never the index or any text.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession, functions as F

from posttags.llm.common import join_hot, lower_ascii, whole_text
from posttags.session import materialise, stage_path

BUCKETS = 64


class DigestIndex:
    """The digests of all texts seen so far, each with the doc_id of the row that stays.

    ``path`` must be in a shared folder; opening the same path again, in another session too,
    continues the index. ``buckets`` belongs to the path and must not change afterwards.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS):
        self.spark, self.buckets = spark, buckets
        self.table = "digest_index_" + hashlib.sha256(path.encode()).hexdigest()[:24]
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.table} (digest BINARY, keep_id BIGINT) "
            f"USING parquet CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS "
            f"LOCATION '{path}'"
        )

    def rows(self) -> DataFrame:
        return self.spark.table(self.table)

    def append(self, fresh: DataFrame) -> None:
        """Add ``digest, keep_id`` rows; one file per bucket and batch."""
        placed = fresh.select("digest", "keep_id").repartition(self.buckets, "digest")
        placed.write.insertInto(self.table)


def digests(docs: DataFrame) -> DataFrame:
    """``doc_id, digest``: SHA-256 of the whole text with A-Z lower-cased."""
    digest = F.unhex(F.sha2(lower_ascii(whole_text()), 256))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), digest.alias("digest"))


def deduplicate(docs: DataFrame, index: DigestIndex) -> DataFrame:
    """Judge ``docs`` against the index and each other, and append what is new.

    Returns one row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``. Of
    equal texts in the batch the largest doc_id stays, unless the index already knows the
    text: then its row stays and all of these go. ``group_size`` counts the batch's rows.

    A null text is empty. A null doc_id stays only if every copy has none. A row given twice
    with one doc_id has one fate. An empty table gives an empty result. Other columns of
    ``docs`` are not looked at, whatever their names.
    """
    rows = materialise(digests(docs), "digests")
    groups = materialise(
        rows.groupBy("digest").agg(
            F.max("doc_id").alias("batch_id"), F.count("*").alias("group_size")
        ),
        "digest-groups",
    )
    known = index.rows().hint("merge")
    fresh = groups.join(known, "digest", "left_anti")
    index.append(fresh.select("digest", F.col("batch_id").alias("keep_id")))
    judged = materialise(groups.join(index.rows().hint("merge"), "digest"), "digest-judged")
    total = judged.agg(F.coalesce(F.sum("group_size"), F.lit(0))).first()[0]
    return join_hot(rows, judged, "digest", "group_size", total).select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def deduplicate_once(docs: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``deduplicate`` against a new, empty index."""
    spark = docs.sparkSession
    return deduplicate(docs, DigestIndex(spark, stage_path(spark, "digest-index"), buckets))
