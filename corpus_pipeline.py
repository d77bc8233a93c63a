"""From raw documents to packed training sequences, in five stages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from posttags.llm import decontaminate, exact_dedup, minhash, quality, queries as llm
from posttags.session import materialise


def _numbered(docs: DataFrame) -> DataFrame:
    """``docs`` with one more column, a number that no other row has: the doc_id, where one row has it.

    Rows without doc_id, and those that share one, get numbers of their own below all doc_ids.
    Stages judge and drop rows by it, so what holds for one of them holds for it alone.
    """
    taken = {name.lower() for name in docs.columns}
    row = next(name for k in range(len(taken) + 1) if (name := "row" + "_" * k) not in taken)
    number, many = f"{row}id", f"{row}many"
    key = F.col("doc_id").cast("long")
    ids = docs.groupBy(key.alias(number)).agg(F.count("*").alias(many))
    shared = materialise(ids.where(f"{many} > 1 or {number} is null").select(number), "shared-ids")
    if shared.isEmpty():
        return docs.withColumn(row, key)
    least = ids.agg(F.least(F.min(number), F.lit(0))).first()[0] or 0
    marks = shared.where(F.col(number).isNotNull()).withColumn(many, F.lit(True))
    numbered = docs.withColumn(number, key).join(marks, number, "left")
    own = F.lit(least - 1) - F.monotonically_increasing_id()
    unique = F.when(F.col(number).isNull() | F.col(many), own).otherwise(F.col(number))
    return materialise(numbered.select(*docs.columns, unique.alias(row)), "numbered")


def _judged(docs: DataFrame) -> DataFrame:
    """What an operator sees of numbered rows."""
    return docs.select(F.col(docs.columns[-1]).alias("doc_id"), "text")


def _without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """The numbered rows that are not among those ``gone``, without their numbers."""
    row = docs.columns[-1]
    gone = gone.select(F.col("doc_id").alias(row)).distinct()
    return docs.join(gone, row, "left_anti").select(docs.columns[:-1])


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop what the quality classifier rejects."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.keep_good(docs, quality.fit(docs, labels, llm.remainder(3, 1)))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each group of equal texts."""
    docs = _numbered(docs)
    return _without(docs, exact_dedup.deduplicate_once(_judged(docs)).where("not kept"))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near-duplicates."""
    docs = _numbered(docs)
    return _without(docs, minhash.near_duplicates(_judged(docs)).where("not kept"))


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that leak a benchmark item."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    docs = _numbered(docs)
    return _without(docs, decontaminate.leaks(_judged(docs), benchmark))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack what is left into sequences."""
    return llm.packed(docs)


STAGES = [
    ("quality", good),
    ("exact dedup", exact),
    ("near dedup", near),
    ("decontamination", clean),
    ("packing", packed),
]
# Neighbour votes, alignments and tokens have no SQL; the tests redo the stages by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
