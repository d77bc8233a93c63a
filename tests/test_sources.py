"""Parsing, reading, stages, positions, and the hot-key join."""

from pathlib import Path

import pytest
from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import functions as F

from posttags.functions import text as tx
from posttags.operators import tokens as tk, weights as wt
from posttags.plans import jobs
from posttags.session import stage_path
from posttags.skew import lookup, with_position, zip_with_index
from posttags.sources import posts as src


def parse(spark, *lines):
    frame = spark.createDataFrame(list(enumerate(lines)), "doc_id bigint, value string")
    return src.parse_lines(frame).orderBy("doc_id")


def test_line_shapes(spark):
    rows = parse(spark, "no splitter", "a>>>b>>>c", "  a   b  >>> x  y ", ">>>t", "a>>>").collect()
    assert [(r.text, r.tags) for r in rows] == [
        ("no splitter", None), ("a", ["b"]), ("  a   b  ", ["x", "y"]), ("", ["t"]), ("a", []),
    ]
    assert src.malformed(parse(spark, "no splitter", "a>>>b")).count() == 1


def test_blanks_case_and_empty_bodies(spark):
    posts = parse(spark, "  The   the  end >>>x", ">>>y")
    rows = tk.tokenise(posts, ["the"]).orderBy("doc_id").collect()
    assert [r.tokens for r in rows] == [["The", "end"], []]
    counts = tk.term_counts(tk.tokenise(posts, ["the"]))
    assert counts.where("doc_id = 1").count() == 0
    assert {r.idf for r in wt.idf(counts, wt.n_posts(posts), "ratio").collect()} == {2.0}


def test_unicode_blanks(spark):
    posts = parse(spark, "a b c>>>x")
    assert tk.tokenise(posts, []).first().tokens == ["a b", "c"]
    assert tk.tokenise(posts, [], unicode_blanks=True).first().tokens == ["a", "b", "c"]


def test_stopwords_are_sparks_default():
    assert list(tx.ENGLISH_STOPWORDS) == StopWordsRemover.loadDefaultStopWords("english")


def test_text_file_round_trip(spark):
    posts = parse(spark, *(f"word{i} x>>>t{i % 3}" for i in range(100)))
    path = stage_path(spark, "lines")
    src.post_lines(posts).select("value").coalesce(3).write.text(path)
    back = src.read_posts(spark, path)
    assert sorted(r.doc_id for r in back.collect()) == list(range(100))
    assert {(r.text, *r.tags) for r in back.collect()} == {(r.text, *r.tags) for r in posts.collect()}


def test_stage_overwrite(spark):
    path = stage_path(spark, "stage")
    src.save_stage(spark.range(5), path)
    with pytest.raises(Exception):
        src.save_stage(spark.range(5), path)
    src.save_stage(spark.range(7), path, overwrite=True)
    assert src.load_stage(spark, path).count() == 7
    count, first = src.peek(src.load_stage(spark, path), "id")
    assert count == 7 and [r.id for r in first.collect()] == [0, 1, 2]


def test_positions(spark):
    ids = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("v")).repartition(7)
    rows = with_position(ids, F.col("v").desc()).collect()
    assert {r.v: r.position for r in rows} == {v: 999 - v for v in range(1000)}
    numbered = zip_with_index(ids)
    assert sorted(r.position for r in numbered.collect()) == list(range(1000))


@pytest.mark.parametrize("hot_rows", [1, 50, 10_000])
def test_lookup_keeps_every_row(spark, hot_rows):
    rows = spark.range(300).select("id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"))
    table = spark.range(280).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    got = {(r.id, r.k, r.v) for r in lookup(rows, table, "k", hot_rows=hot_rows).collect()}
    expected = {(i, k, 2 * k) for i in range(300) for k in [0 if i % 3 == 0 else i] if k < 280}
    assert got == expected


def test_partitions_do_not_matter(spark, small_posts):
    def run(posts):
        return sorted((r.doc_id, r.term, round(r.weight, 9)) for r in jobs.tfidf_of(posts, "smooth").collect())

    assert run(small_posts.repartition(1)) == run(small_posts.repartition(8))


def test_hashed_weights_merge_colliding_words(spark, small_posts):
    one = jobs.hashed_tfidf_of(small_posts, buckets=1)
    assert one.count() == 0  # every post has the one bucket: ln(6/6)
    counts = wt.hashed_counts(tk.tokenise(small_posts, ["the"]), 1)
    assert {r.doc_id: r.cnt for r in counts.collect()} == {0: 4, 1: 3, 2: 3, 3: 3, 4: 2}


def test_scope_removes_its_stages(spark):
    from posttags.session import materialise, shared_dir, stage_scope

    def stages():
        folder = Path(shared_dir(spark).removeprefix("file:")) / "posttags"
        return {p.name for p in folder.glob("scoped-*")}

    kept = materialise(spark.range(3), "scoped")
    before = stages()
    with stage_scope(spark):
        materialise(spark.range(5), "scoped")
        assert len(stages()) == len(before) + 1
    assert stages() == before and kept.count() == 3
