"""The edge cases of FIXTURES.md, part 7, that no other file has."""

import pytest
from pyspark.sql import functions as F

from posttags.operators import evaluate, neighbors, select, tags as tg, tokens as tk, weights as wt
from posttags.plans import jobs


def test_repeated_tag_in_one_post(spark):
    """Counted twice in tag counts and votes, once in metrics."""
    posts = spark.createDataFrame(
        [(0, ["a", "a", "b"]), (1, ["b"]), (2, ["a", "a"])], "id bigint, tags array<string>"
    )
    assert {r.tag: r.n for r in tg.tag_counts(posts).collect()} == {"a": 4, "b": 2}
    found = spark.createDataFrame([(9, 0), (9, 1)], "test_id bigint, train_id bigint")
    ballots = neighbors.votes(found, posts, True)
    assert {r.tag: r.votes for r in ballots.collect()} == {"a": 2, "b": 2}
    predicted = spark.createDataFrame([(0, "a"), (2, "a")], "test_id bigint, tag string")
    actual = tg.tag_rows(posts, "id").withColumnRenamed("id", "test_id")
    n = wt.n_posts(posts)
    row = evaluate.tag_confusion(predicted, actual, n, "test_id", None).collect()
    assert [(r.tag, r.tp, r.fp, r.fn, r.tn) for r in row] == [("a", 2, 0, 0, 1)]


@pytest.mark.parametrize("list_rows", [1, 2, 100])
def test_posting_lists_are_cut_in_order(spark, list_rows):
    tagged = spark.createDataFrame(
        [("x", i) for i in (5, 3, 9, 1)] + [("y", 7)], "tag string, id bigint"
    )
    lists = {(r.tag, r.part): r.ids for r in tg.posting_lists(tagged, "id", list_rows).collect()}
    ids = [1, 3, 5, 9]
    want = {("x", at // list_rows): ids[at : at + list_rows] for at in range(0, 4, list_rows)}
    assert lists == want | {("y", 0): [7]}


def test_collapsed_ties_in_ratio_form(spark):
    """Equal (cf, df) does not mean equal totals there; every distinct total stays."""
    posts = spark.createDataFrame(
        [(0, "a b b c"), (1, "a d"), (2, "e f")], "doc_id bigint, text string"
    )
    counts = tk.term_counts(tk.tokenise(posts, []))
    totals = wt.term_totals(counts, wt.n_posts(posts), "ratio")
    every = {round(r.total, 9) for r in totals.collect()}
    top = select.top_terms(totals, 100, collapse_ties=True).collect()
    assert [round(r.total, 9) for r in top] == sorted(every, reverse=True)
    assert [r.term for r in top] == ["b", "a", "c"]


@pytest.mark.parametrize("parts", [1, 8])
def test_results_do_not_depend_on_partitions(small_posts, parts):
    posts = small_posts.repartition(parts)
    top = jobs.strongest_terms(posts, 4, "ratio").collect()
    assert [r.term for r in top] == [r.term for r in jobs.strongest_terms(small_posts, 4, "ratio").collect()]
    hashed = jobs.hashed_tfidf_of(posts, 16).select("doc_id", "term", F.round("weight", 9)).collect()
    assert sorted(hashed) == sorted(
        jobs.hashed_tfidf_of(small_posts, 16).select("doc_id", "term", F.round("weight", 9)).collect()
    )
