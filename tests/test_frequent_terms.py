"""The most frequent terms meet their IDF and slot without a shuffle of their rows."""

import pytest

from posttags.operators import select, tokens as tk, weights as wt
from posttags.skew import rows_of_most

POSTS = [(0, "a a b c"), (1, "b b c d"), (2, "a c e"), (3, "c"), (4, ""), (5, None)]


@pytest.mark.parametrize("most, want", [(0, 512), (1, 512), (2, 8), (3, 4), (5, 2), (6, 1), (100, 1)])
def test_rows_of_most(spark, most, want):
    sizes = spark.createDataFrame(enumerate([1, 2, 3, 5, 256, 400]), "key bigint, n bigint")
    least = rows_of_most(sizes, most)
    assert least == want
    assert sizes.where(sizes.n >= least).count() <= most


def test_no_keys(spark):
    assert rows_of_most(spark.createDataFrame([], "key bigint, n bigint")) == 1


def test_frequent_terms_are_not_dealt_out(spark):
    """All terms of a small corpus are among the most frequent ones."""
    posts = spark.createDataFrame(POSTS, "doc_id bigint, text string")
    weights = wt.tfidf(tk.term_counts(tk.tokenise(posts, [])), wt.n_posts(posts), "ratio")
    plan = weights._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" in plan
    got = {(r.doc_id, r.term): (r.cnt, round(r.weight, 6)) for r in weights.collect()}
    assert got[0, "a"] == (2, 1.5) and got[1, "d"] == (1, 1.5) and got[3, "c"] == (1, 1.5) and len(got) == 10
    slots = {(r.doc_id, r.term_id): round(r.weight, 6) for r in select.vocab_vectors(weights).collect()}
    assert slots == {(doc, "abcde".index(term)): weight for (doc, term), (_, weight) in got.items()}


def test_counts_take_the_list_once(spark):
    """The runs of a sorted list are unfolded as they start; nothing is built for each of them."""
    posts = spark.createDataFrame(POSTS, "doc_id bigint, text string")
    counts = tk.term_counts(tk.tokenise(posts, []))
    assert "zip_with" not in counts._jdf.queryExecution().optimizedPlan().toString()
    got = {(r.doc_id, r.term, r.cnt, round(r.tf, 6)) for r in counts.where("doc_id < 2").collect()}
    assert got == {
        (0, "a", 2, 0.5), (0, "b", 1, 0.25), (0, "c", 1, 0.25),
        (1, "b", 2, 0.5), (1, "c", 1, 0.25), (1, "d", 1, 0.25),
    }
