"""The five-post corpus with values worked by hand (FIXTURES.md, parts 3 and 4)."""

import pytest
from pyspark.sql import functions as F

from posttags.operators import select, similarity, tags as tg, tokens as tk, weights as wt
from posttags.plans import jobs
from posttags.sources.posts import parse_lines

STOP = ["the"]


@pytest.fixture(scope="module")
def tokenised(small_posts):
    return tk.tokenise(small_posts, STOP)


@pytest.fixture(scope="module")
def counts(tokenised):
    return tk.term_counts(tokenised)


def test_tokens(tokenised):
    assert tk.token_total(tokenised).first().n_tokens == 15
    assert tk.vocabulary(tokenised).count() == 9
    rows = tk.token_rows(tokenised).where("doc_id = 0").orderBy("pos").collect()
    assert [r.token for r in rows] == ["java", "thread", "pool", "thread"]
    assert tk.inverted_rows(tokenised).where("token = 'thread'").count() == 2


def test_tf_sums_to_one(counts):
    for row in counts.groupBy("doc_id").agg(F.sum("tf").alias("s")).collect():
        assert row.s == pytest.approx(1.0)


def test_idf(small_posts, counts):
    n = wt.n_posts(small_posts)
    ratio = {r.term: r.idf for r in wt.idf(counts, n, "ratio").collect()}
    smooth = {r.term: r.idf for r in wt.idf(counts, n, "smooth").collect()}
    assert ratio["java"] == pytest.approx(5 / 3) and ratio["thread"] == 5.0
    assert smooth["java"] == pytest.approx(0.405465, abs=1e-6)
    assert smooth["null"] == pytest.approx(0.693147, abs=1e-6)
    assert smooth["thread"] == 0.0


@pytest.mark.parametrize("hot_rows", [2, 10_000_000])
def test_tfidf_ratio(small_posts, counts, hot_rows):
    rows = wt.tfidf(counts, wt.n_posts(small_posts), "ratio", hot_rows=hot_rows).collect()
    got = {(r.doc_id, r.term): round(r.weight, 6) for r in rows}
    assert len(rows) == len(got) == 14
    assert got[0, "java"] == 0.416667 and got[0, "thread"] == 2.5 and got[0, "pool"] == 1.25
    assert got[1, "null"] == 0.833333 and got[1, "pointer"] == 1.666667
    assert got[4, "java"] == got[4, "swift"] == 0.833333


def test_top_terms(small_posts, counts):
    totals = wt.term_totals(counts, wt.n_posts(small_posts), "smooth")
    top = select.top_terms(totals, 3).orderBy("rank").collect()
    assert [r.term for r in top] == ["null", "java", "swift"]
    assert top[0].total == pytest.approx(1.386294, abs=1e-6)
    assert top[1].total == pytest.approx(1.216395, abs=1e-6)
    collapsed = select.top_terms(totals, 3, collapse_ties=True).orderBy("rank").collect()
    assert [r.term for r in collapsed] == ["null", "java"]
    assert select.top_terms(totals, 100).count() == 3
    assert select.top_terms(totals, 0).count() == 0


def test_reduced_forms_agree(small_posts, tokenised, counts):
    totals = wt.term_totals(counts, wt.n_posts(small_posts), "smooth")
    picked = select.top_terms(totals, 3)
    long = {
        (r.doc_id, r.rank): r.value
        for r in select.reduced_rows(counts, picked, "smooth").collect()
    }
    dense = select.dense_arrays(select.reduced_vectors(tokenised, picked)).collect()
    assert len(dense) == 5
    for row in dense:
        assert row.features == [long.get((row.doc_id, i), 0.0) for i in range(3)]


def test_vocab_vectors(small_posts, counts):
    weights = wt.tfidf(counts, wt.n_posts(small_posts), "ratio")
    rows = select.vocab_vectors(weights).collect()
    terms = ["button", "java", "null", "optional", "pointer", "pool", "swift", "thread", "ui"]
    assert len(rows) == 14
    got = {(r.doc_id, terms[r.term_id]): round(r.weight, 6) for r in rows}
    assert got[0, "thread"] == 2.5 and got[1, "null"] == 0.833333


EXPECTED_COSINES = {
    (1, 0): 0.042126, (3, 1): 0.183673, (3, 2): 0.065547, (4, 0): 0.104257,
    (4, 1): 0.202031, (4, 3): 0.202031, (4, 2): 0.162221,
}


@pytest.mark.parametrize("group_rows", [1, 10_000])
def test_cosine_pairs(small_posts, tokenised, counts, group_rows):
    weights = wt.tfidf(counts, wt.n_posts(small_posts), "ratio")
    bags = tk.distinct_bags(tokenised)
    rows = similarity.cosine_pairs(weights, bags, 1e-6, group_rows=group_rows).collect()
    got = {(r.id0, r.id1): round(r.cosine, 6) for r in rows}
    assert got == EXPECTED_COSINES | {(i, i): 1.0 for i in range(5)}
    above = similarity.cosine_pairs(weights, bags, 0.15).collect()
    assert {(r.id0, r.id1) for r in above} == {
        pair for pair, value in got.items() if value >= 0.15
    }


def test_cosine_repeat_weighting(small_posts, tokenised, counts):
    weights = wt.tfidf(counts, wt.n_posts(small_posts), "ratio")
    rows = similarity.cosine_pairs(weights, tk.distinct_bags(tokenised), 1e-6, True).collect()
    got = {(r.id0, r.id1): round(r.cosine, 6) for r in rows}
    assert got == EXPECTED_COSINES | {(i, i): 1.0 for i in range(1, 5)} | {(0, 0): 1.782609}


def test_cosine_of_given_pairs(spark, small_posts, counts):
    posts = similarity.nest(wt.tfidf(counts, wt.n_posts(small_posts), "ratio"))
    asked = [*EXPECTED_COSINES, (2, 0), (0, 0)]
    pairs = spark.createDataFrame(asked, "id0 bigint, id1 bigint")
    got = {
        (r.id0, r.id1): round(r.cosine, 6)
        for r in similarity.cosine_of(pairs, posts, hot_rows=2).collect()
    }
    assert got == EXPECTED_COSINES | {(0, 0): 1.0}
    shared = similarity.common_tokens(spark.createDataFrame([(0, 1), (0, 0)], pairs.schema), posts)
    assert sorted((r.id1, r.token, r.repeats) for r in shared.collect()) == [
        (0, "java", 1), (0, "pool", 1), (0, "thread", 2), (1, "java", 1),
    ]


def test_toy_pair(spark):
    posts = spark.createDataFrame(
        [(0, "foo foo bar bar bar cat school", []), (1, "foo cat cat dog dog dog dog", [])],
        "doc_id bigint, text string, tags array<string>",
    )
    assert {
        r.term: r.cnt for r in tk.term_counts(tk.tokenise(posts, [])).where("doc_id=1").collect()
    } == {"foo": 1, "cat": 2, "dog": 4}
    rows = jobs.similar_posts(posts, 1e-6, "ratio", stopwords=[]).where("id0 <> id1").collect()
    assert [(r.id0, r.id1, round(r.cosine, 6)) for r in rows] == [(1, 0, 0.071784)]
    assert jobs.similar_posts(posts, 1e-6, "smooth", stopwords=[]).count() == 0


def test_tag_counts(small_posts):
    got = {r.tag: r.n for r in tg.tag_counts(small_posts).collect()}
    assert got == {"java": 3, "swift": 3, "concurrency": 1, "ios": 1}
    top = tg.top_percent_tags(small_posts, 50).orderBy("rank").collect()
    assert [r.tag for r in top] == ["java", "swift"]
    assert tg.top_percent_tags(small_posts, 5).count() == 0
    assert tg.posts_without_tag(small_posts, "java").count() == 2


def test_posting_lists_keep_every_id(small_posts):
    rows = tg.posting_lists(tg.tag_rows(small_posts), "doc_id", list_rows=2).collect()
    java = sorted(i for r in rows if r.tag == "java" for i in r.ids)
    assert java == [0, 1, 4]


def test_copies_share_one_id(spark):
    lines = [(i, "b a c>>>x") for i in range(6)] + [(7, "a c b>>>y"), (8, "a c>>>y"), (9, ">>>z")]
    posts = parse_lines(spark.createDataFrame(lines, "doc_id bigint, value string"))
    tokenised = tk.tokenise(posts, STOP)
    reps = {r.doc_id: r.rep_id for r in tk.post_copies(tokenised).collect()}
    assert reps == {**{i: 0 for i in range(6)}, 7: 0, 8: 8}
    bags = {r.rep_id: (r.last_id, r.n_posts) for r in tk.distinct_bags(tokenised).collect()}
    assert bags == {0: (7, 7), 8: (8, 1)}
