"""Gaussian naive Bayes: worked one-dimensional case, edges, and all tags at once."""

import math

import pytest

from posttags.operators import bayes, evaluate
from posttags.plans import jobs

POINTS = "id bigint, features array<double>, tags array<string>"


def points(spark, positive, negative, extra=()):
    rows = [(x, ["c#"]) for x in positive] + [(x, ["sql"]) for x in negative]
    rows += [(x, t) for x, t in extra]
    data = [(i, [float(v) for v in (x if isinstance(x, list) else [x])], t) for i, (x, t) in enumerate(rows)]
    return spark.createDataFrame(data, POINTS)


def test_worked_case(spark):
    frame = points(spark, [1, 3], [10, 14, 15])
    judged = jobs.bayes_for_tag(frame, "c#")
    assert {r.id: r.prediction for r in judged.collect()} == {
        0: True, 1: True, 2: False, 3: False, 4: False,
    }
    matrix = evaluate.confusion_matrix(judged).orderBy("label").collect()
    assert [(r.predicted_false, r.predicted_true) for r in matrix] == [(3, 0), (0, 2)]
    labelled = frame.selectExpr("id", "features", "array_contains(tags, 'c#') AS label")
    stats = {r.is_pos: r for r in bayes.column_stats(labelled).collect()}
    assert (stats[True].mean, stats[True].variance) == (2.0, 2.0)
    assert (stats[False].mean, stats[False].variance) == (13.0, 7.0)
    assert bayes.class_prior(labelled).first().prior == pytest.approx(0.4)
    asked = spark.createDataFrame([(4, [4.0]), (6, [6.0])], "id bigint, features array<double>")
    got = bayes.predict(asked, bayes.fit(labelled)).collect()
    assert {r.id: r.prediction for r in got} == {4: True, 6: False}


@pytest.mark.parametrize(
    "positive, negative, expected",
    [
        ([5], [1, 2, 3], False),  # one positive row: no spread
        ([2, 2, 2], [1, 5, 9], False),  # constant column
        ([1, 3], [7, 7, 7], False),  # constant negative column
        ([], [1, 2, 3], False),  # no positive row
        ([1, 2, 3], [], True),  # no negative row
    ],
)
def test_edges(spark, positive, negative, expected):
    judged = jobs.bayes_for_tag(points(spark, positive, negative), "c#").collect()
    assert all(r.prediction is expected for r in judged)


def test_holdout_judges_the_rest(spark):
    frame = points(spark, list(range(40)), list(range(100, 160)))
    judged = jobs.bayes_for_tag(frame, "c#", holdout=True)
    assert 0 < judged.count() < 100
    assert judged.where("label <> prediction").count() == 0


@pytest.mark.parametrize("tags_per_pass", [1, 500])
def test_all_tags_agree_with_one_by_one(spark, tags_per_pass):
    extra = [([math.sin(i), i % 7 + 0.5 * math.cos(i)], [f"t{i % 3}", "all" if i % 2 else "odd"]) for i in range(60)]
    frame = points(spark, [], [], extra)
    tags = ["t0", "t1", "t2", "all", "odd"]
    targets = spark.createDataFrame([(t,) for t in tags], "tag string")
    tagged = frame.selectExpr("explode(tags) AS tag", "id")
    vectors = frame.select("id", "features")
    models = bayes.fit_tags(vectors, tagged, "id")
    together = {(r.id, r.tag) for r in bayes.predict_tags(vectors, models, "id", tags_per_pass).collect()}
    if tags_per_pass == 500:
        assert together == {(r.id, r.tag) for r in jobs.bayes_for_tags(frame, targets).collect()}
    single = {
        (r.id, tag)
        for tag in tags
        for r in jobs.bayes_for_tag(frame, tag).where("prediction").collect()
    }
    assert together == single and single


def agree(spark, frame, tags):
    targets = spark.createDataFrame([(t,) for t in tags], "tag string")
    together = {(r.id, r.tag) for r in jobs.bayes_for_tags(frame, targets).collect()}
    single = {
        (r.id, tag)
        for tag in tags
        for r in jobs.bayes_for_tag(frame, tag).where("prediction").collect()
    }
    assert together == single
    return together


def test_tight_negatives_keep_their_spread(spark):
    """Negatives far tighter than the corpus: a difference of sums has no digits left."""
    extra = [([1e7 * (i % 2)], ["p"]) for i in range(200)] + [([5 + 0.001 * (i % 2)], ["n"]) for i in range(20)]
    found = agree(spark, points(spark, [], [], extra), ["p", "n"])
    assert sum(tag == "p" for _, tag in found) == 200


def test_rare_negatives(spark):
    extra = [([math.sin(i) * 10], ["most"] if i % 30 else ["few"]) for i in range(120)]
    agree(spark, points(spark, [], [], extra), ["most", "few"])


def test_point_and_model_of_different_size(spark):
    frame = points(spark, [1, 3], [10, 14, 15])
    model = bayes.fit(frame.selectExpr("id", "features", "array_contains(tags, 'c#') AS label"))
    asked = spark.createDataFrame([(1, [1.0, 2.0])], "id bigint, features array<double>")
    with pytest.raises(Exception, match="differ in size"):
        bayes.predict(asked, model).collect()


def test_fewer_dimensions(spark):
    frame = points(spark, [[1, 9], [2, 9], [3, 9]], [[11, 9], [12, 9], [14, 9]])
    assert not any(r.prediction for r in jobs.bayes_for_tag(frame, "c#").collect())
    judged = jobs.bayes_for_tag(frame, "c#", dims=1).collect()
    assert [r.prediction for r in sorted(judged)] == [True] * 3 + [False] * 3
