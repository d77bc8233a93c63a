"""K nearest neighbours: the worked case, and brute force on random vectors."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from posttags.operators import evaluate, neighbors, tags as tg, weights as wt

POINTS = "id bigint, features array<double>, tags array<string>"
TRAIN = [
    (0, [0.0, 0.0], ["a", "b"]), (1, [1.0, 0.0], ["a"]), (2, [0.0, 2.0], ["b", "c"]),
    (3, [5.0, 5.0], ["c"]), (4, [1.0, 0.0], ["c", "a"]),
]
TEST = [(10, [0.0, 0.0], ["a"]), (11, [5.0, 4.0], ["c", "b"]), (12, [0.5, 0.0], ["z"])]


@pytest.fixture(scope="module")
def train(spark):
    return spark.createDataFrame(TRAIN, POINTS)


@pytest.fixture(scope="module")
def test(spark):
    return spark.createDataFrame(TEST, POINTS)


def ranked(found):
    out = {}
    for r in found.orderBy("test_id", "rn").collect():
        out.setdefault(r.test_id, []).append((r.train_id, r.distance))
    return out


@pytest.mark.parametrize("pivots", [1, 4])
def test_worked_order(test, train, pivots):
    got = ranked(neighbors.nearest(test, train, 5, pivots=pivots))
    assert got[10] == [(0, 0.0), (1, 1.0), (4, 1.0), (2, 2.0), (3, 7.071067812)]
    assert [i for i, _ in got[11]] == [3, 2, 1, 4, 0]
    assert got[12][:3] == [(0, 0.5), (1, 0.5), (4, 0.5)]
    assert got[12][3:] == [(2, 2.061552813), (3, 6.726812024)]


@pytest.mark.parametrize(
    "k, all_tags, expected",
    [
        (2, True, {10: "a", 11: "c", 12: "a"}),
        (2, False, {10: "a", 11: "bc", 12: "a"}),
        (3, True, {10: "a", 11: "c", 12: "a"}),
        (3, False, {10: "a", 11: "abc", 12: "a"}),
    ],
)
def test_votes(test, train, k, all_tags, expected):
    found = neighbors.nearest(test, train, k)
    for hot_rows in (2, 1000):
        ballots = neighbors.votes(found, train.select("id", "tags"), all_tags, hot_rows)
        got = {}
        for r in neighbors.predict_tags(ballots).collect():
            got.setdefault(r.test_id, set()).add(r.tag)
        assert got == {i: set(tags) for i, tags in expected.items()}


def test_metrics(test, train):
    found = neighbors.nearest(test, train, 2)
    predicted = neighbors.predict_tags(neighbors.votes(found, train.select("id", "tags")))
    actual = tg.tag_rows(test.select(F.col("id").alias("test_id"), "tags"), "test_id")
    metrics = evaluate.tag_metrics(
        evaluate.tag_confusion(predicted, actual, wt.n_posts(test), "test_id")
    )
    got = {r.tag: r for r in metrics.collect()}
    assert set(got) == {"a", "c"}
    a, c = got["a"], got["c"]
    assert (a.tp, a.fp, a.fn, a.tn) == (1, 1, 0, 1)
    assert (a.precision, a.recall) == (0.5, 1.0)
    assert a.accuracy == pytest.approx(2 / 3) and a.f_score == pytest.approx(2 / 3)
    assert (c.tp, c.fp, c.fn, c.tn, c.f_score) == (1, 0, 0, 2, 1.0)
    tested = test.select(F.col("id").alias("test_id"), "tags")
    rate = evaluate.hit_rate(predicted, tested, "test_id").first()
    assert (rate.n_tested, rate.hits) == (3, 2) and rate.hit_rate == pytest.approx(2 / 3)


def brute(test, train, k):
    out = {}
    for i, x in test:
        rows = sorted((round(float(np.linalg.norm(np.array(x) - np.array(y))), 9), j) for j, y in train)
        out[i] = [(j, d) for d, j in rows[:k]]
    return out


def cases():
    rng = np.random.default_rng(7)
    spread = rng.normal(size=(300, 3))
    clusters = rng.normal(size=(300, 4)) * 0.05 + rng.integers(0, 4, size=(300, 1)) * 10
    grid = rng.integers(0, 3, size=(300, 2)).astype(float)  # very many ties and copies
    copies = rng.normal(size=(300, 3))
    copies[::3] = copies[0]  # a third of the posts are copies of one vector
    big = rng.normal(size=(300, 5)) * 1e4 + 1e5
    return {"spread": spread, "clusters": clusters, "grid": grid, "copies": copies, "big": big}


@pytest.mark.parametrize("name", ["spread", "clusters", "grid", "copies", "big"])
def test_matches_brute_force(spark, name):
    values = cases()[name]
    rows = [(i, [float(v) for v in x]) for i, x in enumerate(values)]
    train, test = rows[:200], rows[200:]
    schema = "id bigint, features array<double>"
    found = neighbors.nearest(
        spark.createDataFrame(test, schema),
        spark.createDataFrame(train, schema).repartition(5),
        7,
        pivots=12,
        block_rows=9,
    )
    assert ranked(found) == brute(test, train, 7)


def visits(spark, values, n_train, k, cells):
    rows = [(i, [float(v) for v in x]) for i, x in enumerate(values)]
    schema = "id bigint, features array<double>"
    train = spark.createDataFrame(rows[:n_train], schema)
    test = spark.createDataFrame(rows[n_train:], schema)
    points = neighbors._distinct_points(train, k)
    guide = neighbors._scout(points, cells)
    boxes = neighbors._cell_boxes(neighbors._file_points(points, guide), guide)
    planned = neighbors._plan_visits(test, guide, boxes, k)
    return planned.select(F.sum(F.size("cells"))).first()[0], test, train


def test_pivots_save_visits(spark):
    visited, _, _ = visits(spark, cases()["clusters"], 200, 3, 12)
    assert visited < 100 * 12 / 2


def term_vectors(rows=1500, terms=200):
    """Few terms a post, frequent ones more often, lengths from short to very long."""
    rng = np.random.default_rng(11)
    share = 1 / np.arange(1, terms + 1)
    length = np.exp(rng.normal(3, 1.2, size=rows)).astype(int) + 1
    counts = np.array([rng.multinomial(n, share / share.sum()) for n in length])
    return counts * np.log(rows / (1 + (counts > 0).sum(0)))


def test_term_vectors_skip_cells(spark):
    """Wide vectors of posts: cells are left out, and the result is that of brute force."""
    values = term_vectors()
    visited, test, train = visits(spark, values, 1300, 5, 40)
    assert visited < 200 * 40 * 0.9
    rows = [(i, x) for i, x in enumerate(values.tolist())]
    got = ranked(neighbors.nearest(test, train, 5, pivots=40, block_rows=50))
    assert got == brute(rows[1300:], rows[:1300], 5)


def test_more_neighbours_than_scouts(spark, monkeypatch):
    monkeypatch.setattr(neighbors._scout, "__defaults__", (4,))
    values = cases()["spread"]
    rows = [(i, [float(v) for v in x]) for i, x in enumerate(values)]
    schema = "id bigint, features array<double>"
    train, test = spark.createDataFrame(rows[:200], schema), spark.createDataFrame(rows[200:], schema)
    for k in (3, 7):
        assert ranked(neighbors.nearest(test, train, k, pivots=4)) == brute(rows[200:], rows[:200], k)


def test_fewer_points_than_k(test, train):
    got = ranked(neighbors.nearest(test, train.where("id < 2"), 5))
    assert {i: len(v) for i, v in got.items()} == {10: 2, 11: 2, 12: 2}
    assert neighbors.nearest(test, train.where("id < 0"), 5).count() == 0


def test_split_ignores_partitions(spark):
    ids = spark.range(1000)
    one = neighbors.split_by_hash(ids.coalesce(1), "id").where("is_train").collect()
    many = neighbors.split_by_hash(ids.repartition(8), "id").where("is_train").collect()
    assert {r.id for r in one} == {r.id for r in many} and 500 < len(one) < 700
    parts = neighbors.split_at_random(ids)
    assert sum(p.count() for p in parts) == 1000
