"""Quality and toxicity: held-out accuracy, and odd rows."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from posttags.llm import quality, queries, toxicity
from tests.llm.conftest import as_dict, table

SF_DIR = "/root/testdata/sf0.01"


def held_out_rates(spark, frame, label):
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet").select("doc_id", label)
    rows = frame.where("held_out").join(labels, "doc_id").collect()
    hit = [r for r in rows if r[label] == 1]
    miss = [r for r in rows if r[label] == 0]
    return np.mean([r.predicted for r in hit]), np.mean([r.predicted for r in miss]), rows


def test_quality_on_held_out_labels(spark):
    frame = queries.op9_quality(spark, SF_DIR).cache()
    good, bad, rows = held_out_rates(spark, frame, "quality")
    assert good >= 0.97 and bad <= 0.1
    assert frame.count() == spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
    for r in frame.collect():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)


def test_toxicity_on_held_out_labels(spark):
    frame = queries.op10_toxicity(spark, "/root/testdata/sf0.1").cache()
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    rows = frame.where("held_out").join(labels, "doc_id").collect()
    hit = np.mean([r.predicted for r in rows if r.toxic == 1])
    miss = np.mean([r.predicted for r in rows if r.toxic == 0])
    assert hit >= 0.8 and miss <= 0.01  # some labels of this table are noise
    for r in rows:
        assert zlib.crc32(str(r.doc_id).encode()) % 4 == 2 and r.predicted == int(r.score >= 0.3)


def never():
    return F.lit(False)


def labelled(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], "doc_id bigint, quality int, toxic int, text string")


@pytest.fixture(scope="module")
def texts():
    rnd = random.Random(11)
    words = ["".join(rnd.choice("abcdelmnor") for _ in range(rnd.randint(2, 7))) for _ in range(200)]
    rows, labels = [], []
    for i in range(240):
        plain = [rnd.choice(words) for _ in range(40)]
        junk, rude = i % 4 == 0, i % 5 == 0
        if rude:
            for _ in range(2):
                plain.insert(rnd.randrange(40), rnd.choice(["zorgul", "zorgan", "idiot", "worthless,"]))
        rows.append((i, " ".join(w.upper() + "!!" if junk else w for w in plain)))
        labels.append((i, int(not junk), int(rude)))
    return rows, labels


ODD = [(900, None), (901, ""), (None, "some words"), (902, "one"), (902, "one"), (903, "long words here " * 40_000)]


def test_quality_separates_and_takes_odd_rows(spark, texts):
    rows, labels = texts
    docs = table(spark, [*rows, *ODD])
    held = F.col("doc_id") % 3 == 1
    got = quality.classify(docs, labelled(spark, [*labels, (5, None, 1), (6, 7, 0), (None, 1, 1)]), held).collect()
    assert len(got) == len(rows) + len(ODD) and all(0 <= r.score <= 1 for r in got)
    truth = {i: q for i, q, _ in labels}
    assert np.mean([r.predicted == truth[r.doc_id] for r in got if r.doc_id in truth]) > 0.97
    assert len({r.score for r in got if r.doc_id in (900, 901)}) == 1


def test_quality_scores_equal_plain_voting(spark, texts):
    rows, labels = texts
    docs = table(spark, rows)
    model = quality.fit(docs, labelled(spark, labels), never())
    got = as_dict(quality.scored(docs, model))
    for doc_id, text in rows[::7]:
        vector = model.project([text])[0].astype(float)
        similar = model.vectors.astype(float) @ vector
        near = np.argsort(-similar)[: quality.NEIGHBOURS]
        weight = np.maximum(similar[near], 0) ** 2
        assert got[doc_id].score == pytest.approx((weight * model.labels[near]).sum() / weight.sum(), abs=0.02)


def test_quality_keeps_columns(spark, texts):
    rows, labels = texts
    docs = table(spark, [*rows, (999, None)])
    kept = quality.keep_good(docs, quality.fit(docs, labelled(spark, labels), never()))
    assert kept.columns == docs.columns
    truth = {i for i, q, _ in labels if q == 0}
    assert not truth & {r.doc_id for r in kept.collect()}


def test_toxicity_finds_mined_and_fixed_words(spark, texts):
    rows, labels = texts
    docs = table(spark, [*rows, *ODD, (950, "hello you moron of a zorgolo"), (951, "a b c d")])
    held = F.col("doc_id") % 4 == 2
    got = toxicity.classify(docs, labelled(spark, labels), held).collect()
    assert len(got) == len(rows) + len(ODD) + 2
    truth = {i: t for i, _, t in labels}
    assert np.mean([r.predicted == truth[r.doc_id] for r in got if r.doc_id in truth]) > 0.97
    assert {r.predicted for r in got if r.doc_id == 951 or r.doc_id in (900, 901, 902)} == {0}


@pytest.mark.parametrize("operator", [quality.classify, toxicity.classify])
def test_without_labels_or_rows(spark, operator):
    none = labelled(spark, [])
    got = operator(table(spark, [(1, "a word"), (2, None)]), none, never()).collect()
    assert len(got) == 2 and all(0 <= r.score <= 1 for r in got)
    assert operator(table(spark, []), none, never()).collect() == []


def test_label_model_recovers_rates(spark):
    rnd = np.random.default_rng(3)
    truth = rnd.random(20_000) < 0.1
    rates = [(0.0, 0.0)] * 4 + [(0.005, 0.5), (0.01, 0.3), (0.002, 0.4)]
    votes = np.zeros(20_000, np.int64)
    for at, (clean, toxic) in enumerate(rates):
        votes |= (rnd.random(20_000) < np.where(truth, toxic, clean)).astype(np.int64) << at
    votes |= (votes == 0).astype(np.int64) << toxicity.NONE
    frame = spark.createDataFrame([(int(v),) for v in votes], "votes bigint").groupBy("votes").agg(F.count("*").alias("n"))
    model = toxicity.fit_label_model(frame, len(rates), 0.1)
    for at in (4, 5, 6):
        assert model.fires[0, at] < 0.03 and model.fires[1, at] > 0.15
    posterior = model.posterior(votes)
    assert posterior[truth & (votes != 1)].mean() > 0.6 and posterior[~truth].mean() < 0.1


def test_all_mined_and_fixed_words_vote(spark):
    """Seventy words are mined; the last fixed word still turns a text."""
    rnd = random.Random(5)
    words = ["".join(rnd.choice("abcdelmnor") for _ in range(rnd.randint(2, 7))) for _ in range(200)]
    marks = [x + y + "zzz" for x in "abcdefg" for y in "qwtyuipsfj"]
    rows, labels = [], []
    for i in range(3000):
        text, rude = [rnd.choice(words) for _ in range(30)], i % 3 == 0
        if rude:
            text[::10] = rnd.sample(marks, 3)
        elif i % 50 == 1:
            text[::10] = ["inútil", "wertlos", "ordure"]
        rows.append((i, " ".join(text)))
        labels.append((i, 1, int(rude)))
    unlabelled = {i for i in range(3000) if i % 50 == 1 and i % 3}
    marked = labelled(spark, [x for x in labels if x[0] not in unlabelled])
    docs = table(spark, rows)
    mined, _ = toxicity.mine(toxicity.labelled_sample(docs, marked, "toxic", never(), toxicity.SAMPLE))
    assert {m.rstrip("*")[:3] for m in mined} >= {m[:3] for m in marks}
    got = as_dict(toxicity.classify(docs, marked, never()))
    assert np.mean([got[i].predicted for i in unlabelled]) > 0.9
    assert np.mean([got[i].predicted for i, _, t in labels if t]) > 0.97
    assert np.mean([got[i].predicted for i, _, t in labels if not t and i not in unlabelled]) < 0.03
