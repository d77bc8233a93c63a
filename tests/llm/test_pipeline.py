"""Each stage against a plain version, on its own input; and the queries as registered."""

import random

import pytest
import public_tokenizers

import __spark_entry__ as contract
import corpus_pipeline
from posttags.llm import packing, quality, queries
from tests.llm.test_exact_dedup import LOWER
from tests.llm.test_minhash import brute as near_brute

PATH = str(public_tokenizers.path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rnd = random.Random(21)
    words = ["".join(rnd.choice("abcdelmnor") for _ in range(rnd.randint(2, 7))) for _ in range(300)]
    items = [(i, " ".join(rnd.choice(words) for _ in range(30))) for i in range(5)]
    docs, labels = [], []
    for i in range(240):
        text = [rnd.choice(words) for _ in range(60)]
        if i % 10 == 3:
            text[20:20] = items[i % 5][1].split()
        junk = i % 6 == 0
        text = " ".join(w.upper() + "!!" if junk else w for w in text)
        docs.append((len(docs), text))
        labels.append((docs[-1][0], int(not junk), 0))
        if i % 8 == 1:
            docs += [(len(docs), text), (len(docs) + 1, text.upper() if not junk else text)]
        if i % 9 == 2:
            parts = text.split()
            parts[7] = "changed"
            docs.append((len(docs), " ".join(parts)))
    docs += [(9000, None), (9001, ""), (None, "no id at all")]
    path = tmp_path_factory.mktemp("tables")
    more = "lang string, source string, n_chars bigint"
    rows = [(*d, "en", "s", len(d[1] or "")) for d in docs]
    spark.createDataFrame(rows, f"doc_id bigint, text string, {more}").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path), items, dict(d[:2] for d in docs)


def test_stages(spark, folder):
    path, items, texts = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    columns = docs.columns

    def after(stage, docs):
        kept = dict(corpus_pipeline.STAGES)[stage](spark, docs, path)
        assert kept.columns == columns
        kept = spark.createDataFrame(kept.collect(), docs.schema)
        return kept, {r.doc_id: r.text for r in kept.collect()}

    model = quality.fit(docs, spark.read.parquet(f"{path}/labels.parquet"), queries.remainder(3, 1))
    score = dict(zip(texts, model.score([t or "" for t in texts.values()])))
    docs, kept = after("quality", docs)
    assert kept.keys() == {i for i in texts if score[i] >= 0.5}
    assert not any("!!" in (t or "") for t in kept.values())

    groups = {}
    for i, t in kept.items():
        groups.setdefault((t or "").translate(LOWER), []).append(i)
    want = {max((i for i in g if i is not None), default=None) for g in groups.values()}
    docs, kept = after("exact dedup", docs)
    assert kept.keys() == want

    label = near_brute([(i, t) for i, t in kept.items() if i is not None])
    docs, now = after("near dedup", docs)
    assert now.keys() == {i for i in kept if i is None or label[i][2]}

    docs, kept = after("decontamination", docs)
    low = {i: (t or "").lower() for i, t in now.items()}
    assert kept.keys() == {i for i, t in low.items() if not any(item in t for _, item in items)}

    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, path).collect()
    assert {r.doc_id for r in pieces} == kept.keys()
    tokenizer = packing.WordIds.of(PATH).tokenizer
    for i, t in kept.items():
        tokens = len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1
        assert sum(r.length for r in pieces if r.doc_id == i) == tokens
    whole = corpus_pipeline.run(spark, path)
    assert whole.columns == packing.PIECE + ["sequence_id", "offset"] and whole.count() == len(pieces)


def test_rows_without_or_with_shared_ids_are_judged_one_by_one(spark, folder):
    """Null ids, a row given twice, one id with two texts, and a clashing column."""
    path, items, _ = folder
    one, two = (" ".join(f"{x}{i}" for i in range(30)) for x in "ab")
    near = one.replace("a0 ", "other ")
    leak = "before it " + items[2][1] + " after it"
    rows = [
        (None, one), (None, one), (None, leak), (7, two), (7, two), (8, one), (8, "a text of its own"),
        (9, near), (None, "another text without id"), (10, leak + " once more"),
    ]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id bigint, text string, row string")
    stages = dict(corpus_pipeline.STAGES)

    def texts(frame):
        assert frame.columns == docs.columns
        return sorted(((r.text, r.doc_id) for r in frame.collect()), key=repr)

    kept = texts(stages["exact dedup"](spark, docs, path))
    assert sorted(t for t, _ in kept) == sorted({t for _, t in rows})
    kept = texts(stages["near dedup"](spark, docs, path))
    assert len(kept) == len({t for _, t in rows}) - 1 - 1  # one of ``one`` and ``near``, one of the leaks
    assert ("a text of its own", 8) in kept and ("another text without id", None) in kept
    kept = texts(stages["decontamination"](spark, docs, path))
    assert sorted(t for t, _ in kept) == sorted(t for _, t in rows if items[2][1] not in t)


def test_every_operator_is_registered_once():
    names = list(contract.queries())
    for n in range(1, 14):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
    assert "pipeline" in names and len(corpus_pipeline.STAGES) == 5
