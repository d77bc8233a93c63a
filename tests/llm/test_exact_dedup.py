import hashlib
import string

import pytest

from posttags.llm import common, exact_dedup
from tests.llm.conftest import table

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def brute(rows):
    groups = {}
    for doc_id, text in rows:
        groups.setdefault((text or "").translate(LOWER), []).append(doc_id)
    out = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = max(known) if known else None
        digest = hashlib.sha256(text.encode()).hexdigest()
        out += [(i, keep, len(ids), i == keep, digest) for i in ids]
    return sorted(out, key=repr)


def test_equals_brute_force(spark, messy):
    got = exact_dedup.deduplicate_once(table(spark, messy), 4)
    assert sorted(map(tuple, got.collect()), key=repr) == brute(messy)


def test_later_batches_meet_the_index(spark, tmp_path):
    first = exact_dedup.DigestIndex(spark, f"file://{tmp_path}/index", 4)
    exact_dedup.deduplicate(table(spark, [(1, "a"), (2, "A"), (3, "b")]), first)
    again = exact_dedup.DigestIndex(spark, f"file://{tmp_path}/index", 4)
    got = exact_dedup.deduplicate(table(spark, [(9, "B"), (8, "c"), (7, "c")]), again)
    seen = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in got.collect()}
    assert seen == {9: (3, 1, False), 8: (8, 2, True), 7: (8, 2, False)}
    assert again.rows().count() == 3
    plan = table(spark, [(1, "a")]).transform(exact_dedup.digests)
    plan = plan.join(again.rows().hint("merge"), "digest", "left_anti")
    assert plan._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1


def test_empty_table(spark):
    assert exact_dedup.deduplicate_once(table(spark, []), 4).collect() == []


@pytest.mark.parametrize("share", [1, 3, 1000])
def test_hot_keys_join_like_others(spark, share):
    rows = spark.createDataFrame([(i % 7 if i % 3 else 0, i) for i in range(90)], "k int, i int")
    sizes = rows.groupBy("k").count().withColumnRenamed("count", "n")
    got = common.join_hot(rows, sizes, "k", "n", 90, share).collect()
    assert sorted(got) == sorted(rows.join(sizes, "k").collect())
