import random

import pytest

# Columns that carry the names operators use inside, to show that none is looked at.
CLASHING = "digest string, bucket string, key string, doc string, score string, kept string, row string"


def table(spark, rows, more=True):
    """``doc_id, text`` rows, with further columns of clashing names."""
    schema = "doc_id bigint, text string" + (", " + CLASHING if more else "")
    return spark.createDataFrame([(*r, *(["x"] * 7 if more else [])) for r in rows], schema)


def as_dict(frame, key="doc_id"):
    return {row[key]: row for row in frame.collect()}


@pytest.fixture(scope="session")
def prose():
    """Documents of invented words: copies, near copies, shared lines, odd and long texts."""
    rnd = random.Random(3)
    words = ["".join(rnd.choice("abcdeimnorst") for _ in range(rnd.randint(2, 7))) for _ in range(400)]

    def text(n):
        return " ".join(rnd.choice(words) for _ in range(n))

    line = "one line that stands at the head of very many of these documents, always."
    rows = []
    for i in range(60):
        base = text(rnd.randint(0, 120))
        rows.append(base)
        if i % 3 == 0:
            parts = base.split(" ")
            for _ in range(rnd.randint(1, 4)):
                copy = list(parts)
                for _ in range(rnd.randint(0, 3)):
                    copy[rnd.randrange(len(copy))] = rnd.choice(words)
                rows.append(" ".join(copy))
        if i % 4 == 0:
            rows.append(line + "\n" + text(40))
        if i % 10 == 0:
            rows += [base, base.upper()]
    rows += ["", " \n\t ", "a b", "A B", "é" * 70, "é" * 70 + "x", "Ünï cödé text " * 9, text(9000), "z" * 3000]
    ids = rnd.sample(range(10_000), len(rows))
    return list(zip(ids, rows))


@pytest.fixture(scope="session")
def messy(prose):
    """``prose`` with nulls and a row given twice."""
    return [*prose, (20_000, None), (None, "no id here"), (None, None), (20_001, prose[0][1]), (20_001, prose[0][1])]
