import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, label string"


@pytest.fixture(scope="session")
def docs(spark):
    """Plain, near and exact copies, nulls in any column, empty and long texts, repeated rows, a column named label."""
    rng = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    base = [" ".join(rng.choices(words, k=rng.randint(3, 160))) for _ in range(40)]
    rows = [(i, t, "en", f"s{i % 4}", len(t), "x") for i, t in enumerate(base)]
    for k in range(40, 70):  # near copies
        part = rng.choice(base).split()
        part[rng.randrange(len(part))] = "changed"
        rows.append((k, " ".join(part), None, "s1", 1, None))
    rows += [(k, base[0].upper(), "en", None, None, "y") for k in range(70, 80)]
    rows += [(80, None, "en", "s0", None, None), (81, "", None, None, 0, None), (82, " \t\n ", "en", "s2", 4, "z"), (83, "one", "en", "s3", 3, ""), (84, "one", "en", "s3", 3, "")]
    rows += [(85, " ".join(rng.choices(words, k=9000)), "en", "s0", 1, "long"), (None, "no name here", "en", "s1", 1, "n"), rows[3], rows[3]]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
