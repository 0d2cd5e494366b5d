import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, size long, row string"
WORDS = ["the", "of", "And", "über", "naïve", "x", "alpha", "beta", "gamma", "delta", "Epsilon", "zeta", "日本"]


def awkward_rows():
    """Nulls in every column, empty and long texts, ties, repeated rows, copies and near copies, hot sources."""
    r = random.Random(5)
    some = lambda n: " ".join(r.choice(WORDS) + str(r.randrange(40)) for _ in range(n))
    base, passage = some(120), some(60)
    texts = [None, "", " \t\n", "one", "a b c", "A\x0bB\x0cC d", base, base, base + " ", base.replace("alpha", "alpha "), None]
    texts += [base + f" tail{k}" for k in range(4)] + [some(40) + " " + passage + " " + some(30) for _ in range(5)]
    texts += [some(6000), "same line here\n" * 60, "word " * 90, "Hi### there$$$ " * 40, "SHOUT!! LOUD!! " * 40]
    texts += [some(r.randrange(5, 200)) for _ in range(25)]
    rows = [(k, t, "en", "big" if k % 3 else f"s{k % 5}", len(t) if t else None, True, 7, "r") for k, t in enumerate(texts)]
    rows += [rows[6], rows[30], rows[30], (None, base, None, None, None, None, None, None), (None, None, None, None, None, None, None, None)]
    rows += [(900, some(20), None, None, None, None, None, None)]
    return rows


@pytest.fixture(scope="session")
def rows():
    return awkward_rows()


@pytest.fixture(scope="session")
def schema():
    return SCHEMA


@pytest.fixture
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
