from __future__ import annotations

import random

import pytest


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    from tripkit.llm.ship import ship

    ship(spark)


def sentence(rng, n, vocabulary=40):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


@pytest.fixture(scope="session")
def edge_rows():
    """(id, text): nulls, empty and blank texts, one word, a long text, copies, equal rows, null ids."""
    rng = random.Random(5)
    base, other = sentence(rng, 60, 5000), sentence(rng, 80, 5000)
    rows = [
        (1, None), (2, ""), (3, " \t\n\r "), (4, "one"), (5, base), (6, base), (7, base + " tail"), (8, "head " + base + "\x0b" + other),
        (9, other.upper()), (10, sentence(rng, 20_000, 3)), (11, sentence(rng, 30_000, 100_000)), (11, "again the same id"),
        (12, "é ß 日本   x"), (12, "é ß 日本   x"), (None, base), (None, None), (None, "only a null id " + other), (13, "a" * 5000),
        (14, "same same " * 200),
    ]
    return rows


@pytest.fixture(scope="session")
def edge_docs(spark, edge_rows):
    """The edge rows with other columns whose names operators use themselves."""
    schema = "doc_id bigint, text string, _text string, _id int, _key_a string, fp string, bucket int, score double, `a b` string"
    return spark.createDataFrame([(i, t, "x", 1, None, "f", 2, 0.5, "c") for i, t in edge_rows], schema).repartition(3)


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.limit(0)
