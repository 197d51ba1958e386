"""Small tables with the awkward cases: nulls, empty and long texts, ties, repeated rows, clashing names."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import types as T

DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # Names that operators use for columns of their own.
        T.StructField("id", T.StringType()),
        T.StructField("key", T.IntegerType()),
        T.StructField("row", T.StringType()),
    ]
)


def sentence(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choice("abcdeé") for _ in range(rng.randint(3, 7))) for _ in range(n))


def awkward_rows() -> list[tuple]:
    rng = random.Random(7)
    base = [sentence(rng, 60) for _ in range(6)]
    passage = "\n".join(sentence(rng, 70) for _ in range(3))
    texts = [
        *base,
        base[0],
        base[0].replace(base[0].split()[30], "changed", 1),
        base[1] + "\n" + passage,
        passage + "\n" + base[2],
        "\n".join([sentence(rng, 5)] * 9),
        None,
        "",
        " \n\t ",
        "one two",
        "one two",
        "!!! ### " * 40,
        "x" * 5000,
        sentence(rng, 30_000),
        "ünï " * 300,
    ]
    rows = [(k, t, rng.choice(["en", "de", None, "xx"]), rng.choice(["a", None]), len(t) if t else None) for k, t in enumerate(texts)]
    rows += [(None, base[3], "en", "a", 1), (None, None, None, None, None), rows[0], rows[11], (2, base[5], "en", "b", 3)]
    return [(*r, "x", 1, "y") for r in rows]


@pytest.fixture(scope="session")
def awkward(spark):
    return spark.createDataFrame(awkward_rows(), DOCUMENTS)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DOCUMENTS)


@pytest.fixture(scope="session")
def labels(spark):
    rows = [(0, 1, 0), (1, 1, 0), (16, 0, 1), (17, 0, 0), (None, 1, 1), (3, None, None), (0, 1, 0), (99, 0, 1)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")
