import random

import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def small(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


@pytest.fixture(scope="module")
def odd_rows():
    """(doc_id, text): nulls, empty and white texts, ties, repeated rows, a very long text."""
    chance = random.Random(4)
    words = [f"w{chance.randrange(5000)}" for _ in range(30_000)]
    long = " ".join(words)
    plain = " ".join(words[:80])
    return [
        (1, plain),
        (2, plain),
        (2, plain),
        (3, plain.replace(" ", "\t\n")),
        (4, None),
        (5, ""),
        (6, " \n\t "),
        (None, plain),
        (None, None),
        (7, long),
        (8, long + " end"),
        (9, "one two"),
        (10, "one  two"),
        (11, "Ünï 漢字   x\x1cy"),
    ]


@pytest.fixture(scope="module")
def odd(spark, odd_rows):
    """The same with further columns named as the operators name theirs."""
    df = spark.createDataFrame(odd_rows, "doc_id long, text string")
    names = ["row", "tokens", "rate", "copies", "row_hash", "place", "node", "score", "kept", "begin", "set_id"]
    return df.withColumns({x: F.lit(None).cast("string") for x in names})


@pytest.fixture(scope="module")
def no_rows(odd):
    return odd.limit(0)


def words(chance: random.Random, n: int, kinds: int = 10**6) -> list[str]:
    return [f"w{chance.randrange(kinds)}" for _ in range(n)]
