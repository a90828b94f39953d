import random

import pytest

WORDS = "amber birch cedar delta ember flint grove haven iris jade kelp lunar maple north ochre pearl quartz river slate tundra".split()


@pytest.fixture
def prose():
    """A seeded writer of texts of a given number of words."""
    rng = random.Random(7)
    return lambda n: " ".join(rng.choice(WORDS) + rng.choice(["", "", "s", "ly", "ing"]) for _ in range(n))


SCHEMA = "doc_id long, text string, source string, size string, shard string, slot string, visits int, __row int, id int, hash int, w int, name string, n int, taken int"


@pytest.fixture
def awkward(spark, prose):
    """Nulls in any column, empty and blank texts, ties, repeated rows, a very long text, and columns of clashing names."""
    long = prose(60_000)
    texts = [
        (1, "one two three four five six seven"),
        (2, "one two three four five six seven"),
        (3, None),
        (4, ""),
        (5, " \t\n "),
        (6, "tiny"),
        (7, "Tiny"),
        (8, long),
        (9, long + " tail"),
        (None, "no key at all in this row of words"),
        (11, "ß é 😀 naïve ünïcode " * 3),
        (12, prose(40)),
        (12, prose(41)),
        (13, prose(30)),
    ]
    rows = [(i, t, "ab"[k % 2] if k % 5 else None, "x", None, "y", k, k, k, k, k, None, k, k) for k, (i, t) in enumerate(texts)]
    rows += [rows[0], rows[-1], rows[-1]]
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
