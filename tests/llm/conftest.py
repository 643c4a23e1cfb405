import random

import pytest
from pyspark.sql import functions as F


def words(seed: int, n: int, size: int = 400) -> str:
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(size)}" for _ in range(n))


#: Null and blank texts, a text of over a megabyte with white space of several kinds, copies, a near copy, repeated rows, repeated ids, a null id.
LONG = words(1, 260_000).replace(" w7 ", " \u00a0 w7\u2003 ").replace(" w8 ", "\n\u00a0w8\u3000\n ")
BASE = words(2, 200)
NEAR = BASE.replace(BASE.split()[100], "changed", 1)
ROWS = [
    (1, None), (2, ""), (3, " \n\t "), (4, "one two"), (5, BASE), (6, BASE), (7, NEAR), (8, LONG), (9, "Ünï çödé 日本 😀 <|endoftext|> x"),
    (10, "same row twice " * 5), (10, "same row twice " * 5), (11, "first text of the id eleven"), (11, "second text of the id eleven"), (None, "a text without an id"),
]


@pytest.fixture(scope="session")
def odd(spark):
    """The rows above with columns whose names the operators use themselves."""
    df = spark.createDataFrame(ROWS, "doc_id long, text string")
    clashing = ["row", "node", "score", "n", "print", "sign", "key", "held_out", "start", "part"]
    return df.withColumns({c: F.lit("theirs") for c in clashing}).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], "doc_id long, text string")
