import random

import pytest
from pyspark.sql import types as T

#: Extra columns stand in every frame of the tests; their names clash with those used inside.
CLASHING = ["key", "sid", "n", "component", "row", "__row", "part", "value"]
SCHEMA = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())]
    + [T.StructField(c, T.StringType()) for c in CLASHING]
)
WORDS = ["the", "of", "river", "stone", "Über", "garçon", "and", "window", "light", "señal", "under", "paper"]


def prose(seed: int, n: int) -> str:
    chance = random.Random(seed)
    return " ".join(chance.choice(WORDS) + str(chance.randrange(40)) for _ in range(n))


@pytest.fixture(scope="session")
def documents(spark):
    """A frame from (doc_id, text) or (doc_id, text, lang) rows."""

    def make(rows):
        full = []
        for row in rows:
            doc_id, text, lang = (*row, None)[:3]
            full.append((doc_id, text, lang, None, None if text is None else len(text), *["x"] * len(CLASHING)))
        return spark.createDataFrame(full, SCHEMA)

    return make


@pytest.fixture(scope="session")
def edge_rows():
    """Null and empty texts, white space, a very long text, ties, repeated rows, a null id."""
    long = prose(1, 30_000)
    return [
        (1, None), (2, ""), (3, " \t\n"), (4, "word"), (5, long), (6, prose(2, 120)), (7, prose(2, 120)), (7, prose(2, 120)),
        (None, prose(3, 80)), (None, prose(3, 80)), (8, "a" * 5_000), (9, "日本語のテキスト " * 30), (10, "line\nline\nline\n" * 30), (11, "\x00 \U0001f600 é"),
    ]
