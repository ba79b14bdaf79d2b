import random

import pytest
from pyspark.sql import functions as F

WORDS = "the of and quick brown fox jumps over lazy dog while seven tall ships sail past an old stone tower".split()
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "er", "ing"]) for _ in range(n))


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in every column, empty, blank and very long texts, ties, repeated rows."""
    long = prose(1, 30_000)
    rows = [(1, None, "en", "a", 0), (2, "", "en", "a", 0), (3, " \n\t ", None, None, None), (4, "One two three.", "fr", "b", 14),
            (5, "ONE TWO THREE.", "fr", "b", 14), (5, "One two three.", "fr", "b", 14), (5, "One two three.", "fr", "b", 14),
            (None, "no id here at all", "de", "b", 9), (None, "no id here at all", "de", "b", 9), (6, long, "en", "a", None),
            (7, long + " end", "en", "c", 1), (8, "x" * 200_000, "en", "c", 1), (9, "á ▁ ▁ 🙂 \x00 ß", "xx", "c", 1)]
    return rows + [(100 + k, prose(k, 80), ("en", "fr")[k % 2], "abc"[k % 3], 5) for k in range(20)]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return spark.createDataFrame(odd_rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def labels(spark):
    rows = [(100 + k, k % 4 and 1, 0) for k in range(20)] + [(None, 1, 0), (1, None, None), (100, 1, 0), (6, 7, 0)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def crowded(odd):
    """The same rows with further columns that clash with names the operators use inside."""
    names = ["run", "sha", "best", "n", "kept", "node", "root", "size", "h", "slice", "start", "c", "stratum", "spans", "ids",
             "score", "key", "url", "target", "place", "nth", "_row", "_id", "_text", "place_no", "rules", "group", "x", "y",
             "fp", "anchor", "at", "other", "salt", "first", "output", "form", "item_id", "terms", "term", "rank", "block"]
    return odd.select("*", *[F.lit(k).alias(n) for k, n in enumerate(names)])
