"""Documents with odd rows, as fixtures for the tests of this folder."""

import pytest

ROWS = [
    (1, "The quick brown fox jumps over the lazy dog and runs far away from the old red barn", "en", "a", 10),
    (2, "The quick brown fox jumps over the lazy dog and runs far away from the old red barn", "en", "a", 10),
    (3, "the QUICK brown fox jumps over the lazy dog and runs far away from the old red barn today", "en", "b", 10),
    (4, None, "en", "b", 0),
    (5, "", None, None, 0),
    (6, "  \t\n ", "en", None, 0),
    (7, "12345 !!! ???", "fr", "c", 3),
    (8, "un deux", "fr", "c", 3),
    (9, "Üñï cödé wörds ärè ñöt ässçïï bût wörds ñönetheless thé ènd", "de", "d", 3),
    (None, "a row without an id has a text of its own", "en", "d", 3),
    (10, "word " * 50_000 + "end", "en", "e", 9),
    (11, "word " * 50_000 + "end", "en", "e", 9),
    (12, "un deux", "fr", "c", 3),
    (12, "un deux", "fr", "c", 3),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and very long texts, ties, repeated rows."""
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def clashing_docs(spark, odd_docs):
    """Extra columns with names that operators use for themselves."""
    from pyspark.sql import functions as F
    names = ("id", "size", "row", "found", "slot", "shard", "hash", "target", "kept", "spans", "n_words", "score",
             "component", "taken", "text_key", "host", "cell")
    return odd_docs.withColumns({n: F.lit("x") for n in names})
