from __future__ import annotations

import pytest

LONG = "  ".join(f"word{n % 977} of\ta long text." for n in range(60_000))

#: Nulls, empty texts, a very long one, ties and repeated rows.
ODD = [
    (5, None, None, None),
    (6, "", "en", "a"),
    (7, " \t\n\x0b ", "en", None),
    (1, "one", None, "a"),
    (2, "one", "en", "a"),
    (2, "one", "en", "a"),
    (None, "a row without an id, which nobody can tell from another.", "en", "b"),
    (None, None, "en", "b"),
    (9, LONG, "en", "b"),
    (10, LONG, "de", "b"),
    (12, "The same id.\nAnd a text of its own, which is the first of two.", "de", "b"),
    (12, "The same id.\nAnd a text of its own, which is the second of two, not the first.", "de", "b"),
]
#: Names that operators use themselves.
CLASHING = ("n_words", "kept", "weight", "_text", "_key", "start", "spans", "score", "topic", "ids")


@pytest.fixture(scope="session")
def odd(spark):
    from pyspark.sql import functions as F

    rows = spark.createDataFrame(ODD, "doc_id long, text string, lang string, source string")
    rows = rows.withColumn("n_chars", F.length("text").cast("long"))
    return rows.withColumns({name: F.lit(f"my {name}") for name in CLASHING}).cache()


@pytest.fixture(scope="session")
def nothing(odd):
    return odd.limit(0)
