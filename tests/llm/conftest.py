import pytest


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with nulls anywhere, empty and very long texts, repeated ids and rows, clashing names."""
    rows = [
        (1, "the quick brown fox jumps over the lazy dog and runs away", "en", "a", 5),
        (1, "the quick brown fox jumps over the lazy dog and runs away", "en", "a", 5),
        (1, "another text with the same id", "en", None, None),
        (2, None, None, "b", None),
        (3, "", "en", "b", 0),
        (4, " \n\t ", None, "b", 0),
        (5, "word " * 40_000, "en", "c", 1),
        (None, "a text without an id, which is not much of a text", "en", "a", 1),
        (6, "ñandú çà été 😀 Ωμέγα 漢字", "es", "c", 1),
        (7, "line one is here\nline two is here\nline three", "en", "", 1),
    ]
    kind = "doc_id long, text string, lang string, source string, n_chars long"
    df = spark.createDataFrame(rows, kind)
    for name in ("hash", "k", "score", "size", "fp", "part", "removed", "chunk", "pii", "n_lines", "component_id", "key", "label"):
        from pyspark.sql import functions as F

        df = df.withColumn(name, F.lit(name))
    return df


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)
