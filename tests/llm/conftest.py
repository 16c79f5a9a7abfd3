import pytest


@pytest.fixture(scope="session")
def documents(spark):
    """Documents with nulls, empty and very long texts, repeated rows and a clashing extra column."""

    def make(rows, extra=True):
        frame = spark.createDataFrame(
            [(i, t, "en", s, len(t or "")) for i, t, s in rows],
            "doc_id long, text string, lang string, source string, n_chars long",
        )
        return frame.selectExpr("*", "'x' AS row", "1 AS w", "2 AS found") if extra else frame

    return make


AWKWARD = [
    (1, None, "a"),
    (2, "", "a"),
    (3, "   \n\t ", None),
    (None, "no id here but some words", "b"),
    (4, "same text in the same row", "b"),
    (4, "same text in the same row", "b"),
    (5, "long word " * 30_000, "a"),
    (6, "x" * 200_000, "c"),
    (7, "ä\U0001f600 " * 50, "c"),
]


@pytest.fixture(scope="session")
def awkward():
    return list(AWKWARD)
