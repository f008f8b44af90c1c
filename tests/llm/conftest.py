import pytest
from helpers import SENTENCE

DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"
@pytest.fixture
def make_docs(spark):
    """Documents from texts: (doc_id, text) or (doc_id, text, source)."""

    def make(*rows, extra: bool = False):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None if r[1] is None else len(r[1])) for r in rows]
        docs = spark.createDataFrame(full, DOCUMENT)
        return docs.selectExpr("*", "'x' AS key", "1 AS bucket", "2 AS size", "3 AS node") if extra else docs

    return make


@pytest.fixture
def awkward(make_docs):
    """Nulls, empty and wordless texts, repeated rows, ties, a very long text, and columns with clashing names."""
    long = " ".join(f"{'abcdefg'[i % 7]}{i % 991}" for i in range(60_000))
    rows = [
        (1, None), (2, ""), (3, " \n\t "), (4, SENTENCE), (5, SENTENCE), (5, SENTENCE), (None, SENTENCE), (None, None),
        (6, long), (7, "é日本\U0001f600 \n\n x"), (8, "a\x00b\x85c"), (-9, SENTENCE + " more", None), (10, "one"),
    ]
    return make_docs(*rows, extra=True)
