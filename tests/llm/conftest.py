import pytest

#: Names that operators use inside; none of them may clash with a column of the input.
CLASHING = ["doc", "fp", "w", "size", "key", "k1", "spans", "kept", "root", "part", "host", "page", "text_key", "rank"]


@pytest.fixture(scope="session")
def documents(spark):
    """A documents frame of (doc_id, text, source) rows, with columns of clashing names."""

    def make(rows):
        kept = [(i, t, "en", s, None if t is None else len(t), *CLASHING) for i, t, s in rows]
        more = ", ".join(f"{c} string" for c in CLASHING)
        return spark.createDataFrame(kept, f"doc_id long, text string, lang string, source string, n_chars long, {more}")

    return make


@pytest.fixture(scope="session")
def odd(documents):
    """Nulls, empty and long texts, ties and repeated rows."""
    long_text = " ".join(f"word{i % 7919} of{i % 13}" for i in range(30_000))
    rows = [
        (1, None, "a"), (2, "", "a"), (3, " \n\t ", None), (4, "one", "b"), (4, "one", "b"), (None, "no id here", "b"),
        (None, None, None), (5, "Same Words stand here", "c"), (6, "same words stand here", "c"), (7, long_text, "c"),
        (7, long_text, "c"), (8, "x" * 3000, "d"), (9, "naïve ÉTÉ \U0001f600 " * 60, "d"),
    ]
    return documents(rows)


@pytest.fixture(scope="session")
def empty(documents):
    return documents([])


@pytest.fixture(scope="session")
def sample(spark):
    """The documents of the smallest tables."""
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
