import pytest

DOC = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(autouse=True)
def workers(spark):
    from framewatch.llm.common import use_package
    use_package(spark)


@pytest.fixture
def make_docs(spark):
    def make(texts, **columns):
        rows = [(i, t, "en", f"s{i % 3}", len(t) if t is not None else None) for i, t in enumerate(texts)]
        return spark.createDataFrame(rows, DOC)
    return make


@pytest.fixture
def edge_docs(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows."""
    long = " ".join(f"w{i % 977}x{i % 31}" for i in range(30_000))
    plain = "the river runs past the old mill and the road turns north " * 8
    rows = [(1, None, None, None, None), (2, "", "en", "a", 0), (3, "  \n\t ", "en", "a", 5), (4, long, "en", "a", len(long)),
            (5, plain, "en", None, len(plain)), (6, plain, "de", "b", len(plain)), (6, plain, "de", "b", len(plain)),
            (None, plain, "de", "b", len(plain)), (None, "x", None, "b", 1), (7, "one two", "en", "b", 7),
            (8, "ß▁ \x00 \U0001F600 café", "fr", "c", 12), (9, "one two", "en", "b", 7)]
    return spark.createDataFrame(rows, DOC)
