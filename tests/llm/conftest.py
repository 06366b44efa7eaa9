import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def docs_of(spark):
    """documents from (doc_id, text) pairs."""
    def make(rows):
        return spark.createDataFrame(
            [(i, t, "en", "src0", None if t is None else len(t)) for i, t in rows], DOCS)
    return make


@pytest.fixture(scope="session")
def trap_docs(docs_of):
    """Nulls, empty and very long texts, ties and repeated rows."""
    long = "lorem ipsum dolor sit amet " * 8000
    return docs_of([(1, "a b c"), (2, None), (3, ""), (4, "a b c"), (5, long), (6, long), (None, "null id"),
                    (7, " \t\n"), (8, "Ünïcödé Σίσυφος 中文 😀 İ"), (9, "x" * 5000), (9, "x" * 5000),
                    (10, "it's <|endoftext|> we'LL <|startoftext|>")])
