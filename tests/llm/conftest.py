import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from ``(doc_id, text[, lang, source])`` tuples."""

    def make(*rows):
        full = [(*r, None, None)[:4] for r in rows]
        return spark.createDataFrame([(*r, len(r[1] or "")) for r in full], DOCS)

    return make


@pytest.fixture(scope="session")
def documents(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet")


@pytest.fixture(scope="session")
def odd(docs_of):
    """NULLs everywhere, empty and very long texts, ties and repeated rows."""
    long = " ".join(f"word{i % 977}x{i % 31}" for i in range(60_000))
    return docs_of(
        (1, None, None, None), (2, "", "en", "s"), (3, "   \n\t ", "en", "s"), (4, "a", None, "s"), (5, long, "en", "s"),
        (6, long, "en", "t"), (7, "same text here and there again", "en", "s"), (7, "same text here and there again", "en", "s"),
        (None, "same text here and there again", "en", None), (None, None, None, None), (8, "12 34 !! ##", "fr", "s"),
        (9, "\x00 odd chars \U0001f600 é", "fr", ""),
    )
