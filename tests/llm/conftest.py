import pytest

from strata.llm.queries import table

SF = "/root/testdata/sf0.001"
LABELS = "doc_id long, quality int, toxic int"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def sf_dir():
    return SF


@pytest.fixture(scope="session")
def documents(spark):
    return table(spark, SF, "documents").select("doc_id", "text").collect()


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls, empty and long texts, repeated rows, and columns named like results."""
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron".split()
    long_text = " ".join(words[i * i % 15] + str(i % 97) for i in range(60_000))
    rows = [
        (1, "one two three four five six", "en", "a", 1, 0.5, "x"),
        (1, "one two three four five six", "en", "a", 1, 0.5, "x"),
        (2, None, None, None, None, None, None),
        (3, "", "en", "a", 0, None, None),
        (4, " \n\t ", "en", None, 4, None, None),
        (None, "one two three four five six", "en", "a", 1, None, None),
        (None, None, None, None, None, None, None),
        (5, long_text, "en", "b", len(long_text), 1.0, "y"),
        (6, "ONE two  three\tfour five SIX", "en", "b", 1, 1.0, "z"),
        (7, "x" * 200_000, "en", "b", 200_000, 1.0, "z"),
        (8, "one", "en", "b", 3, None, None),
        (9, "naïve 日本語 😀 text\x00 with ﬁ signs", "ja", "b", 3, None, None),
    ]
    schema = "doc_id long, text string, lang string, source string, n_chars long, score double, features string"
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="session")
def no_documents(spark):
    return spark.createDataFrame([], DOCS)
