import pytest

DDL = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"word{i % 977}x" for i in range(30_000))


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty, blank and very long texts, repeated rows, ties."""
    plain = "The quick brown fox jumps over the lazy dog near the river bank today."
    rows = [(1, plain, "en", "a", 70), (2, plain, "en", "a", 70), (3, None, None, None, None), (4, "", "en", "b", 0),
            (5, " \n\t ", "en", "b", 4), (6, LONG, "en", "b", len(LONG)), (7, "é ü. 字 🙂", "fr", "c", 9),
            (8, "one", "en", "c", 3), (8, "one", "en", "c", 3), (None, plain + " More.", "en", None, 76),
            (9, "a  b\n\nc\r\nd", "en", "a", 10)]
    return spark.createDataFrame(rows, DDL)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DDL)


@pytest.fixture(scope="session")
def tokenizer():
    public = pytest.importorskip("public_tokenizers")
    return public.path("byte_bpe_50k.json")


@pytest.fixture(scope="session")
def real_docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
