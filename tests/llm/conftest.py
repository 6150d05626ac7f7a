import pyarrow.parquet as pq
import pytest

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def corpus():
    """Texts of the smallest documents table by id."""
    rows = pq.read_table(f"{SF_DIR}/documents.parquet").to_pylist()
    return {row["doc_id"]: row["text"] for row in rows}


@pytest.fixture
def odd_docs(spark):
    """Nulls, empty texts, repeated rows, a long text and columns with clashing names."""
    rows = [
        (1, "one two three four five six seven eight", "en", 0, "c0"),
        (1, "one two three four five six seven eight", "en", 0, "c0"),
        (2, None, None, 1, "n"),
        (3, "", "en", 2, "tail"),
        (4, " \n\t ", "xx", 3, "part"),
        (None, "ünï <|endoftext|> ﬁ 中文 \x00 🙂  two  spaces ", None, 4, None),
        (5, "la la la " * 20000 + "password = abcdef123", "fr", 5, "row"),
        (6, "x", "en", 6, "ids"),
    ]
    return spark.createDataFrame(rows, "doc_id BIGINT, text STRING, lang STRING, c1 INT, class STRING")
