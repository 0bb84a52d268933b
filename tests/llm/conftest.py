import pyarrow.parquet as pq
import pytest

SF = "/root/testdata/sf0.001"
MESSY = "doc_id long, text string, lang string, source string, n_chars long, score string, ids string, n_values string, fp string, row string, `Key` string"


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def documents():
    return pq.read_table(f"{SF}/documents.parquet").to_pylist()


@pytest.fixture(scope="session")
def messy(spark):
    """Null ids and texts, empty, white, short and very long texts, repeated rows, equal ids, odd characters, clashing column names."""
    long_text = " ".join(f"w{i % 977} tail{i}" for i in range(60_000))
    texts = [
        (1, "one two three four five six seven eight nine ten"), (1, "one two three four five six seven eight nine ten"),
        (2, None), (3, ""), (None, "no id here, but words"), (None, None), (4, " \t\n "), (5, "x"), (6, long_text), (7, long_text),
        (1, "the same id, another text"), (8, "naïve 日本語 😀   \x00 nul\x85 A'B"), (9, "MIT License"), (-3, "negative id"),
    ]
    return spark.createDataFrame([(i, t, None, None, None, *["c"] * 6) for i, t in texts], MESSY)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], MESSY)
