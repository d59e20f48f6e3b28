import pytest

from skyledger.llm.shipping import ship

FOLDER = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship(spark)


@pytest.fixture(scope="session")
def table(spark):
    """A table of the smallest generated set."""
    return lambda name: spark.read.parquet(f"{FOLDER}/{name}.parquet")


@pytest.fixture(scope="session")
def awkward(spark):
    """Documents with nulls in every column, empty and very long texts, repeated rows, and columns that clash with results."""
    long_text = "word and more words of some length, " * 30_000
    rows = [
        (1, "a plain text of some words that is not long", "en", "s1", 43),
        (2, None, None, None, None),
        (3, "", "", "", 0),
        (4, " \t\n ", "de", "s2", 4),
        (5, long_text, "en", "s1", len(long_text)),
        (5, long_text, "en", "s1", len(long_text)),
        (6, "x" * 200_000 + " 1" * 50_000, "fr", None, None),
        (None, "a text without an id that has more than five words", "en", "s3", None),
        (None, None, None, None, None),
        (7, "a plain text of some words that is not long", "en", "s1", 43),
    ]
    clash = ", score double, kept string, size string, shard string, text_crc32 string, words array<string>, held_out int, component_id string, node int, h int"
    more = (0.5, "k", "s", "t", "c", ["w"], 9, "c", 1, 2)
    return spark.createDataFrame([(*r, *more) for r in rows], DOCS + clash)
