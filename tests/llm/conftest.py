import pytest
from pyspark.sql import functions as F


@pytest.fixture
def table(spark, small):
    return lambda name: spark.read.parquet(f"{small}/{name}.parquet")


@pytest.fixture
def odd_documents(spark):
    """Nulls in every column, empty and blank texts, one very long text and one very long word, ties and repeated rows,
    and columns named like results."""
    words = " ".join(f"w{i % 977}" for i in range(60_000))
    rows = [
        (1, "the quick brown fox jumps over the lazy dog again and again", "en", "a", 1),
        (2, "the quick brown fox jumps over the lazy dog again and again", "en", "a", 1),
        (2, "the quick brown fox jumps over the lazy dog again and again", "en", "a", 1),
        (3, None, "en", "a", None), (4, "", None, None, 0), (5, " \t\n ", "de", "b", 3),
        (6, words, "en", "b", len(words)), (7, "x" * 300_000, "en", None, 300_000),
        (None, "a text without an id", "fr", "c", 20), (None, None, None, None, None),
        (8, "Ünïcödé wörds ändern nïchts — 你好 世界", "de", "c", 36), (9, "one", "en", "c", 3),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    clash = ["size", "taken", "target", "shard", "slot", "simhash", "n_words", "score", "label", "statistics", "times"]
    return df.withColumns({c: F.lit("mine") for c in clash})


@pytest.fixture
def no_documents(odd_documents):
    return odd_documents.where("false")
