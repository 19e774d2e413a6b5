import pytest
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def spark():
    session = SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "4g").config("spark.sql.shuffle.partitions", "2").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, _row string"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls everywhere, ties, repeated rows, empty and long texts, and columns with clashing names."""
    long = " ".join(f"w{i % 997} v{i}" for i in range(12_000))
    rows = [(1, "same text here", "en", "a", 1, "x", "y"), (2, "same text here", "en", "a", 1, None, None), (2, "same text here", "en", "a", 1, None, None), (3, None, None, None, None, None, None), (4, "", "en", None, 0, "", ""),
            (5, " \n\t ", None, "b", 3, "k", "r"), (6, long, "en", "b", 9, "k", "r"), (7, long + " more", "fr", "b", 9, "k", "r"), (None, "no id", "en", "a", 5, "k", "r"), (8, "été à Ål ▁ <|endoftext|> 日本", "fr", "c", 5, "k", "r"),
            (9, "one two three four five six seven eight nine ten eleven twelve", "en", "a", 5, "k", "r")]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
