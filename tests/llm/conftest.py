import pytest
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def spark():
    s = SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    return s


DOCS = "doc_id long, text string, lang string, source string, n_chars long"
SF = "/root/testdata/sf0.001"
EDGE = [
    (1, None, None, None, None), (2, "", "en", "a", 0), (3, " \n\t ", "en", "a", 4), (4, "one", None, "a", 3), (5, "one", "fr", None, 3),
    (6, "Zazé ▁x   \U0001f600 <s> a\x00b\r\n" * 3, "fr", "b", 1), (7, "x" * 3000, "en", "b", 3000), (8, "the cat sat on the mat. " * 400, "en", "b", 9600), (9, "the cat sat on the mat. " * 400, "en", "c", 9600),
    (9, "the cat sat on the mat. " * 400, "en", "c", 9600), (10, "1234 5678", "en", "c", 9), (None, "null id text", "de", "c", 9),
]


@pytest.fixture(scope="session")
def edge(spark):
    """Nulls everywhere, empty and long texts, repeated rows, and an extra column with an internal name."""
    from pyspark.sql import functions as F

    return spark.createDataFrame(EDGE, DOCS).withColumns({"size": F.lit("clash"), "host": F.lit("clash"), "words": F.lit(1)})


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")
