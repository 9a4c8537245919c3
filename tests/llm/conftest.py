import sys
from pathlib import Path

import pytest

ROOT = str(Path(__file__).resolve().parents[2])
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "the cat sat on the mat. " * 4000


@pytest.fixture(scope="session")
def odd(spark):
    """NULLs in every column, empty and very long texts, ties, repeated rows, clashing names."""
    rows = [(1, "a b c d e f g h i j", "en", "s", 1), (1, "a b c d e f g h i j", "en", "s", 1),
            (2, "a b c d e f g h i j", None, None, None), (None, "a b c", "de", "s", 3),
            (None, None, None, None, None), (3, None, "en", "s", 0), (4, "", "fr", "s", 0),
            (5, " \n\t ", "xx", "s", 0), (6, LONG, "en", "s", 9), (7, LONG + "x", "en", "s", 9),
            (8, "é\0� <|endoftext|> mail me@x.example.org", "es", "s", 5),
            (2, "another text of doc two", "en", "s", 5)]
    frame = spark.createDataFrame(rows, DOCS)
    from pyspark.sql import functions as F
    for name in ("ids", "IDS", "spans", "items", "score", "tag", "key", "grams", "removed"):
        if name.lower() not in {c.lower() for c in frame.columns}:
            frame = frame.withColumn(name, F.lit("clash"))
    return frame


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def sample(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
