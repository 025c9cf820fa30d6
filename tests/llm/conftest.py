import os

import pytest

LONG = ("alpha beta gamma delta " * 3 + "epsilon zeta\n") * 4000


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty, blank and very long texts, repeated rows, equal texts, and extra columns whose
    names clash with results."""
    rows = [
        (1, None, "en", "s", 1), (2, "", "en", "s", 0), (3, " \t\n ", None, None, None), (4, LONG, "en", "s", 5), (None, "no id here at all", "en", "s", 4),
        (5, "same text twice over and over", "de", "s", 3), (5, "same text twice over and over", "de", "s", 3), (6, "same text twice over and over", "de", "s", 3),
        (7, "12 34 5678   \x1c \xa0", "fr", "s", 2), (8, "Ünïcödé wörds 𝔘𝔫𝔦 ́ <|endoftext|> it's", "de", None, 2), (9, "one", "es", "s", 1),
    ]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    clash = "'x' AS kept, 'x' AS toxic, 'x' AS fp, 'x' AS size, 'x' AS slot, 'x' AS shard, 'x' AS lang_pred, 'x' AS score, 'x' AS piece, 'x' AS length, 'x' AS n_words, 'x' AS key, 'x' AS held_out"
    return spark.createDataFrame(rows, schema).selectExpr("*", *clash.split(", "))


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)


@pytest.fixture(scope="session")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def docs(spark, data_dir):
    return spark.read.parquet(os.path.join(data_dir, "documents.parquet"))


@pytest.fixture(scope="session")
def labels(spark, data_dir):
    return spark.read.parquet(os.path.join(data_dir, "labels.parquet"))
