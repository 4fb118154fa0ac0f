"""Fixtures that the tests of this folder import."""

import pytest

from pointstream.llm.frames import importable

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session", autouse=True)
def workers_find_the_package(spark):
    importable(spark)


@pytest.fixture(scope="session")
def make(spark):
    """Documents from texts, numbered from 0; or from whole rows."""

    def documents(rows):
        rows = [r if isinstance(r, tuple) else (i, r, "en", "s", 0) for i, r in enumerate(rows)]
        return spark.createDataFrame(rows, SCHEMA)

    return documents


#: Names that operators use for results or inside, as extra columns of an input.
CLASHING = """n_words hits items pii _chunks _merged _text at word pattern quality kept score rejected
lang_pred component_id n_shingles doc row sig rep _gone _again n_tokens label given""".split()


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, clashing names."""
    from pyspark.sql import functions as F

    long = " ".join(f"word{i % 7919} tail{i % 31}." for i in range(40_000))
    rows = [
        (0, None, None, None, None),
        (None, "no id here at all, only some words", "en", "s", 5),
        (None, None, None, None, None),
        (1, "", "en", "", 0),
        (2, " \n\t ", "en", "s", 4),
        (3, long, "en", "s", len(long)),
        (4, "x" * 100_000, "en", "s", 100_000),
        (5, "the same row twice over and over", "en", "s", 1),
        (5, "the same row twice over and over", "en", "s", 1),
        (6, "the same row twice over and over", "en", "s", 1),
        (7, "1234 5678 !!", None, "s", 1),
        (8, "Größe ́ ärger 語語語 \U0001f600 ok", "de", "s", 1),
    ]
    frame = spark.createDataFrame(rows, SCHEMA)
    return frame.select("*", *(F.lit(f"own {c}").alias(c) for c in CLASHING))
