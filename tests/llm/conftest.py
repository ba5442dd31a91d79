import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(30_000))
NAMES = "the old house near a quiet river keeps every secret that children once told it in summer".split()


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in every column, empty, blank and very long texts, repeated rows and ids, clashing extra columns."""
    prose = " ".join(NAMES * 6)
    return [
        (1, prose, "en", "a"), (1, prose, "en", "a"), (2, prose, "en", None), (3, prose + " again", None, "a"),
        (4, None, "en", "b"), (5, "", "en", "b"), (6, " \t\n\x0b\x0c\r ", None, None), (7, LONG, "en", "a"),
        (8, LONG + " tail", "de", "b"), (None, prose, "en", "a"), (None, None, None, None), (9, "one", "en", "c"),
        (10, "Eins zwei", "de", "c"), (11, "  ", "fr", "\U0001F600"), (12, "á 한국 <|endoftext|>", "fr", "z"),
        (13, "x " * 200, "en", "a"), (1, "another text of the same id", "en", "a"),
    ]


@pytest.fixture(scope="session")
def odd_documents(spark, odd_rows):
    """The odd rows with extra columns named like columns that operators use inside."""
    extra = "id string, text_ string, size long, target double, copies long, bucket long, n_words long, kept boolean, " \
            "row string, f string, block long, component_id long, token_ids string, n_tokens string, decoded string, k long"
    n = len(extra.split(","))
    return spark.createDataFrame(
        [(*r, *(None,) * n) for r in odd_rows], "doc_id long, text string, lang string, source string, " + extra)


@pytest.fixture(scope="session")
def no_documents(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
