import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from llm_support import LONG, SCHEMA, SF  # noqa: E402


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").cache()


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty and long texts, repeated rows, and columns
    named like those the operators work with."""
    rows = [
        (1, None, None, None, None), (2, "", "en", "a", 0), (3, "   \n\t ", "en", "a", 6), (4, LONG, "en", "a", len(LONG)),
        (5, "one two three", "en", None, 13), (5, "one two three", "en", None, 13), (6, "\u0000K \U0001f600 ſ İ " * 3, None, "a", 1),
        (7, "12345 !!! ###", "en", "a", 13), (None, "a text that has no id but has words enough", "en", "a", 42),
    ]
    extra = "kept boolean, words string, text_hash string, slot int, shard string, component_id string, label string, score string, fill string"
    values = (True, "w", "h", 0, "s", "c", "l", "x", "f")
    return spark.createDataFrame([r + values for r in rows], f"{SCHEMA}, {extra}")


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
