import string
import sys
import os

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
EDGE = "doc_id long, text string, lang string, source string, k1 string, shard string, repeats string, pos string"


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls in every column, empty and long texts, ties, a repeated row, extra columns with clashing names."""
    long_line = "The same long line that many of the documents hold between them"
    rows = [(i, f"Own words of number {i} here\n{long_line}\n" + "x y z w v u " * (i % 4), "en", f"s{i % 3}", "a", "b", "c", "d")
            for i in range(12)]
    rows += [(20, None, None, None, None, None, None, None), (21, "", "en", "s1", "a", "b", "c", "d"),
             (22, "word " * 30000, "en", "s0", None, "b", "c", "d"), (23, rows[3][1], "en", None, "a", "b", "c", "d"),
             (24, "\n \t\n", "en", "s2", "a", "b", "c", "d"), rows[5], (25, "É à ñ " * 40, "fr", "s2", "a", "b", "c", "d")]
    return spark.createDataFrame(rows, EDGE)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], EDGE)
