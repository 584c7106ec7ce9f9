import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(__file__))

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, norm string, key string, bucket int, component_id string, score string, h string, kept string"


@pytest.fixture(scope="session")
def make(spark):
    """A table of documents with more columns, whose names operators use themselves."""

    def build(rows):
        full = [(i, t, *(lang or ["en"]), "s", len(t or ""), "x", "k", 1, "c", "0", "h", "y") for i, t, *lang in rows]
        return spark.createDataFrame(full, SCHEMA)

    return build
