import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
for path in (ROOT, os.path.join(ROOT, "tests")):
    if path not in sys.path:
        sys.path.insert(0, path)

SF = "/root/testdata/sf0.001"


@pytest.fixture()
def docs_of(spark):
    """A documents table from (doc_id, text[, source]) rows, with a column named as helpers might be."""
    def make(rows):
        rows = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or ""), "x") for r in rows]
        return spark.createDataFrame(
            rows, "doc_id long, text string, lang string, source string, n_chars long, size string")
    return make
