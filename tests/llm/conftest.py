import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark):
    """Documents from (id, text) or (id, text, source); the other columns are null."""

    def make(*rows, extra=""):
        full = [(r[0], r[1], None, r[2] if len(r) > 2 else None, None, *([7] * extra.count(","))) for r in rows]
        return spark.createDataFrame(full, SCHEMA + extra)

    return make
