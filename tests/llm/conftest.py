import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SF = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def documents(spark):
    """(doc_id, text[, source]) tuples to a table of documents."""

    def make(rows, extra=()):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None if r[1] is None else len(r[1]), *(["x"] * len(extra))) for r in rows]
        return spark.createDataFrame(full, DOCS + "".join(f", {c} string" for c in extra)).repartition(3)

    return make
