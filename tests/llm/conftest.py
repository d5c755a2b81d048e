from __future__ import annotations

import pytest

EXTRA = "lang string, key long, id string, n long, uid long, comp long, salt int, slot string, part long"


@pytest.fixture()
def make_docs(spark):
    """Documents with columns whose names clash with those the operators use inside."""

    def make(rows):
        rows = [(i, t, "en", 7, "x", 7, 7, 7, 7, "x", 7) for i, t in rows]
        return spark.createDataFrame(rows, "doc_id long, text string, " + EXTRA)

    return make
