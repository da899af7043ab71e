from __future__ import annotations

import pytest

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture
def texts(spark):
    """A table of documents from texts: ids in order, plus clashing columns."""

    def build(*values, ids=None):
        ids = range(len(values)) if ids is None else ids
        rows = [(i, t, None, None, None, "x", 7) for i, t in zip(ids, values, strict=True)]
        return spark.createDataFrame(
            rows, "doc_id long, text string, lang string, source string, n_chars long, component string, size int"
        )

    return build


