from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import pytest  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(spark):
    """documents from (doc_id, text) pairs, over several partitions."""

    def build(pairs, parts=3, **extra):
        rows = [(i, t, extra.get("lang", "en"), "src0", len(t or "")) for i, t in pairs]
        return spark.createDataFrame(rows, DOCS).repartition(parts)

    return build
