from __future__ import annotations

import pytest

from starweave.llm.scratch import Scratch

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(spark):
    """Documents from (doc_id, text) pairs, the sources in turn (one of them null)."""

    def make(*rows, sources=("a", None, "b")):
        made = [
            (i, t, "en", sources[k % len(sources)], len(t or "")) for k, (i, t) in enumerate(rows)
        ]
        return spark.createDataFrame(made, DOCS)

    return make


@pytest.fixture
def scratch(spark):
    made = Scratch(spark, "test")
    yield made
    made.close()
