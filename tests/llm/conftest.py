from __future__ import annotations

import pytest
from text_cases import ODD

SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, "
    "_text string, kept string, fp string, row string, n_lines int, score double"
)


@pytest.fixture(scope="session")
def docs(spark):
    """docs((id, text), ...) -> documents with null and clashing extra columns."""

    def make(*rows):
        data = [
            (i, t, None, "s", None if t is None else len(t), "x", None, "fp", "row", 1, 0.5)
            for i, t in rows
        ]
        return spark.createDataFrame(data, SCHEMA).repartition(3)

    return make


@pytest.fixture(scope="session")
def odd(docs):
    return docs(*ODD)


@pytest.fixture(scope="session")
def empty(docs, odd):
    return odd.limit(0)
