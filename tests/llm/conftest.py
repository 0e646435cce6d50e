from __future__ import annotations

import pytest
from pyspark.sql import SparkSession

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture
def documents(spark: SparkSession):
    """Rows ``(doc_id, text)`` or ``(doc_id, text, lang)`` as a documents table."""

    def build(rows):
        filled = [(*row, None)[:3] if len(row) == 2 else row for row in rows]
        return spark.createDataFrame([(i, t, lang, "s", None if t is None else len(t)) for i, t, lang in filled], DOCS)

    return build
