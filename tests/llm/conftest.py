from __future__ import annotations

import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
WORDS = "the river ran under an old stone bridge while seven people watched quiet boats drift past green banks".split()


@pytest.fixture
def tables(spark, tmp_path):
    """Writes tables of rows and returns their folder."""

    def write(**rows):
        for name, (schema, values) in rows.items():
            spark.createDataFrame(values, schema).write.parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)

    return write


def docs(spark, texts, lang="en"):
    return spark.createDataFrame([(i, t, lang, "s", None if t is None else len(t)) for i, t in enumerate(texts)], DOCS)
