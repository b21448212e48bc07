import pytest


@pytest.fixture
def docs(spark):
    """Small documents table: ``docs(texts)`` or ``docs(rows, schema)``."""

    def make(rows, schema="doc_id long, text string, lang string, source string, n_chars long"):
        full = [
            r if isinstance(r, tuple) else (i, r, "en", "s", len(r or "")) for i, r in enumerate(rows)
        ]
        return spark.createDataFrame(full, schema)

    return make
