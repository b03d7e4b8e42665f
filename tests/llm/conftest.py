import pytest


@pytest.fixture(scope="session")
def documents(spark):
    """A documents table of ``(doc_id, text)`` rows, with extra columns whose names the operators use inside."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, words string, key long, size long"

    def make(rows):
        full = [(i, t, "en", s[0] if s else "src0", len(t or ""), "x", 1, 2) for i, t, *s in rows]
        return spark.createDataFrame(full, schema)

    return make
