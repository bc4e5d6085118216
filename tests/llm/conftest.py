import pytest


@pytest.fixture(scope="session")
def docs_of(spark):
    """A function from (doc_id, text, source) rows to documents, with columns that clash with results' names."""

    def make(rows):
        schema = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, fp long, root string, score string, _new string, _c0 int, n int, size string"
        return spark.createDataFrame([(i, t, "en", s, None if t is None else len(t), None, 7, "x", "y", "z", 1, 2, "w") for i, t, s in rows], schema)

    return make


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
