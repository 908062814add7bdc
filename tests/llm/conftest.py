import pytest

#: Columns that clash with names the operators use inside, and that they must leave alone.
EXTRA = ["size", "rank", "shard", "digest", "key", "fp", "block", "__v", "path", "score"]


@pytest.fixture(scope="session")
def documents(spark):
    def make(rows, extra=True):
        """Documents (doc_id, text, source) with lang and n_chars, and clashing columns."""
        full = [(i, t, "en", s, None if t is None else len(t)) for i, t, s in rows]
        df = spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long")
        return df.selectExpr("*", *(f"'x' AS `{c}`" for c in EXTRA)) if extra else df

    return make
