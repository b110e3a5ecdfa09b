import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark):
    """Makes a documents table from (doc_id, text[, lang[, source]]) rows, with columns whose names clash with inner ones."""

    def make(rows, clashing=True):
        whole = [(*r, *[None] * (4 - len(r)), None) for r in rows]
        df = spark.createDataFrame(whole, DOCUMENTS)
        if clashing:
            for name in ("size", "key", "words", "kept", "row", "shard", "doc", "entry", "place", "d", "letters", "anchor"):
                df = df.selectExpr("*", f"'x' AS {name}")
        return df

    return make
