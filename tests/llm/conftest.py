import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns whose names the operators use inside; they are to be ignored or kept, never confused.
CLASH = {"size": 1, "rank": 2, "h": 3, "spans": "x", "__size": 4, "words": 5, "start": 6, "block": 7}


@pytest.fixture
def docs_of(spark):
    def make(rows, clash=False):
        """documents from (doc_id, text[, lang[, source]])."""
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s", None if r[1] is None else len(r[1])) for r in rows]
        schema = DOCUMENTS
        if clash:
            full = [r + tuple(CLASH.values()) for r in full]
            schema += ", " + ", ".join(f"`{k}` {'string' if isinstance(v, str) else 'int'}" for k, v in CLASH.items())
        return spark.createDataFrame(full, schema)

    return make


@pytest.fixture
def as_table(tmp_path):
    """Writes a DataFrame as a table of a new folder and returns the folder."""

    def write(df, name="documents"):
        df.write.mode("overwrite").parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)

    return write
