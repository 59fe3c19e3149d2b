import pytest

COLUMNS = ("doc_id long, text string, lang string, source string, n_chars long, size int, score double, row string, "
           "node string, weight double, __row string, __key long, ck_text string, fp long, ld_key string, ld_cut string")


@pytest.fixture(scope="session")
def docs_of(spark):
    """DataFrame of documents with extra columns whose names operators use inside."""
    def make(rows):
        full = [(i, t, lang, src, len(t) if t is not None else None, 7, 0.25, "r", "n", 1.5, "u", 3, "v", 4, "b", "c")
                for i, t, lang, src in rows]
        return spark.createDataFrame(full, COLUMNS)
    return make


@pytest.fixture(scope="session")
def edge_rows():
    long = " ".join(f"word{i % 977}" for i in range(30_000))
    return [(1, "alpha beta gamma delta epsilon zeta", "en", "a"), (1, "alpha beta gamma delta epsilon zeta", "en", "a"),
            (2, None, "en", "a"), (3, "", "de", None), (4, "   \n\n", None, "b"), (5, "12 34 %%", "fr", "b"),
            (None, "a text without an id here", "en", None), (None, None, None, None), (6, long, "en", "c"),
            (7, long + " tail", "en", "c"), (8, "x" * 100_000, "en", "c"), (9, "one", "en", "a")]
