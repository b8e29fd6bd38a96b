import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs(spark):
    """Rows (id, text, source) → documents."""
    def make(rows):
        return spark.createDataFrame([(i, t, "en", s, len(t) if t is not None else None) for i, t, s in rows], DOCS)

    return make


@pytest.fixture(scope="session")
def edge_rows():
    """Nulls in every column, empty and long texts, ties and repeated rows."""
    long = " ".join(f"w{i % 977} x{i % 13}," for i in range(60_000))
    return [(1, "a b c", "s"), (1, "a b c", "s"), (2, None, "s"), (3, "", "t"), (None, "lost id", "t"), (5, "no source here", None),
            (6, "   \n\t ", "u"), (7, long, "u"), (8, long + " end", "u"), (9, "x" * 100_000, None), (10, "a b c", "v"), (None, None, None),
            (11, "naïve café 漢字 😀", "s"), (12, "a\x00b \x1c c\x85d e", "s")]
