import pytest
from samples import prose

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def edge_rows():
    """Nulls in each column, empty and very long texts, ties and repeated rows."""
    a = prose(1)
    rows = [
        (1, a, "en", "s1", 1),
        (2, a, "en", "s1", 1),
        (2, a, "en", "s1", 1),
        (3, None, "en", "s2", None),
        (4, "", "de", None, 0),
        (None, prose(2), None, "s2", 5),
        (5, " \t\n\x0b\x0c\r ", "de", "s3", 7),
        (6, prose(3, 40_000), "fr", "s1", 9),
        (7, "é ü \x1c\x85 漢字かな交じり文 👩‍👩‍👧", "ja", "s3", 3),
        (8, prose(4), "en", "s2", 1),
        (9, "x" * 100_000, "en", "s2", 1),
        (10, prose(4), "en", "s2", 1),
    ]
    return rows


@pytest.fixture(scope="session")
def edges(spark, edge_rows):
    """The edge rows with extra columns whose names operators use inside."""
    df = spark.createDataFrame(edge_rows, DOCS)
    for name in ("fp", "size", "target", "h", "row", "t", "score", "kept", "component_id", "position", "start", "key", "_id", "_n", "_own", "_at", "_mark", "_row", "_i", "_t", "_h", "row.x", "a.b", "text_hash", "set", "taken"):
        df = df.selectExpr("*", f"'x' AS `{name}`")
    return df


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
