import os

import pytest

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def sf():
    if not os.path.isdir(SF):
        pytest.skip("driver test data not present")
    return SF


#: (doc_id, text, lang, source): null cells, empty, blank, repeated and tied rows.
ODD = [
    (1, None, "en", "a"), (2, "", "en", None), (3, " \n\t ", None, "a"), (4, "x", "en", "a"), (None, "lone words here", "en", "a"),
    (5, "same text of six words here", "en", "a"), (5, "same text of six words here", "en", "a"), (6, "same text of six words here", "en", "b"),
    (7, "long " + "word other third " * 30_000, "en", "a"), (8, "é" * 5000 + " 1" * 3000, "fr", "b"),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Odd rows with extra columns whose names operators use inside."""
    rows = [(*r, 1, "clash", 2, "h") for r in ODD]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, id int, t string, n int, h string")


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
