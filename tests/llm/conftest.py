import pytest

LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(30_000))
PASSAGE = " ".join(f"passage{i}" for i in range(40))
#: Null and empty texts, nulls in every column, ties, repeated rows, ids twice with other texts, a very long text.
EDGE = [
    (1, "", "en", "a"),
    (2, None, "en", "b"),
    (3, "one", None, "a"),
    (4, "one", "en", None),
    (5, PASSAGE + " and an end of its own", "en", "a"),
    (6, "another start, then " + PASSAGE, "de", "b"),
    (6, "another start, then " + PASSAGE, "de", "b"),
    (7, PASSAGE, "en", None),
    (7, "the id of another text " + PASSAGE, "en", "c"),
    (8, LONG, "en", "a"),
    (9, LONG + " more", "en", "b"),
    (None, PASSAGE, "en", "a"),
    (None, None, None, None),
    (10, "a\tb\n\nc\x0bd\x0ce\rf éè 日本語 \U0001f600 \x00 \x85x y", "fr", "a"),
    (11, " \n\t ", "fr", "a"),
    (12, "ab" * 400, "fr", "c"),
    (13, "aaaa" * 200, "fr", "c"),
]
#: Columns that clash with names the operators use inside.
CLASH = ["id", "key", "h", "tag", "lo", "hi", "row", "ranges", "words", "size", "place", "lot", "score", "label", "fp", "node", "component", "taken", "number", "block", "query", "vec"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def edge(spark):
    rows = [(i, t, a, s, None if t is None else len(t), *["other"] * len(CLASH)) for i, t, a, s in EDGE]
    return spark.createDataFrame(rows, SCHEMA + "".join(f", {c} string" for c in CLASH))


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def small():
    import os

    path = "/root/testdata/sf0.001"
    if not os.path.isdir(path):
        pytest.skip("driver tables not present")
    return path
