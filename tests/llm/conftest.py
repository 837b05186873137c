from pathlib import Path

import pytest

FOLDER = "/root/testdata/sf0.001"
LONG = "lorem ipsum dolor sit amet " * 20_000
EXTRA = ["row_key", "size", "place", "nth", "words", "found", "keys", "pieces", "language", "copies", "digest", "_text"]


@pytest.fixture(scope="session")
def awkward(spark):
    """Documents with NULLs in every column, empty and very long texts, equal rows and clashing columns."""
    rows = [
        (1, "The quick brown fox", "en", "a", 19),
        (1, "The quick brown fox", "en", "a", 19),
        (2, None, "en", "a", None),
        (3, "", None, "b", 0),
        (4, " \t\n ", "de", None, 4),
        (5, LONG, "en", "b", len(LONG)),
        (6, LONG + "more", None, None, len(LONG) + 4),
        (None, "der die das und ein Haus", "de", "a", 24),
        (None, "der die das und ein Haus", "de", "a", 24),
        (7, "x" * 200_000, "en", "c", 200_000),
        (8, "ein Wort und noch ein Wort der Sprache", "de", "c", 38),
    ]
    return spark.createDataFrame(
        [(*r, *[f"{name}!" for name in EXTRA]) for r in rows],
        "doc_id long, text string, lang string, source string, n_chars long, "
        + ", ".join(f"{name} string" for name in EXTRA),
    )


@pytest.fixture(scope="session")
def nothing(awkward):
    return awkward.filter("false")


@pytest.fixture(scope="session")
def documents(spark):
    if not Path(FOLDER).exists():
        pytest.skip("no test data here")
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


def by_id(df, *columns):
    """Values of the columns by doc_id; equal for rows that repeat."""
    out = {}
    for r in df.collect():
        got = tuple(r[c] for c in columns)
        assert out.setdefault(r["doc_id"], got) == got
    return out
