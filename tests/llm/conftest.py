from __future__ import annotations

from pathlib import Path

import pytest

SF_DIR = "/root/testdata/sf0.001"
LARGER_DIR = "/root/testdata/sf0.01"
LARGEST_DIR = "/root/testdata/sf0.1"


@pytest.fixture(scope="session")
def sf_dir():
    if not Path(SF_DIR).exists():
        pytest.skip("no test tables")
    return SF_DIR


@pytest.fixture(scope="session")
def larger_dir():
    if not Path(LARGER_DIR).exists():
        pytest.skip("no test tables")
    return LARGER_DIR


@pytest.fixture(scope="session")
def largest_dir():
    if not Path(LARGEST_DIR).exists():
        pytest.skip("no test tables")
    return LARGEST_DIR


#: Null, empty and blank texts, one word, repeated rows, a repeated key with another text,
#: a null key, null sources, and characters of two to four bytes.
ODD_ROWS = [
    (1, None, "en", "a"),
    (2, "", "en", "a"),
    (3, " \t\n", None, None),
    (4, "word", "en", "b"),
    (5, "The same row stands here two times over, and it is long enough for rules.", "en", "b"),
    (5, "The same row stands here two times over, and it is long enough for rules.", "en", "b"),
    (6, "One key with one text of some words that goes on for a while longer.", "en", None),
    (6, "One key with another text altogether, of words that are not the same.", "en", "a"),
    (None, "No key at all, but some words stand in the text for all that.", None, "c"),
    (7, "Größe für Straße – naïve café \U0001f600 中文 ΑΒΓ and more words to be had here.", "de", "c"),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Odd rows, with extra columns whose names the operators use inside."""
    long = " ".join(f"w{i % 977}x{i % 31}" for i in range(60_000))
    rows = [*ODD_ROWS, (8, long, "en", "a")]
    extra = "key string, name long, n int, spans string, row int, _key int, size double, seed int"
    schema = f"doc_id long, text string, lang string, source string, {extra}"
    return spark.createDataFrame([(*r, "k", 1, 2, "s", 3, 4, 0.5, 6) for r in rows], schema)


@pytest.fixture(scope="session")
def nothing(odd):
    return odd.limit(0)
