"""Small tables and brute-force helpers for the operator tests."""

import re

import pytest

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def words(text):
    return WORD.findall(text or "")


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in every column, empty and very long texts, ties, repeated rows."""
    para = " ".join(f"w{i}" for i in range(60))
    rows = [
        (1, para + " tail one", "en", "a"), (2, "head two " + para, "en", "b"), (3, None, "en", "a"), (4, "", "fr", None),
        (5, " \n\t ", None, "b"), (6, "short text", "en", "c"), (7, "short text", "en", "c"), (8, "Short TEXT", None, "c"),
        (9, "x " * 30_000, "de", "d"), (10, "é😀 ünï ß " * 40, "de", "a"), (11, "word joined \x1c sep", "en", "a"),
        (None, "no id here " * 5, "en", "a"), (None, None, None, None), (6, "short text", "en", "c"),
        (12, "y" * 100_000, "en", "e"), (13, para.replace("w30 ", "") + " more", "en", "a"),
    ]
    return [(i, t, lang, s, len(t) if t is not None else None) for i, t, lang, s in rows]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return spark.createDataFrame(odd_rows, DOCUMENTS)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCUMENTS)


@pytest.fixture(scope="session")
def clashing(spark, odd_rows):
    """The same rows with further columns named like internal ones."""
    names = ("id", "key", "node", "row", "size", "draw", "copies", "score", "unit", "label", "class", "spans", "kind")
    schema = DOCUMENTS + "".join(f", {n} string" for n in names)
    return spark.createDataFrame([(*r, *names) for r in odd_rows], schema)
