import os

import pytest

CHECK = "/root/testdata"


@pytest.fixture(scope="session")
def small():
    folder = f"{CHECK}/sf0.001"
    if not os.path.isdir(folder):
        pytest.skip("benchmark tables not present")
    return folder


#: Nulls, empty and blank texts, no letters, repeated rows, a long text without blanks, and every kind of junk.
ODD = [
    (1, "", "en"), (2, None, "en"), (3, "   \n\t\n", None), (4, "123 456 !!", "fr"), (None, "a null id has words too and ought to be kept", "en"),
    (5, "same text twice in this table, same id", "en"), (5, "same text twice in this table, same id", "en"),
    (6, "same id, another text", "en"), (6, "SAME id, another text!", "de"), (7, "x" * 50_000, None),
    (8, "word " * 3_000, "en"), (9, "\n".join(["a line that comes again and again"] * 40), "en"),
    (10, "a line that comes again and again\nand one of its own", "de"), (11, "A LINE that comes again and again \nand another one", None),
    (12, "größer ß ſ K Σ ς İ\u2581x 日本語 \U0001f600 \u0301e", "de"), (13, "\x00\x01 control \x1f \x85 \u00a0 \u2028", "es"),
]


@pytest.fixture(scope="session")
def odd(spark):
    """A small table of hard cases, with columns whose names operators use themselves."""
    rows = [(i, t, l, "src", None if t is None else len(t), "clash", 1, "clash", "clash") for i, t, l in ODD]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, kept string, n_words int, low string, lines string")
