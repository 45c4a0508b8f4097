import random

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Names that operators use for columns of their own.
CLASHING = ("rep", "component", "tree", "range", "next_text", "score", "tie", "left", "guard", "n")


def words(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8))) for _ in range(n))


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in any column, empty and long texts, ties, repeated rows, several scripts and odd white space."""
    rng = random.Random(4)
    long_text = words(rng, 6000)
    base = words(rng, 120)
    rows = [(1, None, "en", "s", 3), (2, "", None, None, None), (None, "no id here", "en", "s", 10), (3, " \t\n ", "de", "s", 4),
            (4, base, "en", "s", 1), (5, base, "en", "s", 1), (5, base, "en", "s", 1), (6, base + " more", "en", None, 1),
            (7, long_text, "en", "s", 1), (8, long_text.upper(), "fr", "s", 1), (9, "12345 67890 !!", "en", "s", 1),
            (10, "one two", "en", "s", 1), (11, "ONE\ttwo", "en", "s", 1), (12, "é ñ ß 漢字 \U0001f600 x" * 40, "es", "s", 1),
            (13, "a\n\n\nb\r\nc\n", "en", "s", 1), (14, "mail a.b@c.example.org, ip 10.0.0.1, tel +1 (555) 010-2000", "en", "s", 1),
            (15, "x" * 5000, "en", "s", 1), (16, "   spaces here\x1c", "en", "s", 1)]
    return rows + [(100 + k, words(rng, 5 + 3 * k), rng.choice(["en", "de"]), "s", 1) for k in range(20)]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return spark.createDataFrame(odd_rows, SCHEMA)


@pytest.fixture(scope="session")
def clashing(odd):
    out = odd
    for name in CLASHING:
        out = out.selectExpr("*", f"'z' as `{name}`")
    return out


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def table_of(df) -> list[tuple]:
    return sorted(map(tuple, df.collect()), key=repr)
