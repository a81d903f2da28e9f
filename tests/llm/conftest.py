import random

import pytest

#: Extra columns whose names the operators use themselves.
EXTRA = ["node", "n", "size", "h1", "anchor", "row", "host", "taken", "ids", "kept", "features", "id", "place", "target"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in EXTRA)


def words(seed: int, n: int) -> list[str]:
    draw = random.Random(seed)
    return ["".join(draw.choice("abcdefghij") for _ in range(draw.randint(2, 7))) for _ in range(n)]


@pytest.fixture(scope="session")
def awkward(spark):
    """NULLs in every column, empty, blank and very long texts, copies, repeated rows and ids."""
    long = " ".join(words(1, 30_000))
    base = words(2, 120)
    edited = [*base[:60], "changed", *base[61:]]
    rows = [
        (1, " ".join(base), "en", "a"),
        (2, " ".join(base).upper(), "en", "a"),
        (2, " ".join(base).upper(), "en", "a"),
        (3, " ".join(edited), "de", None),
        (4, None, "en", "b"),
        (5, "", None, "b"),
        (6, " \t\n\x0b\x0c\r ", "fr", "c"),
        (7, long, "en", "a"),
        (8, long, None, None),
        (9, "x" * 50_000, "en", "b"),
        (10, "!!! 123 ???", "en", "c"),
        (11, "a b  c▁d \u0000 e\U0001f600\n\nfür", "fr", "c"),
        (12, "word", "en", "a"),
        (None, " ".join(base), "en", "a"),
        (None, None, None, None),
        (13, "same line\nsame line\n\nsame line ", "en", "b"),
        (14, "word " * 3_000, "en", "z"),
    ]
    return spark.createDataFrame([(i, t, lang, s, None if t is None else len(t), *["x"] * len(EXTRA)) for i, t, lang, s in rows], SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
