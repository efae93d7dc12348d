import random

import pytest

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, size long, counts string, target string, "
    "_score string, found string, spans string, rank int, cluster string"
)
WORDS = [f"{a}{b}" for a in ("ka", "lo", "mi", "ne", "ru") for b in ("ta", "so", "vé", "x", "ben", "dor")]


def sentence(seed: int, words: int) -> str:
    pick = random.Random(seed)
    return " ".join(pick.choice(WORDS) for _ in range(words))


def edge_rows() -> list[tuple]:
    """Nulls, blanks, very long texts, copies, repeated rows, special strings, and columns whose names clash."""
    base = sentence(1, 120)
    edited = base.split()
    edited[60] = "other"
    far = base.split()
    far[10:60:5] = ["zz"] * 10
    texts = [
        (0, None, "en", "a"), (1, "", "en", "a"), (2, " \t\n ", "en", "b"), (3, base, "en", "a"), (4, base, "fr", None),
        (5, " ".join(edited), "en", "a"), (6, " ".join(far), None, "c"), (7, "one two", "en", ""), (8, "ONE  two", "en", "a"),
        (9, sentence(2, 30_000), "de", "a"), (10, "x" * 5000 + " " + base.upper(), "en", "a"), (11, "漢字 😀 ²½ don't'll <|endoftext|> a", "es", "b"),
        (12, "mail me: a.b@c.de or +1 (212) 555-0199, card 4111 1111 1111 1111, host 10.0.0.256 and 10.0.0.25", "en", "b"),
        (13, sentence(3, 80) + "\n" + base, "en", "a"), (13, sentence(3, 80) + "\n" + base, "en", "a"), (None, sentence(4, 60), "en", "a"),
        (15, "idiot! you 1d1ot", "en", "a"), (16, "###" * 200, "en", "a"), (20, "last " * 70, None, "a"), (21, "!!! 12 345", "en", "a"),
    ]
    return [(i, t, lang, s, 0, 1, "c", "t", "s", "f", "p", 2, "k") for i, t, lang, s in texts]


@pytest.fixture(scope="session")
def edge_docs(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA).repartition(3, "doc_id").cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
