import random

import pytest

#: Columns of ``documents`` and one more whose name a query might use itself.
SCHEMA = "doc_id long, text string, lang string, source string, n_chars int, n long"


def rows_of(texts: list, source=lambda i: "web" if i % 3 else "books") -> list[tuple]:
    return [(i, t, "en", source(i), len(t or ""), i) for i, t in enumerate(texts)]


def prose(seed: int, words: int) -> str:
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 9))) for _ in range(400)]
    return " ".join(rng.choice(vocabulary) for _ in range(words))


@pytest.fixture(scope="session")
def texts() -> list:
    """Ordinary texts with nulls, empty, repeated, near-equal and very long ones."""
    base = [prose(i, 30 + 7 * i) for i in range(24)]
    passage = prose(900, 60)
    return [*base, None, "", "", "   \n\t ", base[3], base[3], base[5] + " end", base[6][:200] + passage + base[7],
            passage + " ~ " + passage, "é ß 漢字 😀 Ünïcode " * 20, "A" * 700, "ab" * 300, prose(901, 9000)]


@pytest.fixture(scope="session")
def docs(spark, texts):
    return spark.createDataFrame(rows_of(texts), SCHEMA).repartition(5)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, the null row twice."""
    return spark.createDataFrame([(None,) * 6, (None,) * 6, (1, "some words here", None, None, None, None),
                                  (1, "some words here", None, None, None, None), (2, None, "en", "web", 0, 1)], SCHEMA)
