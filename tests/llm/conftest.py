import random

import pytest

#: Words for made-up texts.
VOCABULARY = [f"{a}{b}{c}" for a in ("ka", "lo", "mi", "ter", "su") for b in ("ren", "da", "vil", "po") for c in ("", "n", "s")]


def words(rng: random.Random, n: int) -> list[str]:
    return [rng.choice(VOCABULARY) for _ in range(n)]


@pytest.fixture
def rng():
    return random.Random(5)


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, extra columns."""
    rng = random.Random(9)
    plain = " ".join(words(rng, 90)) + ".\n" + " ".join(words(rng, 40))
    near = plain.replace(" ", "  ", 1) + " end"
    long = " ".join(words(rng, 30_000))
    rows = [
        (1, plain, "en", "a", 5), (2, plain, "en", "a", 5), (3, near, None, None, None), (4, None, "en", "b", 0),
        (5, "", "en", "b", 0), (6, "  \n\n ", "en", "b", 0), (7, long, "en", None, 1), (7, long, "en", None, 1),
        (8, "one two", "de", "c", 7), (9, "naïve Ǻ 漢字 😀 <|endoftext|> it's  done", "fr", "c", 7),
        (None, "no id here at all", "fr", "c", 7), (10, "x" * 3000, "fr", "c", 7),
    ]
    schema = ("doc_id bigint, text string, lang string, source string, n_chars bigint, size bigint, id bigint, mark string, "
              "`group` string, label int, score string, `_id` int")
    return spark.createDataFrame([(*r, 3, 4, "m", "g", 1, "s", 2) for r in rows], schema).repartition(3)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
