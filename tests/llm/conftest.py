import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, kept string, mix_copy int"


def make_docs(spark, texts):
    """Documents from (id, text) pairs with further columns whose names the operators use themselves."""
    rows = [(i, t, "en", None if i is None else f"s{i % 3}", None if t is None else len(t), "mine", 7) for i, t in texts]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="session")
def words():
    rng = random.Random(4)
    return ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 8))) for _ in range(3000)]


@pytest.fixture(scope="session")
def awkward():
    """Nulls, empty and white texts, ties, repeated rows, odd characters, a very long text."""
    long = " ".join(f"word{i % 977} und{i}" for i in range(120_000))
    return [
        (1, "the same words"),
        (1, "the same words"),
        (2, "the same  words"),
        (3, "the same\twords"),
        (None, "the same words"),
        (None, None),
        (4, None),
        (5, ""),
        (6, " \n\t "),
        (7, "É ß 日本 👍 <|endoftext|> a\x00b"),
        (8, long),
        (9, "x" * 300_000),
        (10, "one"),
        (10, "two"),
    ]
