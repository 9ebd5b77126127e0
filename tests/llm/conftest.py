from __future__ import annotations

import random

import pytest

WORDS = "the of and to in is that for was on are with they be at one have this from by hot but some what there".split()
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, n long, rep string"


def sentence(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) + rng.choice("abcdefgh") for _ in range(n))


def corpus(seed: int = 0) -> list[tuple]:
    """Near and exact copies, shared lines, nulls, empty and blank texts, a long text; last columns clash with inner names."""
    rng = random.Random(seed)
    texts: list[str | None] = [sentence(rng, rng.randint(3, 120)) for _ in range(40)]
    base = sentence(rng, 90).split()
    for i in range(25):
        copy = list(base)
        for _ in range(rng.randint(0, 4)):
            copy[rng.randrange(len(copy))] = f"changed{rng.randint(0, 5)}"
        texts.append(" ".join(copy))
    shared = "A line that a good many of the documents have in common with each other."
    for i in range(12):
        texts.append("\n".join([shared, sentence(rng, 20), shared.replace("good", "god") if i % 3 else shared]))
    texts += [texts[3]] * 6 + [None, None, "", "", " \n\t ", "word", "word", "two words", "TWO Words", "ÄÖ ü é 123 €"]
    texts += [" ".join(["same"] * 400), sentence(rng, 6000)]
    return [(i, t, ("en", "de", None)[i % 3], ("a", "a", "b", None)[i % 4], len(t or ""), f"k{i}", i, "r") for i, t in enumerate(texts)]


@pytest.fixture(scope="session")
def rows():
    return corpus()


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
