import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, `order` int, bands string, label string"


def prose(seed: int, words: int) -> str:
    rng = random.Random(seed)
    made = ["".join(rng.choice(["ba", "ko", "ri", "tu", "ne", "sal", "mor"]) for _ in range(rng.randint(1, 4))) for _ in range(words)]
    return " ".join(w if rng.random() > 0.05 else w + ".\n" for w in made)


def odd_rows() -> list[tuple]:
    """Documents with nulls, empty and blank texts, repeated rows and keys, ties and a very long text."""
    shared = prose(99, 60)
    near = prose(7, 120).split()
    texts = {
        0: prose(0, 80), 1: None, 2: "", 3: " \n\t ", 4: prose(4, 30) + "\n" + shared, 5: shared + "\n" + prose(5, 40),
        6: " ".join(near), 7: " ".join([*near[:60], "other", *near[61:]]), 8: "one two three", 9: "one two three",
        10: prose(10, 30_000), 11: "x" * 90_000, 12: "ß𝄞 é 日本語" * 40, 13: prose(0, 80), 14: "a a a a a a a a a a a a a a a a",
        15: "line\nline\nline\n\n" + prose(15, 20), 16: shared}
    rows = [(i, t, "en" if i % 3 else None, [None, "a", "b", ""][i % 4], len(t or ""), i, "x", None) for i, t in texts.items()]
    rows += [rows[0], rows[0], (4, "another text under a known key " + shared, "en", "a", None, None, None, "y"),
             (None, shared, "de", "b", None, None, None, None), (None, None, None, None, None, None, None, None)]
    return rows


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)
