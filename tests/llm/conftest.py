import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id long, key string, line int, h double"


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in every column, empty and very long texts, ties, repeats, and extra columns with the names used inside."""
    rng = random.Random(4)
    words = ["".join(rng.choice("abcdeéß") for _ in range(rng.randint(1, 9))) for _ in range(400)]

    def prose(n):
        return "\n".join(" ".join(rng.choice(words) for _ in range(12)) for _ in range(-(-n // 12)))

    shared = prose(120)
    near = shared.replace("a", "b", 1)
    texts = [(i, prose(rng.randint(1, 60))) for i in range(60)]
    texts += [(100, shared), (101, shared), (102, near), (103, prose(40) + "\n" + shared), (104, shared + "\n" + shared)]
    texts += [(200, None), (201, ""), (202, " \n\t "), (203, "one"), (None, shared), (None, None), (None, "one")]
    texts += [(300, prose(30_000)), (301, "x" * 60_000), (302, "\n" * 5000), (303, "a b " * 8000)]
    texts += [texts[0], texts[0], (100, shared), (0, "another text of one id")]
    rows = []
    for n, (id_, text) in enumerate(texts):
        odd = n % 5 == 0
        rows.append((id_, text, None if odd else "en", None if n % 7 == 0 else f"s{n % 3}", None, 7, "k", 1, float("nan")))
    return rows


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return spark.createDataFrame(odd_rows, SCHEMA).repartition(4).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
