from __future__ import annotations

import random

import pytest

LONG = " ".join(f"w{i % 977}x" for i in range(30000))


def words(rng: random.Random, n: int, alphabet: str = "abcdefghij") -> str:
    return " ".join("".join(rng.choice(alphabet) for _ in range(rng.randint(2, 6))) for _ in range(n))


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Null and empty texts, a very long one, repeated rows and ids, a null id, clashing extra columns."""
    rng = random.Random(5)
    base = [words(rng, rng.randint(1, 160)) for _ in range(60)]
    rows = [(i, t) for i, t in enumerate(base)]
    rows += [(100, None), (101, ""), (102, " \n"), (103, LONG), (104, base[3]), (104, base[3]), (105, base[4]), (105, base[5]), (None, base[6]), (None, None)]
    rows += [(200 + k, base[7]) for k in range(30)]  # a group of copies
    near = base[8].split()
    rows += [(300 + k, " ".join(near[: 10 + k] + ["zz"] + near[11 + k :])) for k in range(5)]
    all_rows = [(i, t, "en", "src0", k, "x", 1, True) for k, (i, t) in enumerate(rows)]
    return spark.createDataFrame(
        all_rows, "doc_id long, text string, lang string, source string, n_chars long, fingerprint string, size int, rejected boolean"
    ).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
