"""Small tables with every odd case: nulls, empty and long texts, ties, repeated rows, columns of clashing names."""

import random

import pytest

WORDS = [f"{a}{b}" for a in ("ta", "lo", "mir", "sen", "vu", "kop", "dra", "née", "il") for b in ("ren", "do", "sa", "lim", "et", "öst", "na", "u")]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, n int, id string, size string, kinds string, text_hash double, `a.b` int"


def prose(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) for _ in range(n)).capitalize() + "."


def odd_rows() -> list[tuple]:
    rng = random.Random(5)
    base = prose(rng, 120)
    near = base.split()
    near[3] = "changed"
    long = prose(rng, 30_000)
    texts = [
        (1, base), (2, base), (2, base), (3, " ".join(near)), (4, None), (5, ""), (6, " \n\t "), (None, base), (None, None), (7, "one"), (8, "One"), (9, "one two three"),
        (10, long), (11, long + " and more"), (12, 'x token = "abcdef123" y'), (13, "ñ" * 500), (14, "AKIA" + "B" * 16 + " deadbeef" * 3 + "deadbeefdeadbeefdeadbeef"), (15, "a" * 5000),
    ]
    for k in range(16, 60):
        texts.append((k, prose(rng, rng.randint(5, 60))))
    rows = []
    for k, (i, t) in enumerate(texts):
        rows.append((i, t, None if k % 7 == 0 else "en", None if k % 5 == 0 else f"s{k % 3}", None if t is None else len(t), "r", k, "i", "z", "k", 0.5, k))
    return rows


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def benchmark_table(spark):
    rng = random.Random(9)
    return spark.createDataFrame([(k, prose(rng, 30)) for k in range(6)] + [(6, None), (7, ""), (None, "nothing of note here"), (8, "short"), (9, prose(random.Random(9), 30))], "item_id long, text string")
