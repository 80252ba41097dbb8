import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(rng: random.Random, n: int) -> list[str]:
    parts = ["ka", "lo", "mi", "su", "té", "ra", "ne", "po", "vi", "du"]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(1, 3))) for _ in range(n)]


@pytest.fixture(scope="session")
def corpus():
    """Rows with exact and near copies, a shared passage, repeated rows, nulls, empty texts and one very long text."""
    rng = random.Random(5)
    texts = [" ".join(words(rng, rng.randint(1, 120))) for _ in range(40)]
    base = words(rng, 100)
    texts += [" ".join(base), " ".join(base), "  ".join(base).upper()]
    for k in range(8):
        near = list(base)
        for _ in range(1 + k % 3):
            near[rng.randrange(len(near))] = "changed"
        texts.append(" ".join(near))
    passage = " ".join(words(rng, 60))
    texts += [f"{' '.join(words(rng, 20))}\n{passage}\n{' '.join(words(rng, 20))}" for _ in range(4)]
    texts += [None, "", " \n\t ", "one", "one two", "one two", "a b c d e", "A b\tc d  e", " ".join(words(rng, 30_000)), "x" * 300_000]
    rows = [(i * 3 + 1, t, "en", f"src{i % 3}", len(t or "")) for i, t in enumerate(texts)]
    return rows + [rows[0], rows[41], (None, texts[3], None, None, None), (None, None, None, None, None)]


@pytest.fixture(scope="session")
def docs(spark, corpus):
    return spark.createDataFrame(corpus, SCHEMA).repartition(5)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
