import random

import pytest

DATA = "/root/testdata/sf0.001"


@pytest.fixture
def docs_of(spark):
    """Rows ``(doc_id, text)`` as a frame with extra columns whose names clash."""

    def make(rows, schema="doc_id bigint, text string"):
        df = spark.createDataFrame(rows, schema)
        return df.selectExpr("'x' AS DOC_ID", "*", "1 AS Text", "2 AS hash", "3 AS `a.b`")

    return make


@pytest.fixture
def prose():
    """Texts of invented words: exact copies, near copies, short and empty ones, and nulls."""
    rng = random.Random(5)
    vocabulary = ["".join(rng.choice("abcdeéß") for _ in range(rng.randint(2, 7))) for _ in range(400)]

    def words(n):
        return [rng.choice(vocabulary) for _ in range(n)]

    base = [words(rng.randint(40, 120)) for _ in range(12)]
    texts = [" ".join(w) for w in base]
    for w in base[:6]:
        changed = list(w)
        changed[rng.randrange(len(w))] = "zzz"
        texts.append(" ".join(changed))
        texts.append("\n".join(w).upper())
    texts += [None, "", " \t\n", "one", "one two", "one two", texts[0], texts[0] + " "]
    return [(i, t) for i, t in enumerate(texts)]
