import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def frame(spark):
    """A documents table of (doc_id, text) or (doc_id, text, source) rows, with columns whose names clash
    with those that operators use."""

    def make(rows, more=True):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
        df = spark.createDataFrame(full, DOCS)
        if more:
            for name in ("uid", "digest", "n", "block", "size", "h", "keep_id", "score", "label", "word", "run", "copies", "root", "grp", "slot", "place", "bucket"):
                df = df.selectExpr("*", f"'x' AS {name}")
        return df

    return make


@pytest.fixture(scope="session")
def prose():
    def make(n, words=60, seed=0, vocabulary=400):
        rng = random.Random(seed)
        return [" ".join(f"w{rng.randrange(vocabulary)}" for _ in range(rng.randrange(1, words))) for _ in range(n)]

    return make


#: Nulls, empties, blanks, one word, ties, repeated rows, and a long text.
ODD = [(1, None), (2, ""), (3, "  \n\t "), (4, "one"), (5, "one"), (5, "one"), (None, "one"), (None, None), (6, "long " * 50_000), (7, "a b c d e f"), (8, "é́ \x00 ​ \U0001f600")]


@pytest.fixture(scope="session")
def odd():
    return ODD
