import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def frame(spark):
    """documents from texts, with ids 0, 1, ... or from (id, text) pairs."""

    def build(texts, extra=""):
        rows = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
        full = [(i, t, "en" if (i or 0) % 2 else None, "src0" if (i or 0) % 3 else "src1", None if t is None else len(t))
                for i, t in rows]
        df = spark.createDataFrame(full, DOCS)
        return df.selectExpr("*", extra) if extra else df

    return build


@pytest.fixture
def rng():
    return random.Random(11)


@pytest.fixture(scope="session")
def odd_texts():
    """Nulls, empty, blank, long, repeated and non-ASCII texts."""
    return [None, "", "   \n\t ", "x" * 30_000, "one two " * 4_000, "É é İ ß ▁ 日本語 \U0001f600", "a.b", "\n\n", None, ""]
