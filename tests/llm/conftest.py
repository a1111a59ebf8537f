import random

import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def frame(spark):
    """A documents table of (doc_id, text) rows, with the other columns and some that clash with results."""

    def make(rows, *more):
        schema = "doc_id long, text string, lang string, source string, n_chars long"
        extra = "".join(f", {name} string" for name in more)
        data = [(d, t, None, "s", None if t is None else len(t), *["x"] * len(more)) for d, t in rows]
        return spark.createDataFrame(data, schema + extra)

    return make


@pytest.fixture(scope="session")
def sample(spark):
    """All documents of the smallest scale, as rows."""
    return [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]


@pytest.fixture
def odd_rows():
    """Nulls, empty and white texts, repeated rows, equal texts under several ids, and a long text."""
    rnd = random.Random(5)
    long = " ".join(f"w{rnd.randrange(900)}" for _ in range(9000))
    text = " ".join(f"v{i}" for i in range(70))
    return [
        (1, None), (2, ""), (3, " \n\t "), (4, text), (5, text), (5, text), (None, text), (None, None), (6, long),
        (7, long + " tail"), (8, "é " * 3), (9, "A b C"), (10, "a B c"),
    ]
