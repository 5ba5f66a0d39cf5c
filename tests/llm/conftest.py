import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(spark):
    """Makes a documents table of (doc_id, text) or (doc_id, text, lang, source)."""

    def make(rows):
        full = [(r[0], r[1], *(r[2:4] if len(r) > 2 else (None, None)), None if r[1] is None else len(r[1])) for r in rows]
        return spark.createDataFrame(full, DOCS)

    return make


@pytest.fixture
def vocabulary():
    """Invented words, a list for each of two languages."""
    import random

    rng = random.Random(3)
    make = lambda parts: ["".join(rng.choice(parts) for _ in range(rng.randint(1, 4))) for _ in range(400)]
    return make(["ka", "mo", "ri", "tu", "se"]), make(["sch", "ung", "ber", "ö", "eit"])
