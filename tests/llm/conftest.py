"""Small document tables."""

from __future__ import annotations

import random

import pytest

DOC = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def frame(spark):
    def make(rows, schema=DOC):
        """Rows of (doc_id, text[, lang[, source]]) as a documents table."""
        if schema == DOC:
            rows = [
                (r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "a", len(r[1] or ""))
                for r in rows
            ]
        return spark.createDataFrame(rows, schema)

    return make


@pytest.fixture
def prose():
    """Seeded word salad over a small vocabulary."""

    def make(n, seed, words=400):
        rng = random.Random(seed)
        return " ".join(f"w{rng.randrange(words)}" for _ in range(n))

    return make
