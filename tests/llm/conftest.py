from __future__ import annotations

import pytest

from tradeloom.llm.shipping import ship

#: Names that operators use for their results or inside, to clash with them.
EXTRA = "kept string, words int, hash string, ids string, decoded string, n_words string, labels string, version string"


@pytest.fixture(scope="session")
def llm(spark):
    ship(spark)
    return spark


@pytest.fixture
def odd(llm):
    """Documents from (doc_id, text), with columns that clash with results."""

    def make(rows):
        full = [(i, t, *(["x", 1] + ["x"] * 6)) for i, t in rows]
        return llm.createDataFrame(full, f"doc_id long, text string, {EXTRA}")

    return make


@pytest.fixture
def texts():
    """Odd texts: null, empty, white space, one word, repeats, copies, many languages, one very long text."""
    passage = " ".join(f"w{i}" for i in range(60))
    return [
        (1, None), (2, ""), (3, " \n\t "), (4, "word"), (None, "no id here"), (None, None), (5, f"start {passage} end"),
        (6, f"{passage}\nother tail"), (6, f"{passage}\nother tail"), (6, "same id, other text"), (7, "a " * 300),
        (8, "Grüße aus  Köln — 東京 🤖 ▁ <|endoftext|> it's 1234\n\n fine "), (9, f"start {passage} end"),
        (10, " ".join(f"v{i % 977} q{i}" for i in range(30_000))), (11, "x\x0by\x0cz\x1cq"), (12, "All rights reserved. CC BY cc by"),
    ]
