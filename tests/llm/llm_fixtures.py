from __future__ import annotations

import pytest
from llm_texts import changed, words

from tidegrid.llm.frames import ship

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, node string, n_words string, _kept int, `t.x` string, Tile int, component long"


@pytest.fixture(scope="session")
def docs(spark):
    """Documents from (id, text[, source[, lang]]) rows, with extra columns whose names clash with internal ones."""
    ship(spark)

    def make(rows):
        full = []
        for r in rows:
            doc_id, text, source, lang = (*r, "s", "en")[:4] if len(r) == 2 else (*r, "en")[:4]
            full.append((doc_id, text, lang, source, None if text is None else len(text), "x", "y", 1, "z", 2, 3))
        return spark.createDataFrame(full, SCHEMA)

    return make


@pytest.fixture(scope="session")
def messy():
    """Nulls, empty and very long texts, ties, repeated rows, exact and near copies, shared passages."""
    base, passage = words(1, 200), words(2, 60)
    return [
        (1, base, "a"),
        (2, base.replace(" ", "  \t"), "a"),
        (3, changed(base, 60, "q"), "b"),
        (4, changed(base, 7, "r"), "b"),
        (5, None, "a"),
        (6, "", None),
        (7, " \n\t ", "c"),
        (8, "one two three", "c"),
        (9, "ONE two three", "c"),
        (10, "one  two three", None),
        (11, f"{words(3, 80)} {passage} {words(4, 30)}", "a"),
        (12, f"{words(5, 10)} {passage} {words(6, 90)}", "b"),
        (12, f"{words(5, 10)} {passage} {words(6, 90)}", "b"),
        (13, words(7, 20000), "long"),
        (14, words(7, 20000) + " more", "long"),
        (None, words(8, 70), "a"),
        (None, words(8, 70), "a"),
        (None, None, None),
        (15, "é ü \u2003 \u00a0ß 😀 <|im_end|>", "ü"),
        (16, "a b a b a b a b " * 20, "a"),
        (17, "line of words here\n" * 30, "b"),
        (18, words(9, 49), "b"),
        (19, words(9, 50), "b"),
        (20, f"{passage} {passage}", "a"),
    ]
