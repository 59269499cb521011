import pytest

COLUMNS = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"


@pytest.fixture
def documents(spark):
    """Documents from ``(doc_id, text)`` or longer rows, with columns that no operator asks for."""

    def make(rows, extra=True):
        full = [(*r, *[None] * (4 - len(r)))[:4] for r in rows]
        frame = spark.createDataFrame([(*r, None if r[1] is None else len(r[1])) for r in full], COLUMNS)
        if extra:  # names that operators use inside
            frame = frame.selectExpr("*", "1 AS size", "'x' AS node", "2 AS part", "0.5D AS score", "'k' AS keys", *CLASHES)
        return frame

    return make


#: Further names that operators use inside, also one that is no plain identifier.
CLASHES = [f"{i} AS `{c}`" for i, c in enumerate(("id", "_id", "_guess", "n", "key", "rank", "row", "copies", "a.b", "h1", "n_lines"))]

#: NULLs in any column, empty texts, repeated rows, a repeated id with another text, odd characters.
ODD = [
    (1, None, None, None),
    (2, "", "en", "a"),
    (3, " \t\n ", "en", None),
    (4, "one two three", "en", "a"),
    (4, "one two three", "en", "a"),
    (4, "another text under the same id", "de", "b"),
    (None, "a text without an id, a text without an id", None, "b"),
    (5, "é中\U0001f600 ﻿<|endoftext|> 12345 !!", "fr", "c"),
    (6, "word " * 3000, "en", "c"),
]
