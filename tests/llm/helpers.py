"""Inputs that every operator has to stand, and plain versions to compare with."""

from __future__ import annotations

LONG = "lorem ipsum dolor sit amet " * 20_000

#: id, text: null id, null and empty text, one word, very long, repeated rows, odd characters.
ODD = [
    (1, "Some plain text, with words."), (1, "Some plain text, with words."), (2, None), (3, ""), (4, "one"), (None, "no id here"),
    (5, LONG), (6, "\n\t  \r\n"), (7, "é ß Σς İ 日本語 🙂 \x00 \x1c x"), (8, "it's we'll 's <|endoftext|> 12²Ⅷ\u2003y"), (9, "Some plain text, with words."),
]


def frame(spark, rows, schema="doc_id long, text string"):
    return spark.createDataFrame(rows, schema)


def clashing(docs):
    """Further columns with names that operators use themselves."""
    from pyspark.sql import functions as F

    names = ["features", "score", "row", "node", "key", "label", "ids", "shift", "_min", "hash", "block", "range", "_row_id", "_contaminated"]
    return docs.withColumns({name: F.lit("x") for name in names})
