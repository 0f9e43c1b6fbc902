"""Rows that every operator must take: nulls, empty, ties, clashing columns."""

LONG = " ".join(f"w{i % 977}" for i in range(60_000))

ROWS = [
    (1, None),
    (2, ""),
    (3, " \n\t "),
    (4, "one"),
    (5, "one two"),
    (6, "Straße und Öl. " * 30),
    (7, "Straße und Öl. " * 30),
    (7, "Straße und Öl. " * 30),  # a repeated row
    (None, "no id here, only some words that stand in no other text at all"),
    (8, LONG),
    (9, LONG + " end"),
    (10, "\U0001f600 日本語 text with signs <|endoftext|> and 'tis, don't"),
]


def frame(spark, rows=None, extra=True):
    """documents with columns that clash with names the operators use."""
    rows = ROWS if rows is None else rows
    if not extra:
        return spark.createDataFrame(rows, "doc_id long, text string")
    names = "chunk string, kept string, range string, id string, n_words string, score string, text_2 string"
    wide = [(d, t, "en", "src0", len(t or ""), *(["x"] * 7)) for d, t in rows]
    return spark.createDataFrame(wide, f"doc_id long, text string, lang string, source string, n_chars long, {names}")
