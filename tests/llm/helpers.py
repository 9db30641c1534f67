"""Small tables with the cases every operator must take: nulls, empty and long texts, ties, repeats, clashing columns."""

DOCS = "doc_id long, text string, n_tokens string, score string, kept string, task string, length string, id string, part string"

LONG = " ".join(f"wörd{i % 700}" for i in range(9000)) + "\n" * 5

TEXTS = [
    (1, "The quick brown fox. It's 12 o'clock!"), (2, None), (3, ""), (4, "  two  spaces \n and\ttabs  "), (5, LONG),
    (None, "no id here"), (6, "same row"), (6, "same row"), (7, "<|endoftext|> marks <|endoftext|>x"), (8, "ŒUVRE é é 漢字 \U0001f600 ΑΣ　x"),
]


def frame(spark, rows=TEXTS):
    """(doc_id, text) rows with further columns whose names operators use themselves."""
    return spark.createDataFrame([(i, t, *["x"] * 7) for i, t in rows], DOCS)


def empty(spark):
    return spark.createDataFrame([], DOCS)


LABELS = "doc_id long, quality int, toxic int, score string"
