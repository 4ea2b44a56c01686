"""Small inputs with every awkward case, and the tables of sf0.001."""

SF = "/root/testdata/sf0.001"
LOREM = "the quick brown fox jumps over the lazy dog and runs to a river of silver water in the north where it rests for the night "


def awkward(spark, extra=True):
    """Nulls in each column, empty and long texts, ties, repeated rows, extra columns with clashing names."""
    rows = [
        (1, LOREM * 3, "en", "a", 3), (2, LOREM * 3, "en", "a", 3), (2, LOREM * 3, "en", "a", 3), (3, "", "en", "a", 0), (4, None, "de", None, None),
        (5, "   \n\t ", None, "b", 5), (6, "one", "en", "b", 3), (7, "ein kurzer Text über Straßen und œuvres \U0001F600", "de", "b", 9),
        (8, LOREM * 400, "en", "c", 1), (9, "x" * 5000, None, "c", 1), (10, "a b " * 300, "en", "c", 1), (None, "no id but text here", "en", "d", 1),
        (11, "line one is here\n" * 30, "fr", "d", 2),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    if extra:  # names that the operators use inside
        for name in ("kid", "tag", "key", "size", "shard", "node", "kind", "gram", "ids", "fp", "_range", "blobs", "n_words"):
            df = df.selectExpr("*", f"1 as `{name}`")
    return df, rows


def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
