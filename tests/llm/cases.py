"""Rows that every text operator must bear: nulls, empty and very long texts, ties, repeated rows."""

LONG = " ".join(f"word{i % 977} rest{i % 31}," for i in range(40_000))
TEXTS = [None, "", "  \n\t ", "a", "One two three.", "One two three.", "12 34 56", "éèê ÀÉ ß 日本 🎉", "a  b\n\n c \x1c d\x00",
         "x" * 5000, "The same line\n" * 30, LONG]
SCHEMA = "doc_id long, text string, extra int, language string, rules string, n_bytes string, pieces int, held int, masked int"


def rows(spark):
    """Ids with a null, a repeated id and a repeated row; columns that clash with results' names."""
    data = [(i, t, None if i % 3 else i, "x", None, "y", 1, 2, 3) for i, t in enumerate(TEXTS)]
    data += [data[4], (3, "b", 0, None, None, None, None, None, None), (None, "One two three.", 1, "", "", "", 0, 0, 0)]
    return spark.createDataFrame(data, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
