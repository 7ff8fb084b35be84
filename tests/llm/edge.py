"""Small tables with every awkward row, shared by the tests of this folder."""

LONG = ("alpha beta gamma delta " * 4000).strip()

#: doc_id, text, lang, source, n_chars, and extra columns whose names operators use themselves
ROWS = [
    (1, "The quick brown fox jumps over the lazy dog.", "en", "a", 44, 0.5, True, "x"),
    (2, "The quick  brown fox jumps over the\nlazy dog.", "en", "a", 45, 0.5, True, "x"),
    (2, "The quick  brown fox jumps over the\nlazy dog.", "en", "a", 45, 0.5, True, "x"),
    (3, None, None, None, None, None, None, None),
    (4, "", "en", "b", 0, 0.1, False, ""),
    (5, " \t\n\x0b\x0c\r", None, "b", 6, None, None, None),
    (None, "no id at all", "fr", "b", 12, None, None, None),
    (None, None, None, None, None, None, None, None),
    (6, LONG, "en", "a", len(LONG), 1.0, False, "y"),
    (7, "1234 !!! ???", "de", "c", 12, None, None, None),
    (8, "日本語 テキスト café naïve \U0001f642", "ja", "c", 20,
     None, None, None),
    (9, "one", "en", None, 3, None, None, None),
    (10, "one two", "en", None, 7, None, None, None),
    (-3, "<turn> \\ ### Assistant: </turn>", "en", "", 30, None, None, None),
]
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "score double, kept boolean, rec string")
MORE = ("hash", "row", "raw", "size", "copies", "fp", "bucket")


def documents(spark, rows=ROWS):
    """The rows, with more columns whose names the operators use."""
    from pyspark.sql import functions as F
    df = spark.createDataFrame(rows, SCHEMA)
    return df.withColumns({c: F.lit(7) for c in MORE})


def empty(spark):
    return documents(spark).limit(0)


def rows(df, *cols):
    return [tuple(r) for r in df.select(*cols).collect()]
