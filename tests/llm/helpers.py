"""Small documents tables with the cases that every operator must stand."""

EDGE = [
    (1, None, "x"),
    (2, "", "x"),
    (3, "   \n\t ", "x"),
    (4, "one", "x"),
    (5, "one", "x"),
    (5, "one", "x"),
    (None, "one two three", "x"),
    (6, "word " * 3000, "y"),
    (7, "\x00 nul   and \U0001f600 emoji ÄÖ", "y"),
]


def edge(spark, rows=EDGE):
    """doc_id, text and columns with clashing names."""
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    return df.selectExpr("doc_id", "text", "source", "1 AS slot", "'w' AS w", "2.5D AS fp", "doc_id AS id", "'n' AS n_words")


def empty(spark):
    return edge(spark).filter("false")
