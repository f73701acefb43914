"""Awkward rows that every operator on documents must take."""

from pyspark.sql import types as T

#: The columns of documents, and columns whose names operators use inside.
SCHEMA = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())]
    + [T.StructField(n, T.StringType()) for n in ("f", "k", "w", "h", "row", "score", "digest", "__gone", "component_id", "item_id", "quality")]
)
LONG = "word " * 60_000 + "end"
ROWS = [
    (1, "The cat sat on the mat and then it ran away over the hill to the old house by the sea.", "en", "a", 1),
    (2, "The cat sat on the mat and then it ran away over the hill to the old house by the sea.", "en", "a", 1),
    (2, "The cat sat on the mat and then it ran away over the hill to the old house by the sea.", "en", "a", 1),
    (3, None, "en", "a", None),
    (4, "", None, None, 0),
    (5, "   \n\t ", "de", "b", 5),
    (None, "A text without an id, and with a few words.", "de", None, None),
    (None, "Another text without an id, and with a few words.", None, "b", None),
    (6, LONG, "fr", "b", len(LONG)),
    (7, "x" * 100_000, "fr", "b", 100_000),
    (8, "Ünïcödé \U0001f600 é Σ   \x85 end", "de", "b", 1),
    (9, "12345", None, "b", 5),
]


def documents(spark, rows=None):
    return spark.createDataFrame([(*r, *["clash"] * (len(SCHEMA) - len(r))) for r in (ROWS if rows is None else rows)], SCHEMA)


def ids(rows):
    return sorted((r["doc_id"] for r in rows), key=lambda x: (x is None, x))


ALL_IDS = sorted((r[0] for r in ROWS), key=lambda x: (x is None, x))
