"""Small tables with the awkward cases, and exact comparisons."""

import os

import duckdb

SF_DIR = "/root/testdata/sf0.001"
HAVE_TABLES = os.path.isdir(SF_DIR)

#: Nulls, empty and long texts, ties, repeated rows; the extra columns clash with names the operators use.
ODD_TEXTS = [
    (1, "", "en"),
    (2, None, "de"),
    (3, "one two three four five six seven eight", "en"),
    (3, "one two three four five six seven eight", "en"),
    (4, "ONE two three\tfour five six\nseven eight", None),
    (5, "12345 !!! ...", "fr"),
    (6, "é\U0001f600 日本語 <|endoftext|> Ünïcode \u0000 end.", "fr"),
    (7, "word " * 30_000, "en"),
    (8, "x" * 200_000, "en"),
    (None, "a row without an id", "en"),
    (None, None, None),
]
CLASHING = "'s' AS score, 1 AS ids, 2 AS sequence_id, 3 AS bucket, 4 AS id, 5 AS terms, 6 AS key, 7 AS text_key"


def odd_documents(spark, rows=None):
    rows = ODD_TEXTS if rows is None else rows
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    return frame.selectExpr("*", "'src' AS source", "cast(length(text) AS bigint) AS n_chars", *CLASHING.split(", "))


def duck_rows(sql, **frames):
    con = duckdb.connect()
    for name, frame in frames.items():
        con.register(name, frame)
    return con.execute(sql).fetchall()
