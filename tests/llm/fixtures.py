"""Awkward documents: nulls, empty and long texts, ties, repeated rows, clashing column names."""

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, __t string, key string, n long, score string"
LONG = "lorem ipsum dolor sit amet consectetur " * 5000
TEXTS = [
    (1, "one two three four five six seven"),
    (2, "one  two\tthree\nfour five six seven"),
    (3, "one two three four five six eight"),
    (4, None),
    (5, ""),
    (6, " \n "),
    (7, LONG),
    (8, LONG),
    (8, LONG),
    (None, "one two three four five six seven"),
    (None, None),
    (9, "x"),
    (10, "Ünïcödé 日本語 🎉 All rights reserved. a.b@c.org +1 234 567 8901 10.0.0.1 4111 1111 1111 1111"),
    (11, "<|endoftext|> it's <|startoftext|> 42 ΣΑΣ"),
]


def docs(spark, rows=None):
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), "k", "t", "key", 1, "s") for i, t in (TEXTS if rows is None else rows)], SCHEMA)
