"""Awkward documents all operators must take."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(n: int, seed: int) -> str:
    r = random.Random(seed)
    parts = "ka lo mi tur ven sa po rel nim gar dus fe".split()
    return " ".join("".join(r.choice(parts) for _ in range(r.randint(1, 4))) for _ in range(n))


PASSAGE = words(60, 1)
ROWS = [
    (1, words(80, 2) + "\n" + PASSAGE + "\n" + words(30, 3), "en", "a"),
    (2, words(70, 4) + "\n" + PASSAGE, "en", "a"),
    (3, words(90, 5), "de", "b"),
    (4, words(90, 5), "de", "b"),  # an exact copy
    (4, words(90, 5), "de", "b"),  # a repeated row
    (4, words(55, 6), "de", "b"),  # a doc_id with another text
    (5, None, "en", "a"),
    (6, "", None, "a"),
    (7, "   \n\t ", "fr", None),
    (8, "!!! 123 ...", "fr", "c"),
    (None, words(60, 7) + " mail me@host.example.org now", None, "c"),
    (None, None, None, None),
    (9, "long " + words(30_000, 8), "es", "c"),
    (10, "x" * 5000, "es", "c"),
    (11, "é€😀 " * 100 + "ñandú", "es", "c"),
]


def documents(spark, rows=ROWS):
    return spark.createDataFrame([(*r, len(r[1]) if r[1] is not None else None) for r in rows], SCHEMA)


def clashing(df):
    """With extra columns named like those that operators use inside."""
    names = ["key", "_key", "bits", "part", "kind", "kept", "n_words", "copy", "mix_key", "_source", "rate", "bucket",
             "starts", "base", "terms", "_rest", "root", "probability", "held_out", "class", "odd `name`"]
    for i, name in enumerate(names):
        df = df.withColumn(name, df["doc_id"] * 0 + i)
    return df


def rows(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)
