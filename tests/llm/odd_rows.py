"""Rows that every operator must handle: nulls, empty and long texts, ties, repeated rows, clashing names."""

from __future__ import annotations

LONG = " ".join(f"word{i % 977}x{i % 31}" for i in range(30_000))
PASSAGE = "the quick brown fox jumps over a lazy dog while seven wise owls watch from the old oak near our quiet river"
DOCS = [
    (1, PASSAGE, "en", "s", 1, "a", 5.0),
    (2, PASSAGE.upper() + "!", "en", "s", 1, "b", 5.0),
    (3, PASSAGE + " today", "en", None, None, "c", None),
    (4, None, None, None, None, None, None),
    (5, "", "en", "s", 0, "", 0.0),
    (6, " \t\n", "fr", "s", 3, "x", 1.0),
    (7, "12345 !!! 678", None, "s", 9, "x", 1.0),
    (8, LONG, "en", "s", 1, "x", 1.0),
    (8, LONG, "en", "s", 1, "x", 1.0),
    (9, "été à la plage, où l'eau est bleue et le sable est chaud pendant toute la belle saison", "fr", "s", 1, "x", 1.0),
    (10, "漢字かな交じり文 <|endoftext|> 🙂 \x1c ½ Ⅷ don't", "de", "s", 1, "x", 1.0),
    (None, "a row without an id", "en", "s", 1, "x", 1.0),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, lang_pred string, score double"


def odd_docs(spark):
    return spark.createDataFrame(DOCS, SCHEMA)


def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
