"""Small tables with the awkward rows that every operator has to stand."""

from __future__ import annotations

LONG = "wandering otters gather pebbles near silver rivers while quiet herons watch " * 3000

ROWS = [
    (1, "Quiet harbour lights drift over the morning water and the boats.", "en", "a", 5),
    (1, "Quiet harbour lights drift over the morning water and the boats.", "en", "a", 5),
    (2, "", "en", "a", 0),
    (3, None, None, None, None),
    (None, "Le petit chat dort sur la grande chaise rouge du salon.", "fr", "b", 9),
    (4, "12 345 -- 678 !!", "fr", "b", 9),
    (5, LONG, "en", "a", 1),
    (6, " \t\n ", "de", None, 3),
    (7, "ÄÖÜ straße über die Brücke, Σίσυφος και 東京 🙂", None, "c", 7),
    (8, "<|endoftext|> it's they'll 'd A B\x1cC é ́x", "en", "c", 2),
]

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, extra: bool = False):
    """The awkward documents; with ``extra``, columns whose names operators use too."""
    df = spark.createDataFrame(ROWS, SCHEMA)
    if extra:
        for name in ("score", "value", "fingerprint", "component", "key", "held_out", "task",
                     "sequence_id", "hits", "items", "a", "b", "c", "token", "place"):
            df = df.selectExpr("*", f"'x' as {name}")
    return df


def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
