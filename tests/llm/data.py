"""Small document tables with the cases that every operator has to stand."""

import random

from pyspark.sql import functions as F

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def prose(words: int, seed: int) -> str:
    rng = random.Random(seed)
    syllables = ["an", "ti", "on", "re", "th", "ou", "er", "in", "es", "ha", "wh", "st", "nd", "ble"]
    out = []
    for _ in range(words):
        out.append("".join(rng.choice(syllables) for _ in range(rng.randint(1, 5))))
    return " ".join(out)


def rows(texts):
    return [
        (i, t, "en", None if i is None else f"src{i % 3}", None if t is None else len(t)) for i, t in texts
    ]


def table(spark, texts):
    """A documents table of (doc_id, text)."""
    return spark.createDataFrame(rows(texts), DOCUMENTS)


def odd_cases():
    """Nulls, empty, blank, short, accented, very long, repeated rows, repeated ids, no id."""
    long = prose(30_000, 1)
    same = prose(120, 2)
    return [
        (1, None),
        (2, ""),
        (3, " \t\n\r "),
        (4, "one"),
        (5, "Élan naïve façade — 日本語 テキスト ½"),
        (6, long),
        (7, same),
        (7, same),
        (8, same),
        (9, prose(120, 3)),
        (9, prose(130, 4)),
        (None, prose(60, 5)),
        (None, None),
        (10, "a a a a a a a a a a a a a a a a"),
    ]


def with_clashing_columns(df, names):
    """The table with further columns that have the names of an operator's results."""
    return df.withColumns({n: F.lit("x") for n in names})
