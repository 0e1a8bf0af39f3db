"""Documents for the tests of this folder."""

import random

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"

WORDS = "the of and tion er an in on re at en ha ing nd to ea st or es is it ou ed the ti hi".split()


def prose(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choice(WORDS) for _ in range(rng.randint(1, 3))) for _ in range(n))


def documents(spark, rows):
    """Documents from (doc_id, text) or (doc_id, text, source)."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
    return spark.createDataFrame(full, COLUMNS)


#: Rows that every operator has to stand: nulls, empty and blank texts, repeated rows, one long text.
ODD = [
    (1, None),
    (2, ""),
    (3, " \n\t"),
    (4, "one"),
    (4, "one"),
    (5, "One"),
    (None, "lost and found again today"),
    (6, "long " * 30_000),
    (7, "ß é 中文 \U0001f642 Σ İ"),
]
