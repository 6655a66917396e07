import random

import pytest
from pyspark.sql import types as T

SYLLABLES = [a + b for a in ("th", "n", "r", "st", "l", "m", "d", "k", "br", "s") for b in ("e", "a", "o", "ing", "er", "is")]


def prose(seed, n, extra=()):
    """Made-up words, with some of ``extra`` strewn in."""
    rng = random.Random(seed)
    words = ["".join(rng.choices(SYLLABLES, k=rng.randint(1, 4))) for _ in range(n)]
    for word in extra:
        words[rng.randrange(n)] = word
    return " ".join(words)


#: Columns whose names the operators also use.
CLASHES = ["size", "score", "fp", "block", "_text", "kept", "row"]


@pytest.fixture(scope="session")
def make(spark):
    """Documents from (id, text) pairs, with clashing extra columns."""
    fields = [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())]
    fields += [T.StructField(c, T.StringType()) for c in CLASHES]

    def documents(pairs):
        return spark.createDataFrame([(i, t, *CLASHES) for i, t in pairs], T.StructType(fields))

    return documents


@pytest.fixture(scope="session")
def awkward():
    """Null and empty texts, blanks only, a very long one, ties, repeated rows, a null id, odd letters."""
    body = prose(1, 120)
    return [
        (1, None),
        (2, ""),
        (3, " \t\n\x0b\x0c\r "),
        (4, prose(2, 40_000)),
        (5, body),
        (6, body),
        (7, body),
        (7, body),
        (8, body + " more"),
        (None, prose(3, 60)),
        (None, None),
        (9, "Ünïcode     ß İ 日本語 🙂 é \x1c \x85 x"),
        (10, "one two three"),
        (11, "a b c\na b c\na b c\n\n \nx # * $ % & | < >"),
        (12, "<|endoftext|> <|startoftext|> <|im_end|> it's WE'LL"),
        (13, "x" * 5000),
        (14, "again " * 400),
    ]
