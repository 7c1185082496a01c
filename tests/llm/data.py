"""Small documents with everything that may go wrong in a real table."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

#: Columns that operators use inside or return; here they are just more columns.
CLASHES = (
    "id", "fp", "fingerprint", "component_id", "score", "predicted", "lang_pred", "held_out",
    "kept", "n_words", "n_removed", "doc", "row", "mark", "part", "piece", "start", "length",
    "sequence_id", "offset", "labels", "ids", "decoded", "edge", "alone", "place",
)
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(
    f"{c} string" for c in CLASHES
)


def words(seed: int, n: int, vocabulary: int = 400) -> str:
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(vocabulary):x}" for _ in range(n))


def texts() -> list[tuple[int | None, str | None]]:
    base = words(1, 200)
    near = base.replace("w1", "v1", 1)
    passage = words(2, 60)
    return [
        (1, base),
        (2, base),
        (2, base),
        (3, near),
        (4, None),
        (5, ""),
        (6, "   \t\n "),
        (7, "one"),
        (8, "12 34 .. !!"),
        (9, words(3, 50) + " " + passage + " " + words(4, 20)),
        (10, passage),
        (11, "a " * 300),
        (12, words(5, 60_000, 5000)),
        (13, "x" * 50_000),
        (14, "é日本語 ñ <|endoftext|> It's  naïve,\r\n\x1c don't 🙂 ok"),
        (15, "Licensed under the MIT License. gnu general public license"),
        (None, words(6, 80)),
        (None, None),
        (-5, "The The the the THE."),
        (16, "und der die das ist nicht " * 30),
    ]


def edge_docs(spark: SparkSession) -> DataFrame:
    rows = [
        (i, t, None if k % 3 == 0 else "en", None if k % 4 == 0 else "s", k, *["c"] * len(CLASHES))
        for k, (i, t) in enumerate(texts())
    ]
    return spark.createDataFrame(rows, SCHEMA).repartition(4)


def empty_docs(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)
