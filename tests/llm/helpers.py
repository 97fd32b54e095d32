"""Small tables with every awkward row: nulls, empty and long texts, ties, repeats, clashing columns."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# Extra columns with the names that the operators use inside or return.
CLASHING = "size long, rank int, fp long, spans string, score double, shard int, src int, _id string, start long"


def documents(spark: SparkSession, rows, clashing: bool = False) -> DataFrame:
    """rows: (doc_id, text[, source])."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
    if not clashing:
        return spark.createDataFrame(full, SCHEMA)
    return spark.createDataFrame([(*r, *[None] * 9) for r in full], f"{SCHEMA}, {CLASHING}")


def prose(rng: random.Random, words: int, vocabulary: int = 3000) -> str:
    return " ".join(f"w{rng.randrange(vocabulary):x}" for _ in range(words))


def awkward(rng: random.Random) -> list[tuple]:
    """Null id, null and empty texts, blanks only, a very long text, repeated rows, a hot source."""
    rows = [(None, "a null id here", "s"), (1, None, "s"), (2, "", None), (3, " \t\n ", "s"), (4, "One", "t")]
    rows += [(5, prose(rng, 20_000), "s"), (6, "Ünïcode wörds", "é"), (7, "same text twice", "s")]
    rows += [(7, "same text twice", "s")] * 2 + [(8, "same text twice", "t")]
    return rows + [(100 + k, prose(rng, rng.randrange(1, 80)), rng.choice(["s", "s", "t", "u"])) for k in range(60)]


def rows_of(df: DataFrame, *names: str) -> list[tuple]:
    names = names or tuple(df.columns)
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)
