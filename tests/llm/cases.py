"""Inputs that every operator must take: nulls, blanks, repeats, long texts, clashing columns."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns named like columns that operators make themselves.
CLASHING = "id long, tk long, size int, key string, hashes string, component_id long, words string, grade string, file string"


def prose(rng: random.Random, n: int, vocabulary: int = 400) -> str:
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def rows() -> list[tuple]:
    rng = random.Random(3)
    base = prose(rng, 120)
    words = base.split()
    near = words[:]
    near[60] = "changed"
    long = prose(rng, 30_000, 3000)
    out = [(1, base), (2, base), (2, base), (3, " ".join(near)), (4, None), (5, ""), (6, " \t\n\x0b\x0c\r "),
           (7, "one"), (8, "two words"), (9, "two words"), (10, long), (11, long[:100_000] + " tail"),
           (None, base), (None, None), (12, prose(rng, 60)), (13, "Ünï çödé 😀 " * 30), (14, "x" * 50_000),
           (15, " ".join(words[:40] + prose(rng, 30).split() + words[40:80])), (16, " ".join(["same"] * 100)),
           (17, " ".join(words[:30]) + " " + " ".join(words[30:])), (18, prose(rng, 200)), (19, prose(rng, 19)),
           (-5, prose(rng, 21)), (2 ** 40, base.upper())]
    return [(i, t, None if i == 12 else "en", None if i == 7 else "src0", None if t is None or i == 8 else len(t)) for i, t in out]


def documents(spark: SparkSession) -> DataFrame:
    n = len(CLASHING.split(", "))
    return spark.createDataFrame([(*r, *[None] * n) for r in rows()], f"{SCHEMA}, {CLASHING}").repartition(3)


def nothing(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], f"{SCHEMA}, {CLASHING}")


def lower(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
