"""Small tables with every awkward row, and plain versions of the operators to hold results against."""

from __future__ import annotations

import random
import re

from pyspark.sql import DataFrame, SparkSession

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LOWER = {c: c + 32 for c in range(65, 91)}
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text: str | None) -> list[str]:
    return WORD.findall((text or "").translate(LOWER))


def prose(rng: random.Random, n: int, size: int = 400) -> str:
    vocabulary = [f"w{i}x" for i in range(size)]
    return " ".join(rng.choice(vocabulary) for _ in range(n))


def awkward_rows() -> list[tuple]:
    """Nulls in any column, empty and very long texts, repeated rows, ties, other alphabets, odd white space."""
    rng = random.Random(5)
    base = prose(rng, 120)
    rows: list[tuple] = [
        (0, None, "en", "a", None),
        (1, "", None, "a", 0),
        (2, " \t\n\x0b\r ", "en", None, 6),
        (3, "One", "en", "b", 3),
        (4, "one two", "en", "b", 7),
        (None, "no id here at all", "en", "b", 17),
        (5, "naïve ÜBER straße İstanbul 日本語 テスト x y\x1cz", "de", "c", 30),
        (6, "x" * 30_000, "en", "a", 30_000),
        (7, prose(rng, 12_000), "en", "a", None),
        (8, base, "en", "a", len(base)),
        (9, base, "en", "b", len(base)),
        (9, base, "en", "b", len(base)),
        (10, base.upper(), "en", "b", len(base)),
        (11, base.replace("w1x", "w2x", 1), "en", "c", None),
    ]
    rows += [(20 + i, f"shared line\nonly {i} here\n\n  Shared LINE \nlast{i % 3}", "en", "abc"[i % 3], None) for i in range(14)]
    rows += [(50 + i, prose(rng, rng.randint(5, 300)), rng.choice(["en", "de", "fr", "es", "xx"]), rng.choice("aaab"), None) for i in range(60)]
    return rows


def awkward(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(awkward_rows(), DOCS).repartition(3)


def clashing(spark: SparkSession, *names: str) -> DataFrame:
    """The awkward rows with extra columns of the operators' own names."""
    from pyspark.sql import functions as F

    return awkward(spark).withColumns({n: F.lit("mine") for n in names})


def none(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], DOCS)


def labels(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
