"""Small document tables with the awkward cases every operator has to take."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
# Names that the operators use inside.
CLASHES = ["_row", "key", "kept", "toxic", "severity", "digest", "tokens", "place", "block", "epoch", "node", "root", "length", "row", "pack"]


def words(seed: int, n: int) -> str:
    own = random.Random(seed)
    return " ".join("".join(own.choice("abcdefghij") for _ in range(own.randint(2, 9))) for _ in range(n))


def stored_docs(spark: SparkSession, path, rows: list[tuple], clashes: bool = False, parts: int = 3) -> DataFrame:
    df = spark.createDataFrame(rows, DOCS)
    if clashes:
        for name in CLASHES:
            df = df.withColumn(name, df.source)
    df.repartition(parts).write.parquet(str(path))
    return spark.read.parquet(str(path))


def awkward() -> list[tuple]:
    base = words(1, 60)
    return [
        (5, base, "en", "a", 1),
        (3, base.replace(" ", "\t \n"), "en", "a", 1),
        (3, base, "en", "a", 1),
        (9, base, None, None, None),
        (None, base, "en", "b", 1),
        (7, None, "en", "b", 0),
        (8, "", "en", "b", 0),
        (10, " ", "en", "b", 0),
        (11, words(2, 5_000), "fr", "c", 1),
        (12, words(2, 5_000) + " more", "fr", "c", 1),
        (13, "one two", "fr", "c", 1),
        (14, "one two", "fr", "c", 1),
        (None, None, None, None, None),
        (15, "x" * 50_000, "de", "c", 1),
        (16, "É😀 ퟿ ﬁ", "de", "d", 1),
        (16, "É😀 ퟿ ﬁ", "de", "d", 1),
    ]
