"""Small tables with the cases every operator must survive."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])
# columns whose names operators use themselves
CLASHING = ["digest", "bands", "rep", "comp", "node", "key", "block", "row", "file", "label", "n", "word", "recipe", "score", "kept", "_gone", "host", "y", "id"]


def docs_frame(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, DOCS)


def with_clashes(df: DataFrame) -> DataFrame:
    from pyspark.sql import functions as F

    return df.select("*", *(F.lit("x").alias(c) for c in CLASHING if c not in df.columns))


def prose(rng: random.Random, n: int, words: int = 400) -> str:
    vocab = [f"{a}{b}" for a in ("ba", "co", "di", "fu", "ga", "le", "mo", "nu", "pi", "ra") for b in ("n", "rt", "st", "l", "m", "ck", "sh", "ng")]
    return " ".join(rng.choice(vocab) + (rng.choice(vocab) if rng.random() < 0.4 else "") for _ in range(n))


EDGES = [
    (1, None), (2, ""), (3, " \t\n "), (None, "no id here at all, but words"), (None, None), (4, "one"), (5, "one"), (5, "one"),
    (6, "naïve café – 日本語 text 👩‍👧 with\x00control\x1c and spaces"), (7, "Ab " * 3000), (8, "x" * 70_000), (9, "###!!!"),
]
