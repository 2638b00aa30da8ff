"""Small tables with every awkward row, and checks that hold for each operator."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

LONG = "Start of a long text. " + " ".join(f"word{i % 977}" for i in range(60_000)) + " end"

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # names that operators use for results or inside
        *[
            T.StructField(name, T.StringType())
            for name in (
                "n_tokens", "kept", "piece", "start", "length", "size", "digest", "copy",
                "spans", "score", "value", "component_id", "shard", "_row", "in0", "_text.x",
            )
        ],
    ]
)
CLASH = tuple("x" for _ in SCHEMA.fields[5:])


def prose(seed: int, words: int) -> str:
    rng = random.Random(seed)
    syllables = ["ta", "ren", "mo", "lis", "un", "ve", "kor", "sha", "pi", "dra"]
    made = ["".join(rng.choices(syllables, k=rng.randint(1, 4))) for _ in range(words)]
    return " ".join(w + ("\n" if i % 17 == 16 else "") for i, w in enumerate(made))


def rows() -> list[tuple]:
    one = prose(1, 90)
    near = one.replace("ta", "ta", 1) + " tail"
    texts = [
        (0, one, "a"),
        (1, one, "b"),  # a copy under another id
        (2, near, "a"),
        (3, None, "a"),
        (4, "", None),
        (5, " \t\n ", "b"),
        (6, LONG, "c"),
        (7, "naïve façade – 日本語 “quoted” text\nnaïve", "c"),
        (8, prose(2, 120), None),
        (8, prose(2, 120), None),  # a repeated row
        (9, prose(3, 70), "b"),
        (9, prose(4, 70), "b"),  # a repeated id with another text
        (None, prose(5, 60), "a"),
        (None, None, None),
        (-3, "short one", "b"),
    ]
    return [(i, t, "en", s, len(t) if t is not None else None, *CLASH) for i, t, s in texts]


def docs(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(rows(), SCHEMA).repartition(3)


def empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)
