"""Small tables with the awkward rows that every operator must take."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Extra columns with names that operators use inside.
CLASHING = ["row", "digest", "_digest", "_copy", "_hit", "node", "key", "tag", "words", "spans",
            "label", "score", "piece", "start", "sequence_id", "offset", "ids", "group_size"]

LONG = " ".join(f"w{i % 977}x{i % 13}" for i in range(30_000))

TEXTS = [
    (1, "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi"),
    (2, "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi"),
    (2, "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi"),
    (3, None),
    (4, ""),
    (5, "one"),
    (6, LONG),
    (None, "a text without an id, and with É and 　 spaces  "),
    (None, None),
    (7, "\n\n  \t "),
    (2, "another text under an id that is taken"),
    (8, "x" * 70_000),
    (9, "<|im_end|> <|endoftext|> \x01 control"),
]


def documents(spark: SparkSession, texts=TEXTS) -> DataFrame:
    columns = ["doc_id long", "text string", "lang string", "source string", "n_chars long"]
    columns += [f"`{c}` string" for c in CLASHING]
    extra = ["extra"] * len(CLASHING)
    rows = [(i, t, None, "s", None if t is None else len(t), *extra) for i, t in texts]
    return spark.createDataFrame(rows, ", ".join(columns)).repartition(3)


def labels(spark: SparkSession, rows=None) -> DataFrame:
    rows = [(1, 1, 0), (2, 0, 1), (5, None, None), (None, 1, 1)] if rows is None else rows
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def benchmark(spark: SparkSession, rows=None) -> DataFrame:
    if rows is None:
        rows = [
            (10, "beta gamma delta epsilon zeta eta theta iota kappa lambda mu"),
            (9, "ONE"),
            (10, "one"),
            (11, None),
            (12, ""),
            (13, "never seen words in here"),
        ]
    return spark.createDataFrame(rows, "item_id long, text string")
