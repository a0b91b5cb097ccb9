"""Exact duplicates with frequent texts split off.

Each text becomes a SHA-256 digest. A Misra-Gries summary (Spark's mergeable
frequent-items sketch) names every digest above a fixed share of the rows;
their exact counts and winners come from one combined aggregate, are few by
construction and are broadcast, so that rows of frequent texts never travel.
All other digests, none of which can hold more than that share, are settled by
an ordinary shuffle.

Defined results: a null text counts as empty, and empty texts equal each other.
Of equal texts the row with the largest id stays; a null id is smaller than any
other; of rows that repeat both id and text, one stays. Extra columns, whatever
their names, are neither read nor changed. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import keep_rows, text_or_empty
from tidemark.session import materialize

# Counters of the summary. Its error is at most 3.5 / SUMMARY_ITEMS of the rows,
# so a digest with more than 0.2 % of all rows is always named.
SUMMARY_ITEMS = 2048
# Digests that are broadcast at most: no more can have 0.2 % of the rows each.
FREQUENT_MAX = 512
SUMMARIES = 1024


def frequent_digests(rows: DataFrame, digest: str) -> DataFrame:
    """Candidates of the summary, at most FREQUENT_MAX digests.

    At most SUMMARIES tasks send a summary each to the one that merges them.
    """
    summary = rows.coalesce(SUMMARIES).agg(
        F.expr(f"approx_top_k({digest}, {FREQUENT_MAX}, {SUMMARY_ITEMS})").alias("top")
    )
    return summary.select(F.explode("top").alias("top")).select(F.col("top.item").alias(digest))


def assign(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256."""
    rows = materialize(
        docs.select(
            F.col(id_col).alias("doc_id"),
            F.sha2(text_or_empty(text_col), 256).alias("text_sha256"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "digests",
    )
    winner = F.max(F.struct("doc_id", "row")).alias("winner")
    size = F.count(F.lit(1)).alias("group_size")
    candidates = frequent_digests(rows, "text_sha256")
    winners = materialize(
        rows.join(F.broadcast(candidates), "text_sha256", "left_semi")
        .groupBy("text_sha256")
        .agg(winner, size)
        .filter("group_size > 1"),
        "winners",
    )
    frequent = rows.join(F.broadcast(winners), "text_sha256")
    group = Window.partitionBy("text_sha256")
    rest = (
        rows.join(F.broadcast(winners.select("text_sha256")), "text_sha256", "left_anti")
        .withColumn("winner", F.max(F.struct("doc_id", "row")).over(group))
        .withColumn("group_size", F.count(F.lit(1)).over(group))
    )
    return frequent.unionByName(rest).select(
        "doc_id",
        F.col("winner.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("winner.row")).alias("kept"),
        "text_sha256",
    )


def deduplicate(docs: DataFrame) -> DataFrame:
    """The rows that stay, with all their columns."""
    return keep_rows(docs, assign(docs).withColumnRenamed("text_sha256", "digest"))
