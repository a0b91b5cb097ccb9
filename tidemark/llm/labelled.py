"""Bounded samples of labelled documents for fitting classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from tidemark.llm.common import text_or_empty
from tidemark.session import materialize

# Bytes of text that a sample holds at most, half of them for each label.
SAMPLE_BYTES = 64 << 20


def fold(doc_id: str | Column, folds: int) -> Column:
    """crc32 of the id as text, modulo the number of folds; null counts as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % folds


def sample(
    docs: DataFrame, labels: DataFrame, label: str, rows: int, folds: int, held_out: int
) -> tuple[DataFrame, float]:
    """Labelled texts outside the held-out fold, and the share of label 1 among them all.

    Takes at most `rows` labelled ids, half of each label where there are as many,
    chosen by hash, and of these, in the same order, those whose texts fit into
    SAMPLE_BYTES (the shortest of a label if none does). An id that repeats counts
    with one row, that of the smallest digest. Ids with a null label, or with both
    labels, teach nothing. Columns: doc_id, label, text.
    """
    known = (
        labels.select(F.col("doc_id").cast("long"), F.col(label).alias("label"))
        .filter(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull())
        .filter(fold("doc_id", folds) != held_out)
        .groupBy("doc_id")
        .agg(F.min("label").alias("label"), F.max("label").alias("most"))
        .filter("label = most")
        .select("doc_id", "label")
    )
    counts = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    ones, zeros = counts.get(1, 0), counts.get(0, 0)
    few = min(ones, zeros, rows // 2)
    take = {1: min(ones, rows - few), 0: min(zeros, rows - few)}
    chosen = None
    for value, size in take.items():
        part = known.filter(F.col("label") == value).orderBy(F.xxhash64("doc_id")).limit(size)
        chosen = part if chosen is None else chosen.unionByName(part)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty("text").alias("text"))
    # At most `rows` ids of 8 bytes are sent to the executors.
    # Combined before the shuffle, so that rows of one id do not travel.
    once = materialize(
        texts.join(F.broadcast(chosen), "doc_id")
        .groupBy("doc_id", "label")
        .agg(F.min_by("text", F.sha2("text", 256)).alias("text")),
        "labelled",
    )
    sizes = once.select("doc_id", "label", F.octet_length("text").alias("size")).orderBy(
        F.xxhash64("doc_id"), "doc_id"
    )
    fitting = [i for ids in _fitting(sizes.collect()).values() for i in ids]
    found = once.join(
        F.broadcast(docs.sparkSession.createDataFrame([(i,) for i in fitting], "doc_id long")), "doc_id"
    )
    return found, (ones / (ones + zeros) if ones + zeros else 0.5)


def _fitting(rows: list[Row]) -> dict[int, list[int]]:
    """Ids per label whose texts fit into its half of SAMPLE_BYTES, in the order given."""
    out: dict[int, list[int]] = {}
    for value in {r["label"] for r in rows}:
        own, left = [r for r in rows if r["label"] == value], SAMPLE_BYTES // 2
        out[value] = []
        for r in own:
            if r["size"] <= left:
                out[value].append(r["doc_id"])
                left -= r["size"]
        if not out[value]:
            out[value] = [min(own, key=lambda r: r["size"])["doc_id"]]
    return out
