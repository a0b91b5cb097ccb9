"""Small helpers that the operators of this package share."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Words as the contracts state them, on UTF-8 bytes: digits, a-z (after
# lower-casing A-Z) and every code point above 127.
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

# Entries that the caches inside a Python worker may hold: ids of text chunks, and
# hashes of words (which then start anew).
CACHE_ENTRIES = 300_000
HASH_ENTRIES = 150_000

# Odd multipliers of the word positions in a shingle: a fixed rule, so that
# every task and every run hashes alike.
_POSITION = np.array(
    [xxhash.xxh3_64_intdigest(b"shingle", seed=j) | 1 for j in range(64)], dtype=np.uint64
)


def on_workers(spark: SparkSession) -> None:
    """Let Python workers find this package where the driver found it.

    Only needed where it is neither installed nor on the workers' own path.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    paths = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in paths.split(os.pathsep):
        joined = os.pathsep.join(x for x in (paths, root) if x)
        spark.sparkContext.environment["PYTHONPATH"] = joined


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def words_of(text: bytes) -> list[bytes]:
    """Words of a text; bytes.lower() changes A-Z alone."""
    return WORD.findall(text.lower())


class WordHashes(dict):
    """64-bit hash per word, computed once per worker and word."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= HASH_ENTRIES:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


def shingles(word_hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of `width` consecutive words (none if there are fewer)."""
    n = len(word_hashes) - width + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    out = word_hashes[:n] * _POSITION[0]
    for j in range(1, width):
        out += word_hashes[j : j + n] * _POSITION[j]
    out ^= out >> np.uint64(31)
    out *= np.uint64(0x9E3779B97F4A7C15)
    out ^= out >> np.uint64(29)
    return out


def column_bytes(array) -> Iterator[bytes]:
    """Values of an Arrow text column as UTF-8 bytes, a few at a time; null is empty."""
    import pyarrow as pa

    for start in range(0, len(array), 256):
        for value in array.slice(start, 256).cast(pa.binary()).to_pylist():
            yield b"" if value is None else value


def free_names(frame: DataFrame, *names: str) -> list[str]:
    """The names, changed where the frame has such a column already."""
    taken = {c.lower() for c in frame.columns}
    out = []
    for name in names:
        while name in taken:
            name += "_"
        taken.add(name)
        out.append(name)
    return out


def keep_rows(docs: DataFrame, verdict: DataFrame) -> DataFrame:
    """The rows of `docs` that stay, with all their columns.

    `verdict` has doc_id, digest (SHA-256 of the text, null as empty) and kept
    for each row. Only the keys that lose rows are joined, so that Spark can
    broadcast them while they are few. Of rows that repeat both id and text,
    and of which one is to stay, any one will do.
    """
    digest, copy, key_id, key_digest, stays = free_names(
        docs, "_digest", "_copy", "_key_id", "_key_digest", "_stays"
    )
    keys = (
        verdict.groupBy("doc_id", "digest")
        .agg(F.max("kept").alias(stays), (F.count(F.lit(1)) > 1).alias("repeats"))
        .filter(f"not {stays} or repeats")
        .select(F.col("doc_id").alias(key_id), F.col("digest").alias(key_digest), stays)
    )
    same = F.col(digest) == F.col(key_digest)
    same &= F.col("doc_id").eqNullSafe(F.col(key_id))
    tagged = docs.withColumn(digest, F.sha2(text_or_empty("text"), 256))
    alone = tagged.join(keys, same, "left_anti")
    repeated = tagged.join(keys.filter(stays), same, "left_semi")
    copies = Window.partitionBy(digest, "doc_id").orderBy(digest)
    one = repeated.withColumn(copy, F.row_number().over(copies)).filter(F.col(copy) == 1)
    return alone.select(*docs.columns).unionByName(one.select(*docs.columns))
