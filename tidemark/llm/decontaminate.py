"""Passages of benchmark items inside documents, by a prefix-filtered set join.

A window is WINDOW consecutive words of an item (or the whole of a shorter one)
and the set of its shingles of five words. A document contains a window only if
it has every shingle of it, so the necessary prefix of a window is a single
shingle, and the rarest one over all documents gives the fewest candidates:

1. Documents are read once. Positions whose shingle may belong to an item (a
   bitmap of fixed size says so) are kept together with the words around them.
2. Shingles are counted over all documents and each window picks its rarest. A
   window with a shingle that no document has needs no further work.
3. Kept positions join the windows on that shingle; the place of the shingle in
   the window and the words left on either side bound the position and length.
4. What is left is verified word by word.

Only the bitmap is sent to every worker, and its size does not depend on the
items. False alarms of the bitmap cost time, never rows.

Defined results: null and empty texts have no words. Items without words have no
windows; an item without an id goes under the empty string; items that share an
id count once. Every input row gives one row, whether or not its id is null or
repeats. Extra columns are ignored. An empty benchmark hits nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import (
    WordHashes,
    column_bytes,
    free_names,
    shingles,
    text_or_empty,
    words_of,
)
from tidemark.session import materialize

WINDOW = 10
SHINGLE = 5
# The bitmap has 2 ** FILTER_BITS bits: 8 MB. With 10 million different shingles
# of items it still rejects six positions of seven.
FILTER_BITS = 26
_BITMAP_BITS = 32_768  # of one value of Spark's bitmap_construct_agg

WINDOWS = "item string, words array<string>, width int, hashes array<long>"
FOUND = (
    "row long, doc_id long, digest string, n_words long, "
    "spans array<struct<start:int, words:array<string>, at:array<int>, hash:array<long>>>"
)

_hashes = WordHashes()


def item_windows(items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """Windows of all items with their shingle hashes."""

    def windows(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            rows: list[tuple] = []
            for item, text in zip(batch.column(0).to_pylist(), column_bytes(batch.column(1))):
                words = words_of(text)
                if not words:
                    continue
                size = min(window, len(words))
                width = min(shingle, size)
                hashes = shingles(_hashes.of(words), width).view(np.int64)
                for start in range(len(words) - size + 1):
                    part = [w.decode("utf-8", "replace") for w in words[start : start + size]]
                    own = hashes[start : start + size - width + 1].tolist()
                    rows.append((item, part, width, own))
            types = [pa.string(), pa.list_(pa.string()), pa.int32(), pa.list_(pa.int64())]
            columns = zip(*rows) if rows else ([] for _ in types)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), t) for c, t in zip(columns, types)],
                names=["item", "words", "width", "hashes"],
            )

    source = items.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")), text_or_empty("text")
    )
    return materialize(
        source.mapInArrow(windows, WINDOWS).withColumn("window", F.monotonically_increasing_id()),
        "windows",
    )


def bitmap_of(hashes: DataFrame, bits: int) -> np.ndarray:
    """Bitmap of the upper bits of column `hash`: 2 ** bits bits, whatever the rows."""
    index = F.shiftrightunsigned("hash", 64 - bits)
    chunks = (
        hashes.select(
            F.floor(index / _BITMAP_BITS).alias("chunk"), (index % _BITMAP_BITS).alias("bit")
        )
        .groupBy("chunk")
        .agg(F.bitmap_construct_agg("bit").alias("bitmap"))
    )
    out = np.zeros(2**bits // 8, dtype=np.uint8)
    for row in chunks.toLocalIterator():  # at most 2 ** bits / 32768 rows of 4 KB
        start = int(row["chunk"]) * (_BITMAP_BITS // 8)
        part = np.frombuffer(bytes(row["bitmap"]), dtype=np.uint8)
        out[start : start + len(part)] = part
    return out


def _spans(places: list[tuple[int, int, int]], words: list[bytes], reach: int) -> list[dict]:
    """Places (position, width, hash) with the words within reach, merged where they meet."""
    spans: list[dict] = []
    stop = -1
    for at, width, value in sorted(places):
        start = max(0, at - reach)
        if start > stop or not spans:
            spans.append({"start": start, "stop": 0, "at": [], "hash": []})
        span = spans[-1]
        stop = max(stop, min(len(words), at + width + reach))
        span["stop"] = stop
        span["at"].append(at - span["start"])
        span["hash"].append(value)
    for span in spans:
        part = words[span["start"] : span.pop("stop")]
        span["words"] = [w.decode("utf-8", "replace") for w in part]
    return spans


def suspicious_spans(
    spark: SparkSession, docs: DataFrame, bitmap: np.ndarray, widths: list[int], bits: int
) -> DataFrame:
    """Per document its number of words and the places that may lie in an item."""
    shared = spark.sparkContext.broadcast(bitmap)
    shift = np.uint64(64 - bits)

    def scan(batches: Iterator) -> Iterator:
        import pyarrow as pa

        filled = shared.value
        span = pa.struct(
            [("start", pa.int32()), ("words", pa.list_(pa.string()))]
            + [("at", pa.list_(pa.int32())), ("hash", pa.list_(pa.int64()))]
        )
        for batch in batches:
            n_words, spans = [], []
            for text in column_bytes(batch.column(3)):
                words = words_of(text)
                hashed = _hashes.of(words)
                places: list[tuple[int, int, int]] = []
                for width in widths:
                    found = shingles(hashed, width)
                    index = (found >> shift).astype(np.int64)
                    known = (filled[index >> 3] >> (index & 7).astype(np.uint8)) & 1
                    at = np.flatnonzero(known)
                    values = found[at].view(np.int64).tolist()
                    places += zip(at.tolist(), [width] * len(at), values)
                n_words.append(len(words))
                spans.append(_spans(places, words, WINDOW - 1) if places else [])
            columns = [batch.column(i) for i in range(3)]
            columns += [pa.array(n_words, pa.int64()), pa.array(spans, pa.list_(span))]
            yield pa.RecordBatch.from_arrays(
                columns, names=["row", "doc_id", "digest", "n_words", "spans"]
            )

    source = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("doc_id").cast("long"),
        F.sha2(text_or_empty("text"), 256).alias("digest"),
        text_or_empty("text").alias("text"),
    )
    return materialize(source.mapInArrow(scan, FOUND), "spans")


def mark(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Per document: doc_id, digest, n_words, n_hit, n_items, items_sha256, contaminated."""
    spark = docs.sparkSession
    windows = item_windows(items)
    vocabulary = windows.select(F.explode("hashes").alias("hash")).distinct()
    widths = sorted(r["width"] for r in windows.select("width").distinct().collect())
    found = suspicious_spans(
        spark, docs, bitmap_of(vocabulary, FILTER_BITS), widths, FILTER_BITS
    )
    spans = found.select("row", F.explode("spans").alias("span"))

    rarity = (
        spans.select("row", F.explode(F.array_distinct("span.hash")).alias("hash"))
        .groupBy("hash")
        .agg(F.count(F.lit(1)).alias("documents"))
    )
    choice = F.min(F.struct("documents", "hash", "offset"))
    prefixes = (
        windows.select("window", F.posexplode("hashes").alias("offset", "hash"))
        .join(rarity, "hash", "left")
        .groupBy("window")
        .agg(choice.alias("rarest"), F.bool_and(F.col("documents").isNotNull()).alias("possible"))
        .filter("possible")
        .select("window", "rarest.hash", "rarest.offset")
        .join(windows.select("window", "item", "words"), "window")
    )

    # Of a span, a position needs only the words that a window over it can reach.
    first = F.greatest(F.col("place.at") - (WINDOW - 1), F.lit(0))
    positions = (
        spans.select("row", "span", F.explode(F.arrays_zip("span.at", "span.hash")).alias("place"))
        .select(
            "row",
            F.col("place.hash").alias("hash"),
            (F.col("span.start") + F.col("place.at")).alias("position"),
            (F.col("place.at") - first).alias("before"),
            F.slice(F.col("span.words"), first + 1, F.lit(2 * WINDOW + SHINGLE)).alias("around"),
        )
    )
    length = F.size("words")
    in_reach = (F.col("before") >= F.col("offset")) & (
        F.size("around") - F.col("before") >= length - F.col("offset")
    )
    same = F.slice("around", F.col("before") - F.col("offset") + 1, length) == F.col("words")
    hits = (
        positions.join(prefixes, "hash")
        .filter(F.when(in_reach, same).otherwise(False))
        .select(
            "row",
            "item",
            F.struct((F.col("position") - F.col("offset")).alias("start"), length.alias("length"))
            .alias("place"),
        )
    )
    covered = F.flatten(
        F.transform("places", lambda p: F.sequence(p.start, p.start + p.length - 1))
    )
    per_document = (
        hits.groupBy("row")
        .agg(F.collect_set("place").alias("places"), F.collect_set("item").alias("items"))
        .select(
            "row",
            F.size(F.array_distinct(covered)).cast("long").alias("n_hit"),
            F.size("items").cast("long").alias("n_items"),
            F.array_join(F.array_sort("items"), ",").alias("items"),
        )
    )
    none = F.lit(0).cast("long")
    return (
        found.select("row", "doc_id", "digest", "n_words")
        .join(per_document, "row", "left")
        .select(
            "doc_id",
            "digest",
            "n_words",
            F.coalesce("n_hit", none).alias("n_hit"),
            F.coalesce("n_items", none).alias("n_items"),
            F.sha2(F.coalesce("items", F.lit("")), 256).alias("items_sha256"),
            (F.coalesce("n_hit", none) > 0).alias("contaminated"),
        )
    )


def decontaminate(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents without any window of an item, with all their columns."""
    digest, hit = free_names(docs, "_digest", "_hit")
    hits = mark(docs, items).filter("contaminated").select(F.col("digest").alias(hit))
    return (
        docs.withColumn(digest, F.sha2(text_or_empty("text"), 256))
        .join(hits.distinct(), F.col(digest) == F.col(hit), "left_anti")
        .drop(digest)
    )
