"""Token ids in ORC files, ordered by document id.

Documents are dealt into ranges of their ids, sorted, encoded by the `tokenizers`
library and written as ORC. Ids are integer columns, which ORC stores by
run-length encoding; the files carry row indexes and a Bloom filter on doc_id.
A read for few documents skips files and stripes by that metadata, and Spark
reads stripes of large files in parallel.

Defined results: a null or empty text is one end token. Rows with a null id come
first; of rows that share an id the order is that of their texts. Extra columns
are ignored. An empty table gives files without rows and an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm import tokens
from tidemark.llm.common import column_bytes
from tidemark.session import materialize

SCHEMA = "row_id long, doc_id long, ids array<int>"
STRIPE_BYTES = 64 << 20
INDEX_ROWS = 1_000
# Bytes of ids in one Arrow batch that a task hands back.
BATCH_BYTES = 4 << 20


def write(
    docs: DataFrame,
    path: str,
    vocabulary: str,
    end_id: int,
    stripe_bytes: int = STRIPE_BYTES,
    index_rows: int = INDEX_ROWS,
) -> None:
    """Encode and write all documents in ascending order of doc_id.

    `row_id` grows in that order; its upper bits (from bit 33) number the file.
    """

    def encoded(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        encode = tokens.encoder(vocabulary, tokens.SpaceFree).encode
        end = np.array([end_id], dtype="<u4").tobytes()

        def batch_of(rows: list[tuple]):
            row_ids, doc_ids, ids = zip(*rows)
            sizes = [len(x) // tokens.ID_BYTES for x in ids]
            values = pa.array(np.frombuffer(b"".join(ids), dtype="<i4"))
            offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
            columns = [pa.array(row_ids, pa.int64()), pa.array(doc_ids, pa.int64())]
            columns.append(pa.ListArray.from_arrays(offsets, values))
            return pa.RecordBatch.from_arrays(columns, names=["row_id", "doc_id", "ids"])

        rows, held = [], 0
        for batch in batches:
            for row_id, doc_id, text in zip(
                batch.column(0).to_pylist(),
                batch.column(1).to_pylist(),
                column_bytes(batch.column(2)),
            ):
                ids = encode(text) + end
                rows.append((row_id, doc_id, ids))
                held += len(ids)
                if held >= BATCH_BYTES:
                    yield batch_of(rows)
                    rows, held = [], 0
        if rows:
            yield batch_of(rows)

    ordered = (
        docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
        .repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id", "text")
        .select(F.monotonically_increasing_id().alias("row_id"), "doc_id", "text")
    )
    (
        ordered.mapInArrow(encoded, SCHEMA)
        .write.option("compression", "zstd")
        .option("orc.stripe.size", stripe_bytes)
        .option("orc.row.index.stride", index_rows)
        .option("orc.bloom.filter.columns", "doc_id")
        .option("orc.bloom.filter.fpp", 0.01)
        .orc(path)
    )


def read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).orc(path)


def read_documents(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """The rows of some documents; files and stripes without them are skipped."""
    return read(spark, path).filter(F.col("doc_id").isin(doc_ids))


def summary(stored: DataFrame) -> DataFrame:
    """Per stored document: start (ids before it), n_tokens, ids_crc32."""

    def measured(batches: Iterator) -> Iterator:
        import zlib

        import numpy as np
        import pyarrow as pa

        for batch in batches:
            ids = batch.column(2)
            bounds = ids.offsets.to_numpy()
            data = memoryview(np.ascontiguousarray(ids.values.to_numpy(), dtype="<i4")).cast("B")
            crcs = [zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(bounds, bounds[1:])]
            columns = [batch.column(0), batch.column(1)]
            columns += [pa.array(np.diff(bounds).astype(np.int64)), pa.array(crcs, pa.int64())]
            names = ["row_id", "doc_id", "n_tokens", "ids_crc32"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = "row_id long, doc_id long, n_tokens long, ids_crc32 long"
    rows = materialize(stored.mapInArrow(measured, schema), "measured").withColumn(
        "file", F.shiftright("row_id", 33)
    )
    # One row per file: the only window that is not split, over as many rows as
    # files were written.
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    files = (
        rows.groupBy("file")
        .agg(F.sum("n_tokens").alias("size"))
        .select("file", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("files_before"))
    )
    inside = (
        Window.partitionBy("file")
        .orderBy("row_id")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        rows.withColumn("rows_before", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
        .join(files, "file")
        .select(
            "doc_id",
            (F.col("files_before") + F.col("rows_before")).alias("start"),
            "n_tokens",
            "ids_crc32",
        )
    )
