"""Packing of tokenised documents into sequences by the sum-of-squares rule.

`cut` encodes whole documents and cuts only those longer than a sequence;
`place` puts the pieces into sequences. Full pieces are sequences of their own.
The others are dealt evenly into shards of about SHARD_PIECES pieces, so that no
task ever holds more than a shard, whatever the size of the corpus. Within a
shard, pieces go from the longest to the shortest; each joins the open sequence
for which the sum, over all residual gaps, of the squared number of sequences
with that gap becomes smallest, and opens a new one only if it fits in none.
In that order the rule leaves about one sequence of a shard unfilled.

Defined results: a null or empty text is one end token. Every input row is a
document, whether or not its id is null or repeats. Extra columns of `docs` are
ignored; extra columns of the pieces travel through `place` unchanged. Empty
tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import tokens
from tidemark.llm.common import column_bytes
from tidemark.session import materialize

SHARD_PIECES = 16_384
# Bytes of ids in one Arrow batch that a task hands back.
BATCH_BYTES = 4 << 20

PIECES = "tag long, doc_id long, piece int, start long, length long, ids binary"


def cut(docs: DataFrame, vocabulary: str, limit: int, end_id: int) -> DataFrame:
    """Stored pieces of all documents: ids as little-endian 32-bit integers.

    A document is its ids and the end id. The pieces of a longer one have
    `limit` ids each, but for the first, which takes what is over. `tag` is
    unique to a piece.
    """

    def pieces(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        encode = tokens.encoder(vocabulary, tokens.SpacePrefixed).encode
        end = np.array([end_id], dtype="<u4").tobytes()
        schema = pa.schema(
            [("tag", pa.int64()), ("doc_id", pa.int64()), ("piece", pa.int32())]
            + [("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary())]
        )
        rows, held = [], 0
        tag = TaskContext.get().partitionId() << 33
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), column_bytes(batch.column(1))):
                ids = encode(text) + end
                total = len(ids) // tokens.ID_BYTES
                first = total - (total - 1) // limit * limit
                bounds = [0, *range(first, total + 1, limit)]
                for piece, (start, stop) in enumerate(zip(bounds, bounds[1:])):
                    part = ids[start * tokens.ID_BYTES : stop * tokens.ID_BYTES]
                    rows.append((tag, doc_id, piece, start, stop - start, part))
                    tag += 1
                held += len(ids)
                if held >= BATCH_BYTES:
                    yield pa.RecordBatch.from_arrays(list(map(pa.array, zip(*rows))), schema=schema)
                    rows, held = [], 0
        if rows:
            columns = [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    source = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return materialize(source.mapInArrow(pieces, PIECES), "pieces")


def fill(lengths: list[int], limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset per piece, for pieces from longest to shortest."""
    counts = np.zeros(limit + 1, dtype=np.int64)  # open sequences per gap
    sequences: list[list[int]] = [[] for _ in range(limit + 1)]
    number = np.empty(len(lengths), dtype=np.int64)
    offset = np.empty(len(lengths), dtype=np.int64)
    opened = 0
    for i, length in enumerate(lengths):
        there = counts[length:limit]
        open_gaps = np.flatnonzero(there)
        if len(open_gaps):
            # Change of the sum of squares if one sequence's gap shrinks to `left`;
            # a full sequence (left = 0) counts no more.
            change = 2 * (counts[open_gaps] - there[open_gaps]) + (open_gaps > 0)
            left = int(open_gaps[change.argmin()])
            gap = left + length
            number[i] = sequences[gap].pop()
            counts[gap] -= 1
        else:
            gap, left = limit, limit - length
            number[i] = opened
            opened += 1
        offset[i] = limit - gap
        if left:
            sequences[left].append(int(number[i]))
            counts[left] += 1
    return number, offset


def place(pieces: DataFrame, limit: int, shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """The pieces with sequence_id and offset; needs the columns tag and length."""

    def fill_shard(shard):
        shard = shard.sort_values(["length", "tag"], ascending=[False, True])
        number, offset = fill(shard["length"].tolist(), limit)
        return shard.assign(sequence_id=shard["shard"] * 2**32 + number, offset=offset)[
            ["tag", "sequence_id", "offset"]
        ]

    part = pieces.filter(F.col("length") < limit).select("tag", "length")
    shards = max(1, -(-part.count() // shard_pieces))
    placed = (
        part.withColumn("shard", F.pmod(F.xxhash64("tag"), F.lit(shards)))
        .groupBy("shard")
        .applyInPandas(fill_shard, "tag long, sequence_id long, offset long")
    )
    whole = pieces.filter(F.col("length") == limit)
    return (
        pieces.filter(F.col("length") < limit)
        .join(placed, "tag")
        .unionByName(
            whole.withColumns(
                {"sequence_id": -1 - F.col("tag"), "offset": F.lit(0).cast("long")}
            )
        )
    )
