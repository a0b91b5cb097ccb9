"""Documents whose sets of five-word shingles have a Jaccard similarity of at least 0.8.

1. Equal texts form a class; everything below works on one text per class.
2. Each text gets a MinHash signature of one byte per hash function. Texts that
   agree on all hashes of a band share a bucket; buckets with the same members
   count once. Two texts of similarity 0.8 share no bucket with a probability
   of 3e-6, more similar ones with less.
3. Within a bucket, pairs are compared some hashes at a time. With a uniform
   prior, the number of agreeing hashes gives the posterior probability that
   the similarity reaches the threshold; a pair for which it is below TOLERANCE
   is dropped. What remains links the texts to candidate groups.
4. Within a candidate group every pair passes the same pruning again and the rest
   are verified exactly on the shingle sets.

A bucket or group above BLOCK_ROWS texts (or BLOCK_SHINGLES shingles) is cut into
blocks, and each pair of blocks is a unit of work of bounded size. Pairs are never
rows: a unit returns one row per text with its number of links and the smallest
text that links reach inside the unit.

Defined results: words are those of `common.WORD`; a text of one to four words has
one shingle, all its words. Null and empty texts are one class without shingles and
without links. A null id is larger than any other when the smallest id of a class
or group is taken. Repeated rows are members of one class. Extra columns are
ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import (
    WordHashes,
    column_bytes,
    keep_rows,
    shingles,
    text_or_empty,
    words_of,
)
from tidemark.llm.components import components
from tidemark.session import materialize

SHINGLE = 5
THRESHOLD = 0.8
BANDS = 42
BAND_HASHES = 6
HASHES = BANDS * BAND_HASHES
# Hashes after which pairs are pruned.
STEPS = (24, 48, 96, 168, HASHES)
TOLERANCE = 1e-6
BLOCK_ROWS = 512
BLOCK_SHINGLES = 1 << 20

_MULTIPLIERS = np.random.default_rng(5).integers(0, 2**31, HASHES).astype(np.uint32) * 2 + 1
_MIX = np.uint32(0x9E3779B1)
_CHUNK = 256

_hashes = WordHashes()


def shingle_set(text: bytes) -> np.ndarray:
    """Sorted distinct shingle hashes of a text."""
    words = words_of(text)
    return np.unique(shingles(_hashes.of(words), min(SHINGLE, max(1, len(words)))))


def signature(shingle_hashes: np.ndarray) -> bytes:
    """One byte per hash function: the low bits of the smallest value, mixed."""
    short = (shingle_hashes >> np.uint64(32)).astype(np.uint32)
    least = np.full(HASHES, 0xFFFFFFFF, dtype=np.uint32)
    for start in range(0, len(short), _CHUNK):
        values = np.multiply.outer(short[start : start + _CHUNK], _MULTIPLIERS)
        np.minimum(least, values.min(axis=0), out=least)
    return ((least * _MIX) >> np.uint32(24)).astype(np.uint8).tobytes()


def fewest_matches(threshold: float, tolerance: float) -> list[int]:
    """For each step the fewest agreeing hashes with which a pair goes on.

    Under a uniform prior of the similarity s, hashes agree with probability
    s + (1 - s) / 256: equal minima, or equal bytes by chance.
    """
    grid = np.linspace(0, 1, 4001)[1:-1]
    agree = grid + (1 - grid) / 256
    out = []
    for n in STEPS:
        m = np.arange(n + 1)[:, None]
        log = m * np.log(agree) + (n - m) * np.log1p(-agree)
        weight = np.exp(log - log.max(axis=1, keepdims=True))
        above = weight[:, grid >= threshold].sum(axis=1) / weight.sum(axis=1)
        out.append(int(np.argmax(above >= tolerance)))
    return out


_FEWEST = fewest_matches(THRESHOLD, TOLERANCE)


def likely_pairs(signatures: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Positions of the pairs (left, right) that no step drops."""
    alive = np.arange(len(left))
    agreed = np.zeros(len(left), dtype=np.int32)
    start = 0
    for stop, fewest in zip(STEPS, _FEWEST):
        a, b = signatures[left[alive], start:stop], signatures[right[alive], start:stop]
        agreed = agreed + (a == b).sum(axis=1)
        stay = agreed >= fewest
        alive, agreed, start = alive[stay], agreed[stay], stop
        if not len(alive):
            break
    return alive


def pairs_of(own: np.ndarray, first: int, second: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows inside one block, or between two blocks."""
    if first == second:
        return np.triu_indices(len(own), 1)
    a, b = np.flatnonzero(own == first), np.flatnonzero(own == second)
    return np.repeat(a, len(b)), np.tile(b, len(a))


def smallest_reached(nodes: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Per row the smallest node that pairs of rows connect it to."""
    root = nodes.copy()
    while True:
        least = np.minimum(root[left], root[right])
        new = root.copy()
        np.minimum.at(new, left, least)
        np.minimum.at(new, right, least)
        if (new == root).all():
            return root
        root = new


def units(batches: Iterator, keys: int) -> Iterator:
    """Tables of the rows that agree in the first `keys` columns; rows come sorted by them."""
    import pyarrow as pa

    held: list = []
    current: tuple | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(keys)]
        changed = np.zeros(batch.num_rows, dtype=bool)
        changed[0] = True
        for c in columns:
            changed[1:] |= c[1:] != c[:-1]
        starts = [*np.flatnonzero(changed).tolist(), batch.num_rows]
        for start, stop in zip(starts, starts[1:]):
            key = tuple(int(c[start]) for c in columns)
            if key != current and held:
                yield current, pa.Table.from_batches(held)
                held = []
            current = key
            held.append(batch.slice(start, stop - start))
    if held:
        yield current, pa.Table.from_batches(held)


def _matrix(column) -> np.ndarray:
    data = b"".join(column.to_pylist())
    return np.frombuffer(data, dtype=np.uint8).reshape(-1, HASHES)


def _links(batches: Iterator) -> Iterator:
    """Candidate links of buckets: columns key, first, second, own, node, signature."""
    import pyarrow as pa

    a: list[int] = []
    b: list[int] = []
    for (_, first, second), unit in units(batches, 3):
        nodes = unit.column(4).to_numpy()
        left, right = pairs_of(unit.column(3).to_numpy(), first, second)
        alive = likely_pairs(_matrix(unit.column(5)), left, right)
        root = smallest_reached(nodes, left[alive], right[alive])
        moved = root != nodes
        a += nodes[moved].tolist()
        b += root[moved].tolist()
        if len(a) >= 50_000:
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])
            a, b = [], []
    columns = [pa.array(a, pa.int64()), pa.array(b, pa.int64())]
    yield pa.RecordBatch.from_arrays(columns, names=["a", "b"])


def similar_pairs(
    sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, threshold: float = THRESHOLD
) -> np.ndarray:
    """Which of the pairs of sets (ordered by left) reach the threshold, exactly."""
    if not len(left):
        return np.empty(0, dtype=bool)
    vocabulary, place = np.unique(np.concatenate(sets), return_inverse=True)
    bounds = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    places = [place[x:y] for x, y in zip(bounds, bounds[1:])]
    sizes = np.diff(bounds)
    present = np.zeros(len(vocabulary), dtype=np.int32)
    common = np.empty(len(left), dtype=np.int64)
    starts = np.concatenate([[0], np.flatnonzero(np.diff(left)) + 1, [len(left)]])
    for x, y in zip(starts, starts[1:]):
        own = places[left[x]]
        others = right[x:y]
        present[own] = 1
        found = present[np.concatenate([places[k] for k in others])]
        at = np.concatenate([[0], np.cumsum(sizes[others])[:-1]])
        common[x:y] = np.add.reduceat(found, at)
        present[own] = 0
    union = sizes[left] + sizes[right] - common
    return common >= threshold * union - 1e-9


def _verified(batches: Iterator) -> Iterator:
    """Links of candidate groups: columns key, first, second, own, node, signature, shingles."""
    import pyarrow as pa

    for (_, first, second), unit in units(batches, 3):
        nodes, rows = np.unique(unit.column(4).to_numpy(), return_index=True)
        own = unit.column(3).to_numpy()[rows]
        unit = unit.take(pa.array(rows))
        sets = [np.frombuffer(x, dtype="<u8") for x in unit.column(6).to_pylist()]
        sizes = np.array([len(s) for s in sets])
        left, right = pairs_of(own, first, second)
        near = np.minimum(sizes[left], sizes[right]) >= THRESHOLD * np.maximum(
            sizes[left], sizes[right]
        )
        left, right = left[near], right[near]
        alive = likely_pairs(_matrix(unit.column(5)), left, right)
        left, right = left[alive], right[alive]
        linked = similar_pairs(sets, left, right)
        left, right = left[linked], right[linked]
        links = np.bincount(np.concatenate([left, right]), minlength=len(nodes))
        root = smallest_reached(nodes, left, right)
        some = links > 0
        columns = [pa.array(nodes[some]), pa.array(root[some]), pa.array(links[some])]
        yield pa.RecordBatch.from_arrays(columns, names=["node", "root", "links"])


def _in_blocks(rows: DataFrame, blocks: Column, *columns: str) -> DataFrame:
    """Rows of a key, once for each pair of blocks that they belong to, sorted by unit."""
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    unit = ["key", "first", "second"]
    return (
        rows.withColumn("blocks", blocks.cast("int"))
        .withColumn("own", own)
        .withColumn("other", other)
        .select(
            "key",
            F.least("own", "other").alias("first"),
            F.greatest("own", "other").alias("second"),
            "own",
            "node",
            *columns,
        )
        .repartition(*unit)
        .sortWithinPartitions(*unit)
    )


def signatures(docs: DataFrame) -> DataFrame:
    """Stored rows of all documents: doc_id, digest, signature (null without words), shingles."""

    def sign(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            found, sizes = [], []
            for text in column_bytes(batch.column(2)):
                hashes = shingle_set(text)
                found.append(signature(hashes) if len(hashes) else None)
                sizes.append(len(hashes))
            columns = [batch.column(0), batch.column(1)]
            columns += [pa.array(found, pa.binary()), pa.array(sizes, pa.int64())]
            names = ["doc_id", "digest", "signature", "shingles"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    source = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.sha2(text_or_empty("text"), 256).alias("digest"),
        text_or_empty("text").alias("text"),
    )
    schema = "doc_id long, digest string, signature binary, shingles long"
    return materialize(source.mapInArrow(sign, schema), "signatures")


def candidate_groups(classes: DataFrame) -> DataFrame:
    """Texts that pruned links connect: node, root."""
    numbers = F.sequence(F.lit(0), F.lit(BANDS - 1))
    band = F.transform(
        numbers,
        lambda i: F.xxhash64(
            i, F.substring("signature", i * BAND_HASHES + 1, F.lit(BAND_HASHES))
        ),
    )
    entries = classes.filter("signature is not null").select(
        "node", F.explode(band).alias("key")
    )
    buckets = (
        entries.groupBy("key")
        .agg(
            F.count(F.lit(1)).alias("members"),
            F.bit_xor(F.xxhash64("node")).alias("mark"),
            F.min("node").alias("least"),
            F.max("node").alias("most"),
        )
        .filter("members > 1")
        .groupBy("members", "mark", "least", "most")
        .agg(F.min("key").alias("key"))
        .select("key", "members")
    )
    members = entries.join(materialize(buckets, "buckets"), "key").join(
        classes.select("node", "signature"), "node"
    )
    blocks = F.ceil(F.col("members") / BLOCK_ROWS)
    links = _in_blocks(members, blocks, "signature").mapInArrow(_links, "a long, b long")
    return components(links)


def verified_links(docs: DataFrame, classes: DataFrame, groups: DataFrame) -> DataFrame:
    """Stored links inside candidate groups, per unit of work: node, root, links."""

    def with_sets(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            sets = [shingle_set(t).astype("<u8").tobytes() for t in column_bytes(batch.column(4))]
            columns = [*batch.columns[:4], pa.array(sets, pa.binary())]
            names = ["key", "node", "blocks", "signature", "shingles"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    members = groups.join(classes, "node")
    sizes = members.groupBy("root").agg(
        F.ceil(
            F.greatest(
                F.count(F.lit(1)) / BLOCK_ROWS, F.sum("shingles") / BLOCK_SHINGLES
            )
        ).alias("blocks")
    )
    wanted = materialize(
        members.join(sizes, "root").select(
            F.col("root").alias("key"), "node", "blocks", "signature",
            F.col("class_id").alias("_id"), F.col("digest").alias("_digest"),
        ),
        "members",
    )
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.sha2(text_or_empty("text"), 256).alias("digest"),
        text_or_empty("text").alias("text"),
    )
    same = (F.col("digest") == F.col("_digest")) & F.col("doc_id").eqNullSafe(F.col("_id"))
    sets = (
        texts.join(wanted, same)
        .select("key", "node", "blocks", "signature", "text")
        .mapInArrow(
            with_sets, "key long, node long, blocks long, signature binary, shingles binary"
        )
    )
    linked = _in_blocks(sets, F.col("blocks"), "signature", "shingles").mapInArrow(
        _verified, "node long, root long, links long"
    )
    return materialize(linked, "links")


def join(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, digest, class_id, group_id, n_links, leads.

    class_id is the smallest id among equal texts, group_id the smallest among the
    texts that links connect, n_links the number of different texts linked; `leads`
    is true for the text of the group that has the smallest id.
    """
    signed = signatures(docs)
    classes = materialize(
        signed.groupBy("digest")
        .agg(
            F.min("doc_id").alias("class_id"),
            F.first("signature").alias("signature"),
            F.first("shingles").alias("shingles"),
        )
        .withColumn("node", F.monotonically_increasing_id()),
        "classes",
    )
    linked = verified_links(docs, classes, candidate_groups(classes))
    counts = linked.groupBy("node").agg(F.sum("links").alias("n_links"))
    groups = components(linked.select(F.col("node").alias("a"), F.col("root").alias("b")))
    # Ids may be null or shared by different texts: the digest breaks ties.
    order = F.struct(F.col("class_id").isNull().alias("none"), "class_id", "digest")
    named = groups.join(classes.select("node", order.alias("own")), "node").join(counts, "node")
    first = named.groupBy("root").agg(F.min("own").alias("first"))
    info = materialize(
        classes.select("digest", "class_id", order.alias("own")).join(
            named.join(first, "root").select(
                F.col("own.digest").alias("digest"), "first", "n_links"
            ),
            "digest",
            "left",
        )
        .withColumn("first", F.coalesce("first", "own"))
        .select(
            "digest",
            "class_id",
            F.col("first.class_id").alias("group_id"),
            (F.col("first.digest") == F.col("digest")).alias("leads"),
            F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        ),
        "classes",
    )
    return (
        signed.select("doc_id", "digest")
        .join(info, "digest")
        .select("doc_id", "digest", "class_id", "group_id", "n_links", "leads")
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """One document of each group, the one with the smallest id, with all columns."""
    kept = F.col("leads") & F.col("doc_id").eqNullSafe(F.col("class_id"))
    return keep_rows(docs, join(docs).select("doc_id", "digest", kept.alias("kept")))
