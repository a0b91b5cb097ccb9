"""Mixing sources to target weights by systematic sampling.

The size of a document is its number of words. Sources in code point order (null last)
take the weights in turn and share the size of the whole corpus by them; no source gets
more than `most` times its own size, and what it cannot take goes to the others by
weight until none is above. That is a water level: the target is the smaller of level
times weight and the cap. With the sources in ascending order of cap per weight, the
capped ones come first, so running sums of caps and weights give the level in one pass.

Each document of a source is expected target / size times in the mix. The documents of a
source lie in the order of their size; the expected copies before a document are summed
up, one random offset of the source is added, and the document is emitted once for every
whole number that its own share crosses. So it comes floor or ceil of its expectation
times, and as neighbours in that order are of almost the same size, the words taken miss
the target by no more than about the longest document's size. Expectations are whole
numbers of 10^-15 copies, summed exactly; the offset is a hash of seed and source, and
rows that are equal in all that orders them have equal texts, so reruns agree.

Bounds: sources and documents are ordered by ranges (`prefix_sums`), so neither a hot
source nor many sources meet in one task; the driver gets one row of totals.

Defined results: a null text is empty and has size 0; documents without words have
copies like others and take nothing. A source without words has target 0 and gives no
copies. Every row is a document, whether or not its id is null or repeats. Other columns
travel along untouched, whatever their names. Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.prefix_sums import sums_before
from tidemark.session import materialize

WEIGHTS = (5, 2, 1)
MOST = 3
SEED = 13
# One copy, in the units that expectations are counted in.
UNIT = 10**15

_WORD = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+[\x20\x09-\x0D]*"


def words(text: str | Column) -> Column:
    """Number of words of a text; each one is replaced by a letter, and they are counted."""
    text = F.coalesce(F.col(text).cast("string") if isinstance(text, str) else text, F.lit(""))
    marks = F.length(F.regexp_replace(text, _WORD, "x")).cast("long")
    return F.when(text.rlike(r"[^\x20\x09-\x0D]"), marks).otherwise(F.lit(0).cast("long"))


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST) -> DataFrame:
    """Per source its size and target, from the columns `source` and `size`."""
    sources = materialize(
        sizes.groupBy("source").agg(F.sum("size").alias("source_size")), "sources"
    ).withColumn("last", F.col("source").isNull())
    ranked = sums_before(sources, [], ["last", "source"], {"rank": F.lit(1)})
    turn = F.element_at(
        F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int")
    )
    weighted = ranked.select(
        "source",
        "source_size",
        turn.alias("weight"),
        (most * F.col("source_size")).alias("cap"),
    ).withColumn("fills_at", F.col("cap") / F.col("weight"))
    stored = materialize(
        sums_before(
            weighted,
            [],
            ["fills_at", "source"],
            {"caps_before": F.col("cap"), "weights_before": F.col("weight")},
        ),
        "water-marks",
    )
    total, weight = stored.agg(F.sum("source_size"), F.sum("weight")).first()
    total, weight = total or 0, weight or 1
    level = (F.lit(total) - F.col("caps_before")) / (F.lit(weight) - F.col("weights_before"))
    capped = stored.withColumn("capped", F.col("fills_at") <= level)
    full = F.when(F.col("capped"), F.col("cap")).otherwise(0)
    heavy = F.when(F.col("capped"), F.col("weight")).otherwise(0)
    caps, weights_full = capped.agg(F.sum(full), F.sum(heavy)).first()
    open_weight = weight - (weights_full or 0)
    rest = (total - (caps or 0)) / open_weight if open_weight else 0.0
    target = F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(
        F.lit(rest) * F.col("weight")
    )
    return capped.select("source", "source_size", target.alias("target"))


def offset(source: Column, seed: int) -> Column:
    """The random offset of a source in units of a copy's 10^-15."""
    name = F.coalesce(F.concat(F.lit(f"{seed}:"), source), F.lit(str(seed)))
    return F.conv(F.substring(F.md5(name), 1, 15), 16, 10).cast("long") % UNIT


def mix(
    docs: DataFrame,
    carry: Sequence[str],
    weights: Sequence[int] = WEIGHTS,
    most: int = MOST,
    seed: int = SEED,
) -> DataFrame:
    """One row per document: `document` (the columns of `carry`), source, size,
    source_size, target, copies and taken (the words that its copies bring)."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    sized = materialize(
        docs.select(
            F.struct(*carry).alias("document"),
            F.col("source").cast("string").alias("source"),
            words("text").alias("size"),
            F.col("doc_id").alias("id"),
            F.md5(text).alias("digest"),
        ),
        "sizes",
    )
    goals = materialize(targets(sized, weights, most), "targets").withColumnRenamed("source", "of")
    share = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    placed = sized.join(goals, F.col("source").eqNullSafe(F.col("of"))).select(
        *sized.columns,
        "source_size",
        "target",
        F.floor(share * UNIT).cast("long").alias("share"),
    )
    exact = F.col("share").cast("decimal(38,0)")
    summed = sums_before(placed, ["source"], ["size", "id", "digest"], {"before": exact})
    start = (F.col("before") + offset(F.col("source"), seed)).cast("decimal(38,0)")
    end = (start + F.col("share")).cast("decimal(38,0)")

    return (
        summed.withColumns({"start": start, "end": end})
        .withColumn("copies", F.expr(f"(`end` div {UNIT}) - (`start` div {UNIT})"))
        .select(
            "document",
            "source",
            "size",
            "source_size",
            "target",
            "copies",
            (F.col("copies") * F.col("size")).alias("taken"),
        )
    )


def emit(mixed: DataFrame) -> DataFrame:
    """The documents of a mix, each as often as it was taken, with the number of the copy."""
    copies = F.sequence(F.lit(1).cast("long"), F.col("copies"))
    return (
        mixed.filter(F.col("copies") > 0)
        .select("document", F.explode(copies).alias("copy"))
        .select("document.*", F.struct("copy").alias("mix"))
    )
