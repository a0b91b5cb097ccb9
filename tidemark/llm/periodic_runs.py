"""Repeated stretches of words, found with a dictionary of basic factors.

A run is a stretch of words with smallest period q (words q apart are equal), at least
`least_periods` times q and `least_words` long, that no neighbouring word extends. Words
are what lies between ASCII white space.

The dictionary names the stretches ("factors") of length l = 1, 2, 4, ...: equal factors
get equal names, and the names of length 2l are pairs of names of length l. Where a
factor occurs again d words on, with l/2 < d <= l, words d apart are equal over l words;
while consecutive positions have successors at the same distance d, their occurrences
form progressions of difference d, and the stretch they cover together has period d. In
a run of period q at least 3q long, the level with q <= l < 2q sees at each position a
successor at exactly q: a nearer one would give the run a smaller period. So that level
proposes each run of period q once and in full length: the chain of positions is the
extension to both sides, and each period belongs to one level, so that nothing is
proposed twice (`least_periods` is 3 or more for this reason). A level only looks at
positions whose two halves both occur again in their document, which soon are few.

Bounds: documents are independent, so there is no shuffle. A task names some 500,000
words at a time, whole documents always; a very long text takes about 30 times its bytes
in its task's memory. Time is n log^2 n words.

Defined results: a null or empty text has no words, no runs and an empty collapsed text.
Every row is a document, whether or not its id is null or repeats. Extra columns are
ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import column_bytes

LEAST_WORDS, LEAST_PERIODS = 24, 3
# Words that a task names together.
BLOCK_WORDS = 500_000

RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"
FOUND = f"doc_id long, n_words long, runs {RUNS}, collapsed string"

Prepare = Callable[[int | None, list[bytes]], list[bytes]]


def runs_of(
    names: np.ndarray, least_words: int = LEAST_WORDS, least_periods: int = LEAST_PERIODS
) -> np.ndarray:
    """Rows (start, length, period) of all runs in an array of names, by start and period."""
    if least_periods < 3:
        raise ValueError("a level sees whole runs from three periods on")
    found = []
    at = np.arange(len(names))
    l = 1
    while len(at):
        order = np.argsort(names, kind="stable")
        ordered = names[order]
        again = ordered[1:] == ordered[:-1]
        distance = np.zeros(len(at), dtype=np.int64)
        distance[order[:-1]] = np.where(again, at[order[1:]] - at[order[:-1]], 0)
        found.append(_stretches(at, distance, l))
        found[-1] = found[-1][
            found[-1][:, 1] >= np.maximum(least_words, least_periods * found[-1][:, 2])
        ]
        repeated = np.zeros(len(at), dtype=bool)
        repeated[order[1:]] = again
        repeated[order[:-1]] |= again
        at, names = _doubled(at[repeated], names[repeated], l)
        l *= 2
    if not found:
        return np.empty((0, 3), dtype=np.int64)
    rows = np.concatenate(found)
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def _stretches(at: np.ndarray, distance: np.ndarray, l: int) -> np.ndarray:
    """Chains of consecutive positions with successors at one distance in (l/2, l]."""
    near = (distance <= l) & (2 * distance > l)
    at, distance = at[near], distance[near]
    if not len(at):
        return np.empty((0, 3), dtype=np.int64)
    first = np.ones(len(at), dtype=bool)
    first[1:] = (np.diff(at) != 1) | (np.diff(distance) != 0)
    starts = np.flatnonzero(first)
    sizes = np.diff(np.append(starts, len(at)))
    period = distance[starts]
    return np.stack([at[starts], sizes - 1 + l + period, period], axis=1)


def _doubled(at: np.ndarray, names: np.ndarray, l: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and names of the factors of twice the length whose halves both recur."""
    if not len(at):
        return at, names
    index = np.searchsorted(at, at + l)
    index[index == len(at)] = 0
    whole = at[index] == at + l
    pairs = names[whole] * (names.max() + 1) + names[index[whole]]
    return at[whole], np.unique(pairs, return_inverse=True)[1]


def _collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words outside of all runs and those of each run's first period."""
    if not len(runs):
        return b" ".join(words)
    change = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    kept = np.cumsum(change[:-1]) == 0
    return b" ".join([words[i] for i in np.flatnonzero(kept)])


def find(
    docs: DataFrame,
    prepare: Prepare | None = None,
    least_words: int = LEAST_WORDS,
    least_periods: int = LEAST_PERIODS,
) -> DataFrame:
    """Per document its number of words, its runs (by start, then period) and its text
    without their repetitions, words joined by one space.

    `prepare` may replace the words of a document before they are looked at.
    """

    def searched(batches: Iterator) -> Iterator:
        import pyarrow as pa

        def block(documents: list[tuple[int | None, list[bytes]]]):
            names, base = [], 0
            bounds = [0]
            for _, words in documents:  # a name is a word of one document
                own: dict[bytes, int] = {}
                names += [own.setdefault(word, base + len(own)) for word in words]
                base += len(own)
                bounds.append(len(names))
            runs = runs_of(np.array(names, dtype=np.int64), least_words, least_periods)
            parts = np.searchsorted(runs[:, 0], bounds)
            own_runs = [
                runs[a:b] - [start, 0, 0] for a, b, start in zip(parts, parts[1:], bounds)
            ]
            texts = [_collapsed(words, r) for (_, words), r in zip(documents, own_runs)]
            structs = pa.StructArray.from_arrays(
                [
                    pa.array(column, pa.int64())
                    for column in np.concatenate([np.empty((0, 3), np.int64), *own_runs]).T
                ],
                names=["start", "length", "period"],
            )
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([doc_id for doc_id, _ in documents], pa.int64()),
                    pa.array(np.diff(bounds).astype(np.int64)),
                    pa.ListArray.from_arrays(pa.array(parts, pa.int32()), structs),
                    pa.array(texts, pa.binary()).cast(pa.string()),
                ],
                names=["doc_id", "n_words", "runs", "collapsed"],
            )

        held, size = [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), column_bytes(batch.column(1))):
                words = text.split()
                if prepare is not None:
                    words = prepare(doc_id, words)
                held.append((doc_id, words))
                size += len(words)
                if size >= BLOCK_WORDS:
                    yield block(held)
                    held, size = [], 0
        if held:
            yield block(held)

    source = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return source.mapInArrow(searched, FOUND)


def highest(runs: str):
    """The run with the greatest length / period; the first of equal ones."""
    none = F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>")
    return F.aggregate(
        runs,
        none,
        lambda best, run: F.when(
            best.isNull() | (run["length"] * best["period"] > best["length"] * run["period"]), run
        ).otherwise(best),
    )
