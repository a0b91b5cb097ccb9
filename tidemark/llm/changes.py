"""Changes to documents that some queries make first, by hashes of their ids.

Python workers import this module, which therefore imports nothing large.
"""

from __future__ import annotations

import zlib
from collections import Counter

SLIP = 97


def with_slips(doc_id: int | None, counts: Counter) -> Counter:
    """Some words of a document, chosen by a hash of both, lose a letter."""
    prefix = zlib.crc32(b":" if doc_id is None else b"%d:" % doc_id)
    chosen = [(run, h) for run in counts if not (h := zlib.crc32(run, prefix)) % SLIP]
    changed = [(run.decode(), h, counts.pop(run)) for run, h in chosen]
    for run, h, n in changed:
        at = h % len(run)
        counts[(run[:at] + run[at + 1 :]).encode()] += n
    return counts


def with_repeated_tail(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """A tenth of the documents, chosen by their ids, end in repetitions of some words."""
    chosen = 1 if doc_id is None else zlib.crc32(b"%d" % doc_id)
    if chosen % 10 or not words:
        return words
    seed, n = chosen // 10, len(words)
    first = seed % n
    period = 1 + (n - first) // (3 + seed % 8)
    unit = words[first : first + period]
    return words[:first] + (unit * (1 + (n - first) // period))[: n - first]
