"""Spelling variants: words at one edit, and the form that each word comes from.

Two words are near if one inserted, deleted or replaced code point makes one the other.
The search is that of asymmetric q-chunks. The shorter word (of two equally long ones,
either) is cut into two disjoint chunks; one edit leaves one of them whole. The other
word gives its positional grams of the chunks' lengths; whole chunks are found in it at
the same position or, behind the edit, moved by the difference of the lengths, which is
one at most. Grams that lie elsewhere can match no chunk and are not sent. What remains
beside the whole chunk holds the edit and is again a pair at one edit, so it is cut in
the same way, and the half of it that stays whole joins the key: three quarters of a
word in all, which keeps the candidates of common chunks (endings, say) few. Candidates
are verified by their edit distance.

A word's form is its near word of largest count, if that is at least `ratio` times its
own count. Forms so grow by that factor from step to step, so chains are short, and roots
are found by doubling the steps (log2 of the longest chain rounds of joins).

Bounds: words are counted in the tasks that read the texts and merged after a shuffle by
word, so copies and frequent words travel once a block of texts. Nothing is collected or
broadcast besides what Spark finds small.

Defined results: a null or empty text has no words. A null id counts as an empty one
where ids matter (`prepare`). Every row is a document. Extra columns are ignored, an
empty table gives an empty result, and of equally frequent near words the first in code
point order is the form.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import column_bytes
from tidemark.session import materialize

LEAST_LETTERS, LEAST_COUNT, RATIO = 5, 3, 2
# Runs of a-z and U+00C0..U+00FF, after lower-casing A-Z, as UTF-8.
RUN = re.compile(rb"[a-z]+(?:\xc3[\x80-\xbf][a-z]*)*|(?:\xc3[\x80-\xbf][a-z]*)+")
# Different words that a task counts before it hands them on.
BLOCK_WORDS = 200_000
# Words with their forms in one file of the tables that the roots are found in.
WORDS_PER_FILE = 100_000

Prepare = Callable[[int | None, Counter], Counter]


def count_words(
    docs: DataFrame,
    prepare: Prepare | None = None,
    least_letters: int = LEAST_LETTERS,
    least_count: int = LEAST_COUNT,
) -> DataFrame:
    """Stored words of all texts with their number of occurrences n.

    `prepare` may change the counted runs of a document before they are added up.
    """

    def counted(batches: Iterator) -> Iterator:
        import pyarrow as pa

        def block(counts: Counter):
            arrays = [pa.array(list(counts), pa.binary()).cast(pa.string())]
            arrays.append(pa.array(list(counts.values()), pa.int64()))
            return pa.RecordBatch.from_arrays(arrays, names=["word", "n"])

        counts: Counter = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), column_bytes(batch.column(1))):
                own = Counter(RUN.findall(text.lower()))
                for word, n in (own if prepare is None else prepare(doc_id, own)).items():
                    counts[word] += n
                if len(counts) >= BLOCK_WORDS:
                    yield block(counts)
                    counts = Counter()
        if counts:
            yield block(counts)

    source = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    words = source.mapInArrow(counted, "word string, n long").filter(
        F.length("word") >= least_letters
    )
    total = words.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)
    return materialize(total, "words")


def _keys(word: Column, length: Column, moved: int) -> Column:
    """The four keys of a word as, or against, a word of `length` code points.

    `moved` is 0 or 1: how much longer the word itself is. Positions before the edit
    count from the front, those behind it from the end.
    """
    head = F.ceil(length / 2).cast("int")
    tail = (length - head).cast("int")

    def front(n: Column) -> Column:
        return F.substring(word, F.lit(1), n)

    def back(n: Column) -> Column:
        return F.substring(word, length + moved - n + 1, n)

    def middle(start: Column, n: Column) -> Column:
        return F.substring(word, start + 1, n)

    head_half = F.ceil(head / 2).cast("int")
    tail_half = F.ceil(tail / 2).cast("int")
    gap = F.lit("\x00")
    keys = [
        # The edit is in the second chunk: in its second half, or in its first one.
        F.concat(front(head), middle(head, tail_half), gap, F.lit("a")),
        F.concat(front(head), gap, F.lit("b"), back((tail - tail_half).cast("int"))),
        # The edit is in the first chunk.
        F.concat(front(head_half), gap, F.lit("c"), back(tail)),
        F.concat(gap, F.lit("d"), middle(head_half + moved, (length - head_half).cast("int"))),
    ]
    return F.transform(F.array(*keys), lambda key: F.concat(length.cast("string"), gap, key))


def near_pairs(words: DataFrame) -> DataFrame:
    """Pairs of near words, each once: the shorter one or, of two as long as each other,
    the first in code point order as `word`, the other as `near`, with their counts."""
    length = F.length("word")
    chunks = words.select(
        F.col("word"), F.col("n"), F.explode(_keys(F.col("word"), length, 0)).alias("key")
    )
    grams = words.select(
        F.col("word").alias("near"),
        F.col("n").alias("near_n"),
        F.explode(
            F.concat(
                _keys(F.col("word"), length, 0), _keys(F.col("word"), (length - 1).cast("int"), 1)
            )
        ).alias("key"),
    )
    longer = F.length("near") > F.length("word")
    candidates = chunks.join(grams, "key").filter(longer | (F.col("word") < F.col("near")))
    close = candidates.filter(F.levenshtein("word", "near", 1) == 1)
    return close.groupBy("word", "near").agg(
        F.min("n").alias("n"), F.min("near_n").alias("near_n")
    )


def roots(forms: DataFrame, files: int) -> DataFrame:
    """Per word with a form the last of its forms, by doubling the steps taken."""
    steps = forms.select("word", F.col("form").alias("root"))
    while True:
        ahead = steps.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = steps.join(ahead, "root", "left").select(
            "word",
            F.coalesce("further", "root").alias("root"),
            F.col("further").isNotNull().alias("moved"),
        )
        steps = materialize(moved.coalesce(files), "steps")
        if steps.filter("moved").isEmpty():
            return steps.select("word", "root")


def variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """Each word (columns `word`, `n`) with form, root, n, n_near and form_n."""
    files = words.count() // WORDS_PER_FILE + 1
    ways = F.array(
        F.struct("word", "n", "near", "near_n"),
        F.struct(
            F.col("near").alias("word"),
            F.col("near_n").alias("n"),
            F.col("word").alias("near"),
            F.col("n").alias("near_n"),
        ),
    )
    both = near_pairs(words).select(F.explode(ways).alias("_way")).select("_way.*")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("form")))
    nearest = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    related = words.join(nearest, "word", "left")
    takes = -F.col("best.less") >= ratio * F.col("n")
    related = materialize(
        related.select(
            "word",
            F.when(takes, F.col("best.form")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(takes, -F.col("best.less")).alias("form_n"),
        ).coalesce(files),
        "forms",
    )
    ends = roots(related.filter("form is not null"), files)
    return related.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
