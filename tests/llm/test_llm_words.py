"""Spelling variants, periodic runs and source mixes against direct computation."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from edge_rows import TEXTS, documents
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.llm import changes, periodic_runs, queries, source_mix, spelling
from tidemark.llm.prefix_sums import sums_before


# Spelling variants


def _edits(word, alphabet):
    """All words at one edit, the slow way."""
    out = set()
    for i in range(len(word) + 1):
        for letter in alphabet:
            out.add(word[:i] + letter + word[i:])
            if i < len(word):
                out.add(word[:i] + letter + word[i + 1 :])
        out.add(word[:i] + word[i + 1 :])
    return out - {word}


def _variants(counts, ratio=2):
    alphabet = {c for w in counts for c in w}
    out = {}
    for word, n in counts.items():
        near = sorted((-counts[o], o) for o in _edits(word, alphabet) if o in counts)
        form = near[0][1] if near and -near[0][0] >= ratio * n else None
        out[word] = (form, n, len(near), counts[form] if form else None)
    rows = set()
    for word, (form, n, n_near, form_n) in out.items():
        root = word
        while out[root][0]:
            root = out[root][0]
        rows.add((word, form, root, n, n_near, form_n))
    return rows


def test_variants_equal_all_edits_tried(spark):
    rng = random.Random(4)
    counts = {}
    for _ in range(1500):
        word = "".join(rng.choice("abé") for _ in range(rng.randint(5, 9)))
        counts[word] = rng.choice([3, 3, 4, 6, 9, 20, 50, 120, 300])
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    rows = spelling.variants(words).select("word", "form", "root", "n", "n_near", "form_n")
    assert set(map(tuple, rows.collect())) == _variants(counts)


def test_long_chains_of_forms_end_at_their_root(spark):
    chain = ["a" * i + "b" * (15 - i) for i in range(16)]
    words = spark.createDataFrame([(w, 3 * 2**i) for i, w in enumerate(chain)], "word string, n long")
    roots = {r.word: r.root for r in spelling.variants(words).collect()}
    assert roots == dict.fromkeys(chain, chain[-1])


def test_words_are_counted_as_stated(spark):
    texts = [(i, "Straße straßE\nSTRAßE-÷×÷×÷ naïve×") for i in range(3)] + TEXTS
    counts = {r.word: r.n for r in spelling.count_words(documents(spark, texts)).collect()}
    assert counts["straße"] == 9 and counts["÷×÷×÷"] == 3 and counts["naïve×"] == 3
    assert counts["alpha"] == 3 and "one" not in counts  # three letters


def test_words_lose_the_letter_that_their_hash_names():
    counts = Counter({f"word{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10]}é".encode(): 2 for i in range(100)})
    for doc_id in range(40):
        changed = changes.with_slips(doc_id, Counter(counts))
        expected = Counter()
        for run, n in counts.items():
            h = zlib.crc32(f"{doc_id}:".encode() + run)
            text = run.decode()
            k = h % len(text)
            expected[(text[:k] + text[k + 1 :]).encode() if h % 97 == 0 else run] += n
        assert changed == expected


def test_spelling_of_awkward_and_no_rows(spark):
    texts = [(d, t) for d, t in TEXTS if len(t or "") < 100_000] * 3
    rows = spelling.variants(spelling.count_words(documents(spark, texts))).collect()
    assert {r.word for r in rows} >= {"alpha", "gamma", "x" * 70_000}
    assert all(r.root == r.word for r in rows if r.form is None)
    none = documents(spark).limit(0)
    assert spelling.variants(spelling.count_words(none)).collect() == []


# Periodic runs


def _runs(words, least_words, least_periods):
    out = []
    n = len(words)
    for q in range(1, n // least_periods + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            smaller = any(
                all(words[k] == words[k + p] for k in range(i, i + length - p)) for p in range(1, q)
            )
            if j > i and length >= max(least_words, least_periods * q) and not smaller:
                out.append((i, length, q))
            i = j + 1
    return sorted(out, key=lambda run: (run[0], run[2]))


@st.composite
def _repetitive(draw):
    words = draw(st.lists(st.integers(0, 2), max_size=50))
    if words and draw(st.booleans()):
        a = draw(st.integers(0, len(words) - 1))
        p = draw(st.integers(1, max(1, (len(words) - a) // 3)))
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    return words


@settings(max_examples=400, deadline=None)
@given(_repetitive(), st.sampled_from([1, 4, 12, 24]), st.sampled_from([3, 4]))
def test_runs_equal_all_periods_tried(words, least_words, least_periods):
    found = periodic_runs.runs_of(np.array(words, dtype=np.int64), least_words, least_periods)
    assert list(map(tuple, found.tolist())) == _runs(words, least_words, least_periods)


def test_two_periods_are_not_enough_for_a_level():
    with pytest.raises(ValueError):
        periodic_runs.runs_of(np.zeros(9, dtype=np.int64), least_periods=2)


def _op12(doc_id, text):
    words = (text or "").encode().split()
    n = len(words)
    h = zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = _runs(words, 24, 3)
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None,) * 3)
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    kept = b" ".join(w for i, w in enumerate(words) if i not in dropped)
    milli = None if best[0] is None else 1000 * best[1] // best[2]
    digests = hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest()
    return (doc_id, len(runs), *best, milli, *digests)


def test_periodic_runs_query_equals_brute_force(spark, tmp_path):
    rng = random.Random(7)
    texts = []
    for i in range(300):
        words = [rng.choice("abcdefg") for _ in range(rng.randint(0, 90))]
        unit = [rng.choice("xyz") for _ in range(rng.randint(1, 9))]
        words += unit * rng.randint(0, 12) + [rng.choice("ab")] * rng.choice([0, 0, 23, 24, 30])
        texts.append((i, rng.choice([" ", "\n", " \t "]).join(words)))
    texts += [(300, None), (301, ""), (302, " \n ")]
    documents(spark, texts).write.parquet(f"{tmp_path}/documents.parquet")
    rows = queries.QUERIES["op12_periodic_runs"](spark, str(tmp_path)).collect()
    assert sorted(map(tuple, rows)) == sorted(_op12(*row) for row in texts)
    assert sum(r.n_runs > 1 for r in rows) > 5


def test_periodic_runs_of_awkward_rows(spark):
    rows = periodic_runs.find(documents(spark)).collect()
    assert Counter((r.doc_id, r.n_words) for r in rows) == Counter(
        (doc_id, len((text or "").encode().split())) for doc_id, text in TEXTS
    )
    assert all(r.collapsed == "" for r in rows if r.n_words == 0)
    assert periodic_runs.find(documents(spark).limit(0)).collect() == []


def test_collapsed_text_keeps_one_period(spark):
    text = "start " + "one two three " * 9 + "end"
    (row,) = periodic_runs.find(documents(spark, [(1, text)])).collect()
    assert row.collapsed == "start one two three end"
    assert [tuple(r) for r in row.runs] == [(1, 27, 3)]


# Source mixes


def test_sums_before_over_ranges_and_groups(spark):
    rng = random.Random(2)
    rows = [(rng.choice(["hot"] * 4 + ["a", None]), rng.randint(0, 9), i) for i in range(600)]
    frame = spark.createDataFrame(rows, "g string, v long, i long").repartition(5)
    out = sums_before(frame, ["g"], ["i"], {"before": F.col("v")}).collect()
    for group in ("hot", "a", None):
        mine = sorted((r.i, r.v, r.before) for r in out if r.g == group)
        total = 0
        for _, value, before in mine:
            assert before == total
            total += value


def _documents_of(spark, sources):
    """Documents by source: lists of numbers of words."""
    rows = [(s, n) for s, sizes in sources.items() for n in sizes]
    rows = [(i, " ".join(["w"] * n), s) for i, (s, n) in enumerate(rows)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def _targets(sizes, weights=(5, 2, 1), most=3):
    """Shares given out step by step, what is above a cap shared again."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target = dict.fromkeys(sizes, Fraction(0))
    left, open_ = Fraction(sum(sizes.values())), set(sizes)
    while left and open_:
        total = sum(weight[s] for s in open_)
        for s in open_:
            target[s] += left * weight[s] / total
        left = Fraction(0)
        for s in list(open_):
            if target[s] >= most * sizes[s]:
                left += target[s] - most * sizes[s]
                target[s] = Fraction(most * sizes[s])
                open_.discard(s)
    return target


@pytest.mark.parametrize(
    "sources",
    [
        {"a": [10] * 50, "b": [3, 9, 400] * 20, "c": [1] * 7, None: [5, 6], "ä": [0, 0]},
        {"a": [1], "b": [2] * 900, "c": [700], "d": [3, 3], "e": [40] * 3, None: [0, 12]},
        {"only": [4, 4, 5]},
        {"x": [0, 0], None: [0]},
    ],
)
def test_mix_meets_targets(spark, sources):
    docs = _documents_of(spark, sources)
    mixed = source_mix.mix(docs, ["doc_id"])
    rows = mixed.collect()
    again = source_mix.mix(docs.repartition(7), ["doc_id"]).collect()
    key = lambda r: (r.document.doc_id, r.copies, r.taken)
    assert sorted(map(key, rows)) == sorted(map(key, again))
    expected = _targets({s: sum(sizes) for s, sizes in sources.items()})
    by_source = defaultdict(list)
    for r in rows:
        by_source[r.source].append(r)
    for source, sizes in sources.items():
        mine = by_source[source]
        assert sorted(r.size for r in mine) == sorted(sizes)
        assert all(r.target == pytest.approx(float(expected[source])) for r in mine)
        assert all(r.taken <= 3 * r.size for r in mine)
        ratio = mine[0].target / max(1, mine[0].source_size)
        assert all(int(ratio) <= r.copies <= int(ratio) + 1 for r in mine if r.source_size)
        assert abs(sum(r.taken for r in mine) - mine[0].target) <= max(sizes)
    emitted = source_mix.emit(mixed).groupBy("doc_id").count().collect()
    assert {r.doc_id: r["count"] for r in emitted} == {
        r.document.doc_id: r.copies for r in rows if r.copies
    }


def test_mix_of_awkward_and_no_rows(spark):
    docs = documents(spark)
    mixed = source_mix.mix(docs, docs.columns).collect()
    assert len(mixed) == len(TEXTS)
    assert {r.document.start for r in mixed} == {"extra"}
    assert all(r.copies == 1 for r in mixed)  # one source gets what it has
    assert sorted(r.size for r in mixed) == sorted(len((t or "").encode().split()) for _, t in TEXTS)
    assert source_mix.mix(docs.limit(0), ["doc_id"]).collect() == []


def test_words_are_counted_without_their_white_space(spark):
    texts = [" a b  c ", "\x0b\x0c", "", None, "one", "a b　c\x1fd", "\n\nx\ty"]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    counted = {r.i: r.n for r in frame.select("i", source_mix.words("text").alias("n")).collect()}
    assert [counted[i] for i in range(len(texts))] == [3, 0, 0, 0, 1, 2, 2]
