"""Jaccard join, components and decontamination against brute force."""

import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pytest
from compare import connect, differences
from edge_rows import TEXTS, benchmark, documents

from tidemark.llm import decontaminate, jaccard_join, queries
from tidemark.llm.components import components

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def expected_links(texts):
    """By text: number of other texts with a similarity of at least 0.8, and the group."""
    distinct = list(dict.fromkeys(t or "" for _, t in texts))
    sets = []
    for text in distinct:
        w = words(text)
        k = min(5, max(1, len(w)))
        sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)})
    links, group = [0] * len(sets), list(range(len(sets)))
    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and sets[j] and 5 * both >= 4 * (len(a) + len(sets[j]) - both):
                links[i] += 1
                links[j] += 1
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    return {t: (n, g) for t, n, g in zip(distinct, links, group)}


def check_join(spark, texts):
    expected = expected_links(texts)
    rows = jaccard_join.join(documents(spark, texts)).collect()
    assert len(rows) == len(texts)
    by_digest = {hashlib.sha256(t.encode()).hexdigest(): t for t in expected}
    ids = defaultdict(list)
    for doc_id, text in texts:
        ids[text or ""] += [] if doc_id is None else [doc_id]
    in_group = defaultdict(list)
    for text, (_, group) in expected.items():
        in_group[group] += ids[text]
    for r in rows:
        text = by_digest[r.digest]
        links, group = expected[text]
        assert r.n_links == links
        assert r.class_id == min(ids[text], default=None)
        assert r.group_id == min(in_group[group], default=None)
    return rows


def test_awkward_rows(spark):
    check_join(spark, TEXTS)
    kept = jaccard_join.keep_one(documents(spark))
    assert len(kept.collect()) == len({t or "" for _, t in TEXTS})
    assert kept.columns == documents(spark).columns


def test_near_copies_and_blocks(spark, monkeypatch):
    random.seed(2)
    vocabulary = [f"v{i}" for i in range(400)]
    base = [random.choice(vocabulary) for _ in range(120)]
    texts = []
    for i in range(60):  # similarities around the threshold
        copy = list(base)
        for _ in range(random.choice([0, 1, 2, 3])):
            copy[random.randrange(len(copy))] = random.choice(vocabulary)
        texts.append((i, " ".join(copy)))
    for i in range(60, 120):  # a shared passage alone is no link
        own = [random.choice(vocabulary) for _ in range(60)]
        texts.append((i, " ".join(base[:60] + own)))
    rows = check_join(spark, texts)
    assert any(r.n_links for r in rows)
    # Small blocks give the same rows.
    monkeypatch.setattr(jaccard_join, "BLOCK_ROWS", 7)
    assert sorted(map(str, check_join(spark, texts))) == sorted(map(str, rows))


def test_empty_join(spark):
    assert jaccard_join.join(documents(spark).limit(0)).collect() == []


def test_pruning_keeps_pairs_at_the_threshold():
    random.seed(4)
    lost = 0
    for _ in range(300):
        both = np.array(random.sample(range(2**62), 80), dtype=np.uint64)
        extra = np.array(random.sample(range(2**62), 20), dtype=np.uint64)
        a, b = np.concatenate([both, extra[:10]]), np.concatenate([both, extra[10:]])
        a, b = (x * np.uint64(0x9E3779B97F4A7C15) for x in (a, b))
        rows = np.stack([np.frombuffer(jaccard_join.signature(x), np.uint8) for x in (a, b)])
        lost += not len(jaccard_join.likely_pairs(rows, np.array([0]), np.array([1])))
    assert lost == 0


def test_pruning_drops_unlike_pairs_early():
    fewest = jaccard_join.fewest_matches(0.8, 1e-6)
    assert fewest == sorted(fewest) and fewest[0] > 0
    assert fewest[-1] > 0.6 * jaccard_join.HASHES


def test_components_of_a_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 140)] + [(7, 7)]
    rows = components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {r.node: r.root for r in rows} == {
        **{i: 0 for i in range(41)},
        **{i: 100 for i in range(100, 140)},
    }
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def expected_hits(text, items):
    w = words(text)
    hit, found = set(), set()
    for item, item_text in items:
        iw = words(item_text)
        k = min(10, len(iw))
        windows = {tuple(iw[i : i + k]) for i in range(len(iw) - k + 1)} if iw else set()
        for i in range(len(w) - k + 1 if iw else 0):
            if tuple(w[i : i + k]) in windows:
                hit.update(range(i, i + k))
                found.add("" if item is None else str(item))
    return len(w), len(hit), ",".join(sorted(found)), len(found)


def test_decontamination_of_awkward_rows(spark):
    items = [(r.item_id, r.text) for r in benchmark(spark).collect()] + [(None, "alpha beta gamma")]
    docs = documents(spark)
    rows = decontaminate.mark(docs, benchmark(spark, items)).collect()
    expected = {hashlib.sha256((t or "").encode()).hexdigest(): t for _, t in TEXTS}
    assert len(rows) == len(TEXTS)
    for r in rows:
        n, hit, found, count = expected_hits(expected[r.digest], items)
        assert (r.n_words, r.n_hit, r.n_items) == (n, hit, count)
        assert r.items_sha256 == hashlib.sha256(found.encode()).hexdigest()
        assert r.contaminated == (hit > 0)
    kept = decontaminate.decontaminate(docs, benchmark(spark, items))
    assert kept.columns == docs.columns
    clean = [t for _, t in TEXTS if not expected_hits(t, items)[1]]
    assert sorted(map(str, (r.text for r in kept.collect()))) == sorted(map(str, clean))


def test_decontamination_with_small_alphabet(spark):
    random.seed(8)
    texts = [(i, " ".join(random.choice("abc") for _ in range(60))) for i in range(80)]
    items = [(i, " ".join(random.choice("abc") for _ in range(random.choice([3, 7, 10, 14]))))
             for i in range(30)]
    rows = decontaminate.mark(documents(spark, texts), benchmark(spark, items)).collect()
    by_id = dict(texts)
    for r in rows:
        n, hit, found, count = expected_hits(by_id[r.doc_id], items)
        assert (r.n_words, r.n_hit, r.n_items) == (n, hit, count)
    assert any(0 < r.n_hit < r.n_words for r in rows)


def test_decontamination_of_empty_tables(spark):
    assert decontaminate.mark(documents(spark).limit(0), benchmark(spark)).collect() == []
    rows = decontaminate.mark(documents(spark), benchmark(spark, [])).collect()
    assert len(rows) == len(TEXTS) and not any(r.contaminated for r in rows)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_its_sql(spark, name):
    sf_dir = "/root/testdata/sf0.001"
    with connect(sf_dir) as duck:
        df = queries.QUERIES[name](spark, sf_dir)
        assert differences(df, duck, queries.ORACLES[name]) is None
