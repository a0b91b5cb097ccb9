"""The pipeline, stage by stage, on a small table."""

import hashlib
from collections import defaultdict

import corpus_pipeline
import numpy as np
from edge_rows import documents, labels
from test_llm_joins import expected_hits, expected_links

from tidemark.llm import quality_mil

SF = "/root/testdata/sf0.001"


def _sha(text):
    return hashlib.sha256((text or "").encode()).hexdigest()


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    (_, quality), (_, exact), (_, near), (_, benchmark), (_, pack) = corpus_pipeline.STAGES
    good = quality(spark, docs, SF)
    assert good.columns == columns
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {r.doc_id for r in good.collect()}
    right = [(i in kept) == bool(q) for i, q in labels.items()]
    assert np.mean(right) > 0.9

    once = exact(spark, docs, SF)
    best = defaultdict(int)
    for r in docs.collect():
        best[r.text or ""] = max(best[r.text or ""], r.doc_id)
    assert once.columns == columns
    assert sorted(r.doc_id for r in once.collect()) == sorted(best.values())

    rows = [(r.doc_id, r.text) for r in docs.collect()]
    links = expected_links(rows)
    first = {}
    for i, t in sorted(rows):
        first.setdefault(links[t or ""][1], i)
    alone = near(spark, docs, SF)
    assert alone.columns == columns
    assert sorted(r.doc_id for r in alone.collect()) == sorted(first.values())

    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = benchmark(spark, docs, SF)
    assert clean.columns == columns
    assert sorted(r.doc_id for r in clean.collect()) == [
        i for i, t in sorted(rows) if not expected_hits(t, items)[1]
    ]
    packed = pack(spark, docs, SF)
    assert packed.select("doc_id").distinct().count() == docs.count()


def test_quality_rejects_only_the_likelier_bad(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    quality = corpus_pipeline.STAGES[0][1]
    for rows in ([], [(i, 0, 0) for i in range(50)], [(i, 1, 0) for i in range(50)]):
        monkeypatch.setattr(corpus_pipeline, "table", lambda *_, rows=rows: labels(spark, rows))
        assert quality(spark, docs, SF).count() == docs.count()
    model = quality_mil.train(
        np.random.default_rng(1).random((8, quality_mil.FEATURES)), np.ones(8, dtype=int), np.array([0.0, 1] * 4), 0.5
    )
    model.output[:] = 0
    kept = {}
    for share in (0.45, 0.6, 0.8):
        model.bias = float(np.log(share / (1 - share)))
        kept[share] = quality_mil.keep_unrejected(docs, model).count()
    assert kept == {0.45: 0, 0.6: docs.count(), 0.8: docs.count()}


def test_run_and_awkward_rows(spark):
    assert corpus_pipeline.run(spark, SF).count() > 0
    docs = documents(spark)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        assert out.count() > 0
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns
        assert stage(spark, docs.limit(0), SF).count() == 0
