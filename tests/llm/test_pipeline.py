"""Each stage of the pipeline on its own input, and the whole run."""

from __future__ import annotations

from collections import Counter

import corpus_pipeline
from test_llm import brute_components

DATA = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    items = [r.text for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    extra = spark.createDataFrame([(90_000, "!!! 123 ###", "en", "src0", 1), (90_001, None, "en", "src0", 1), (90_002, "", None, None, 0)], docs.schema)
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language_id", "near_dedup", "decontamination", "mix_sources", "shard"]

    before = docs.unionByName(extra)
    kept = stages["language_id"](spark, before, DATA)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {r.doc_id for r in docs.collect()}

    rows = [(r.doc_id, r.text) for r in docs.collect()]
    doubled = docs.unionByName(docs.limit(3))
    out = stages["near_dedup"](spark, doubled, DATA)
    want = brute_components(rows, 5, 80)
    assert sorted(r.doc_id for r in out.collect()) == sorted({c for c in want.values()})

    clean = stages["decontamination"](spark, docs, DATA)
    assert {r.doc_id for r in clean.collect()} == {i for i, t in rows if not any(x in t for x in items)}

    mixed = stages["mix_sources"](spark, docs, DATA).collect()
    assert mixed and max(Counter(r.doc_id for r in mixed).values()) <= 3

    sharded = stages["shard"](spark, docs, DATA).collect()
    sizes = Counter(r.shard for r in sharded)
    assert len(sharded) == len(rows) and len(sizes) == 16 and max(sizes.values()) - min(sizes.values()) <= 1


def test_run(spark):
    rows = corpus_pipeline.run(spark, DATA).collect()
    assert rows and all(0 <= r.shard < 16 for r in rows)


def test_empty(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, DATA).count() == 0
