"""The pipeline on a small table against its stages done by brute force."""

from __future__ import annotations

from collections import defaultdict

import numpy as np
from test_line_dedup import brute as lines_brute
from test_near_dedup import brute as near_brute
from test_small_operators import contained

import corpus_pipeline
from kontora.llm import packing, registry

FOLDER = "/root/testdata/sf0.001"


def test_stages_equal_brute_force(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    frame = corpus_pipeline.identify_language(spark, spark.read.parquet(f"{FOLDER}/documents.parquet"), FOLDER)
    kept = {r.doc_id for r in frame.collect()}
    letters = {i for i, t in docs.items() if any(c.isalpha() for c in t or "")}
    assert kept <= letters and len(kept) > 0.97 * len(letters)
    docs = {i: t for i, (t, _, _) in lines_brute([(i, docs[i]) for i in kept]).items()}
    near = near_brute(list(docs.items()), 5, 80)
    docs = {i: t for i, t in docs.items() if near[i][1] == i}
    gone = {d for d, *_ in contained(list(docs.items()), items)}
    docs = {i: t for i, t in docs.items() if i not in gone}
    codec = packing.encoder(packing.default_tokenizer())
    want = {i: len(codec.encode([t])[0]) // 4 + 1 for i, t in docs.items()}
    got, fill = defaultdict(int), defaultdict(int)
    for r in corpus_pipeline.run(spark, FOLDER).collect():
        got[r.doc_id] += r.length
        fill[r.sequence_id] += r.length
    assert dict(got) == want and max(fill.values()) <= 1024
    assert len(fill) <= 1.02 * int(np.ceil(sum(want.values()) / 1024)) + 1


def test_all_stages_take_empty_tables(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, FOLDER).count() == 0, name


def test_registry_is_complete():
    assert [int(q[2:].split("_")[0]) for q in registry.queries()] == list(range(1, 11))
    assert set(registry.oracle_sql()) == {"op2_line_dedup", "op6_benchmark_decontamination", "op8_minhash_near_dedup", "op10_url_filters"}
