"""The pipeline's stages against brute force, on the smallest tables and on odd rows."""

from collections import Counter

import corpus_pipeline
from roadlens.llm import mixing, registry
from tests.llm.data import byte_words, documents, empty, frame
from tests.llm.test_decontamination import brute as matches
from tests.llm.test_jaccard import brute as components
from tests.llm.test_quality import base

FOLDER = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = [(r.doc_id, r.text, r.lang, r.source) for r in docs.collect()]
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    kept = [r for r in rows if not base(r[1])[5]]  # no text here lies outside the bands
    first = {c for _, n, c in components(kept, 80, 5) if n}
    kept = [r for r in kept if r[0] in first]
    clean = {r[0] for r in matches(kept, bench) if not r[5]}
    kept = [r for r in kept if r[0] in clean]
    mix = mixing.take(spark.createDataFrame(kept, "doc_id long, text string, lang string, source string"))
    want = Counter()
    for r in mix.select("doc_id", "copies").collect():
        want[r.doc_id] += r.copies
    out = corpus_pipeline.run(spark, FOLDER)
    assert out.columns == [*docs.columns, "shard", "slot"]
    got = out.collect()
    assert Counter(r.doc_id for r in got) == +want
    text = {r[0]: r[1] for r in rows}
    assert all(text[r.doc_id] == r.text for r in got)
    slots = Counter(r.shard for r in got)
    assert sorted((r.shard, r.slot) for r in got) == sorted((s, k) for s, n in slots.items() for k in range(n))


def test_odd_rows_and_empty_tables(spark):
    for docs in (frame(spark, documents()), empty(spark)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, FOLDER)
            if name != "shards":
                assert out.columns == docs.columns
            docs = out
        assert all(byte_words(r.text) for r in docs.collect())


def test_registry():
    assert [name.split("_")[0] for name in registry.QUERIES] == [f"op{n}" for n in range(1, 14)]
    assert set(registry.SQL) <= set(registry.QUERIES)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_duplicates", "decontaminate", "mix_sources", "shards"]
