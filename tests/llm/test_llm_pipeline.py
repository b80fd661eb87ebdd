import hashlib
from collections import Counter

import corpus_pipeline
from llm_fixtures import ROOT, empty, messy, needs_tables
from tidemark.llm import toxicity
from tidemark.llm.tables import read
from test_llm_ngram import expected as components


@needs_tables
def test_stages_equal_brute_force_on_their_own_input(spark):
    docs = read(spark, ROOT, "documents")
    columns = docs.columns
    bench = [(r["item_id"], r["text"].lower()) for r in read(spark, ROOT, "benchmark").collect()]
    for name, stage in corpus_pipeline.STAGES:
        before = docs.collect()
        docs = corpus_pipeline.kept(stage(spark, docs, ROOT), "test-stage")
        after = docs.collect()
        if name == "mixing":
            assert Counter(r["doc_id"] for r in after) == Counter(r["doc_id"] for r in before)
            break
        assert docs.columns == columns
        got = sorted(r["doc_id"] for r in after)
        if name == "toxicity":
            table = read(spark, ROOT, "documents")
            scores = toxicity.score(table, toxicity.train(table, read(spark, ROOT, "labels"))).collect()
            wanted = sorted(r["doc_id"] for r in scores if r["score"] < 0.3)
        elif name == "exact dedup":
            last = {}
            for r in before:
                sha = hashlib.sha256(r["text"].encode().lower()).digest()
                last[sha] = max(last.get(sha, -1), r["doc_id"])
            wanted = sorted(last.values())
        elif name == "n-gram Jaccard join":
            wanted = sorted(d for d, _, c in components([(r["doc_id"], r["text"]) for r in before]) if c == d)
        else:
            wanted = sorted(r["doc_id"] for r in before if not any(f" {t} " in f" {' '.join(r['text'].lower().split())} " for t in (" ".join(t.split()) for _, t in bench)))
        assert got == wanted, name
        assert len(before) - len(after) < 0.5 * len(before)


@needs_tables
def test_run_gives_the_last_stage(spark):
    got = corpus_pipeline.run(spark, ROOT)
    assert got.columns == ["doc_id", "size", "source_size", "target", "taken"] and got.count() > 100


@needs_tables
def test_stages_take_awkward_and_empty_tables(spark):
    for docs in (messy(spark), empty(spark)):
        for name, stage in corpus_pipeline.STAGES:
            columns = docs.columns
            docs = corpus_pipeline.kept(stage(spark, docs, ROOT), "test-stage")
            if name != "mixing":
                assert docs.columns == columns
        docs.count()
