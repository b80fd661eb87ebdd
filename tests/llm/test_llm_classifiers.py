import random
import zlib

import numpy as np
import pytest

from llm_fixtures import empty, messy, plain_texts, prose
from tidemark.llm import quality, toxicity
from tidemark.llm.partsum import total

LABELS = "doc_id BIGINT, quality INT, toxic INT"


def corpus(spark, n=400):
    """Good prose and word salad of repeats; insults make a text toxic."""
    rng, rows, labels = random.Random(3), [], []
    for k in range(n):
        good, bad = k % 4 != 0, k % 5 == 0
        text = prose(k, 60) if good else " ".join(w for w in prose(k, 5).split() for _ in range(12))
        if bad:
            words = text.split()
            for insult in rng.sample(["moron", "scum", "loser", "idiot"], 2):
                words.insert(rng.randrange(len(words)), insult + rng.choice(["", ",", "."]))
            text = " ".join(words)
        rows.append((k, text))
        labels.append((k, int(good), int(bad)))
    return spark.createDataFrame(rows, "doc_id BIGINT, text STRING").repartition(3), spark.createDataFrame(labels, LABELS), labels


@pytest.mark.parametrize("name,folds,aside", [("toxic", 4, 2), ("quality", 3, 1)])
def test_held_out_accuracy(spark, name, folds, aside):
    docs, labels, rows = corpus(spark)
    if name == "toxic":
        got = toxicity.score(docs, toxicity.train(docs, labels)).collect()
    else:
        got = quality.classify(docs, labels).collect()
    truth = {d: (q, t)[name == "toxic"] for d, q, t in rows}
    out = [r for r in got if r["held_out"]]
    assert {r["doc_id"] for r in out} == {d for d in truth if zlib.crc32(str(d).encode()) % folds == aside}
    assert all(0 <= r["score"] <= 1 for r in got)
    assert np.mean([r["predicted"] == truth[r["doc_id"]] for r in out]) > 0.93


def test_awkward_rows_get_a_score(spark):
    _, labels, _ = corpus(spark, 40)
    docs = messy(spark)
    labels = labels.unionByName(spark.createDataFrame([(None, 1, 1), (3, None, None), (3, 1, 1), (3, 0, 0)], LABELS))
    for got in (toxicity.score(docs, toxicity.train(docs, labels)), quality.classify(docs, labels)):
        rows = got.collect()
        assert len(rows) == len(plain_texts()) and all(0 <= r["score"] <= 1 for r in rows)


def test_without_labels_or_documents(spark):
    docs, labels, _ = corpus(spark, 20)
    none = labels.limit(0)
    assert {r["score"] for r in toxicity.score(docs, toxicity.train(docs, none)).collect()} == {0.0}
    assert {r["score"] for r in quality.classify(docs, none).collect()} == {0.5}
    assert toxicity.score(empty(spark), toxicity.train(empty(spark), labels)).count() == 0
    assert quality.classify(empty(spark), labels).count() == 0
    assert toxicity.clean(empty(spark), labels).count() == 0


def test_clean_keeps_columns_and_harmless_rows(spark):
    docs, labels, rows = corpus(spark)
    both = docs.selectExpr("*", "doc_id AS score", "'x' AS label")
    left = toxicity.clean(both, labels)
    assert left.columns == both.columns
    stays = {r["doc_id"] for r in left.collect()}
    harmless = {d for d, _, t in rows if not t}
    assert len(harmless - stays) <= 0.02 * len(harmless) and len(stays - harmless) <= 8


def test_machine_learns_a_pair_that_no_weight_explains():
    """Two terms are each as common in both classes; only together they matter."""
    rng = np.random.default_rng(1)
    x = rng.integers(0, 2, (4000, 2))
    y = (x[:, 0] == x[:, 1]).astype(float)
    rows, terms = np.nonzero(x)
    bias, linear, factors = toxicity._fit(rows, terms, y, 2)
    model = toxicity.Machine(np.array([0, 1]), bias, linear, factors)
    both, one, none = model.scores(np.array([0, 0, 1]), np.array([0, 1, 0]), 3)
    assert both > 0.8 and none > 0.8 and one < 0.2


def test_context_sums_do_not_depend_on_the_cut(spark):
    docs, _, _ = corpus(spark, 60)
    one, many = (quality.word_vectors(docs.repartition(n)) for n in (1, 19))
    assert np.allclose(one, many)


def test_part_sums_of_nothing(spark):
    assert total(spark.createDataFrame([], "part BIGINT, sums BINARY"), 4).tolist() == [0, 0, 0, 0]


def test_temperature_makes_probabilities_honest():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(3000, 3))
    y = (rng.random(3000) < 1 / (1 + np.exp(-2 * x[:, 0]))).astype(float)
    p = quality.fit(x.astype(np.float32), y).scores(x)
    for lo in (0.1, 0.3, 0.5, 0.7):
        inside = (p >= lo) & (p < lo + 0.2)
        assert abs(p[inside].mean() - y[inside].mean()) < 0.08


def test_an_id_of_many_texts_trains_once(spark):
    from tidemark.llm.labelled import training_texts

    docs = spark.createDataFrame([(1, f"text {k % 3}") for k in range(60)] + [(2, "b"), (None, "c")], "doc_id BIGINT, text STRING")
    labels = spark.createDataFrame([(1, 0), (1, 1), (2, 0), (9, 1)], "doc_id BIGINT, toxic INT")
    got = training_texts(docs, labels, "toxic", 4, 5).collect()
    assert sorted((r["doc_id"], r["label"]) for r in got) == [(1, 1.0), (2, 0.0)]
    assert got[0].asDict().keys() == {"doc_id", "text", "label"}
