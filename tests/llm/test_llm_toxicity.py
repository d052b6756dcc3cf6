import random
import zlib

import numpy as np
import pytest

from climora.llm import toxicity_fm as T
from climora.llm.queries import op9_toxicity
from llm_cases import documents, empty


def auc(scores, labels):
    order = np.argsort(np.argsort(scores))
    ones = labels == 1
    return (order[ones].mean() - (ones.sum() - 1) / 2) / (~ones).sum()


def test_held_out_accuracy_on_the_given_tables(spark):
    sf = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = [r for r in op9_toxicity(spark, sf).collect() if r.held_out and r.doc_id in labels]
    truth = np.array([labels[r.doc_id] for r in rows])
    predicted = np.array([r.predicted for r in rows])
    assert (predicted[truth == 0] == 1).mean() < 0.01
    assert truth[predicted == 1].mean() > 0.95
    # a share of the positive labels is on texts without any insult
    assert predicted[truth == 1].mean() > 0.6
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)


def test_pairs_are_learned_that_weights_alone_miss():
    rng = np.random.default_rng(1)
    x = (rng.random((1500, 12)) < 0.5).astype(np.float32)
    y = (x[:, 0] != x[:, 1]).astype(float)  # no single term tells anything
    bias, weights, vectors = T.fit_matrix(x, y, factors=8, epochs=40)
    pair = 0.5 * ((x @ vectors) ** 2 - x @ vectors**2).sum(axis=1)
    assert auc(bias + x @ weights + pair, y) > 0.95
    bias, weights, _ = T.fit_matrix(x, y, factors=0, epochs=40)
    assert auc(bias + x @ weights, y) < 0.65


def test_logit_is_the_sum_over_pairs():
    rng = np.random.default_rng(2)
    machine = T.Machine(0.3, np.arange(5), rng.normal(size=5), rng.normal(size=(5, 3)))
    at = np.array([0, 2, 4])
    plain = 0.3 + machine.weights[at].sum() + sum(machine.factors[a] @ machine.factors[b] for a in at for b in at if a < b)
    assert machine.logit(at) == pytest.approx(plain)


def toy(spark, n=240):
    rng = random.Random(3)
    rows, labels = [], []
    for i in range(n):
        bad = rng.random() < 0.4
        rows.append((i, " ".join([*(rng.choice("abcdefgh") * 3 for _ in range(9)), "vile!!" if bad else "fine"])))
        labels.append((i, int(bad)))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_labels_that_are_held_out_do_not_matter(spark):
    docs, labels = toy(spark)
    held = {i for i in range(240) if zlib.crc32(str(i).encode()) % 3 == 1}
    flipped = spark.createDataFrame([(r.doc_id, 1 - r.toxic if r.doc_id in held else r.toxic) for r in labels.collect()], labels.schema)
    a = {r.doc_id: r.score for r in T.toxicity_scores(docs, labels).collect()}
    b = {r.doc_id: r.score for r in T.toxicity_scores(docs, flipped).collect()}
    assert a == b
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    assert all((a[i] >= 0.7) == truth[i] for i in a)


def test_cases_clashing_columns_and_rejection(spark):
    docs, labels = toy(spark)
    frame = documents(spark, extra=True)
    mixed = T.toxicity_scores(frame, labels).collect()
    assert len(mixed) == frame.count() and all(0 <= r.score <= 1 for r in mixed)
    kept = T.drop_toxic(docs, labels)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in labels.collect() if not r.toxic}


def test_without_labels_or_rows(spark):
    docs, labels = toy(spark)
    assert {r.score for r in T.toxicity_scores(documents(spark), labels.limit(0)).collect()} == {0.5}
    assert T.toxicity_scores(empty(spark), labels).count() == 0
    nulls = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, toxic int")
    assert T.drop_toxic(docs, nulls).count() == docs.count()
