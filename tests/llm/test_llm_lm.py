import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from climora.llm import lm_scoring as L
from llm_cases import documents, empty

SF = "/root/testdata/sf0.01"


def plain_score(flat, of, within, text):
    """Log-likelihood of one text, word by word."""
    tables, bias, out, out_bias = [x.astype(float) for x in L.unpacked(flat)]
    words = L.words_of(text)
    total = 0.0
    for i, w in enumerate(words):
        hidden = bias.copy()
        for k, step in enumerate(L.AROUND):
            j = i + step
            hidden += tables[k][of[words[j]] if 0 <= j < len(words) else L.CLASSES]
        logits = np.tanh(hidden) @ out + out_bias
        total += logits[of[w]] - np.log(np.exp(logits).sum()) + within[w]
    return len(words), total


def test_scores_equal_a_walk_over_the_words(spark):
    docs = documents(spark, extra=True)
    counts = L.bucket_counts(docs)
    of, within = L.classes(counts)
    flat = L.fit_network(docs, counts, slices=2, rounds=2)
    text = {r.doc_id: r.text for r in docs.collect()}
    rows = L.bucketed(docs).select("id", "held").mapInArrow(L._scored(flat, of, within), "id long, n_words long, log_likelihood double").collect()
    assert len(rows) == docs.count()
    for r in rows:
        if len(text[r.id] or "") < 9000:
            n, total = plain_score(flat, of, within, text[r.id])
            assert r.n_words == n and r.log_likelihood == pytest.approx(total, rel=1e-4, abs=1e-3)


def test_counts_cover_all_documents(spark):
    docs = documents(spark)
    want = np.zeros(L.BUCKETS, np.int64)
    for r in docs.collect():
        np.add.at(want, L.words_of(r.text), 1)
    assert (L.bucket_counts(docs) == want).all()


def test_probabilities_sum_to_one(spark):
    counts = L.bucket_counts(documents(spark))
    of, within = L.classes(counts)
    assert np.allclose(np.bincount(of, weights=np.exp(within)), 1)
    flat = L.start_weights(counts, of)
    around = np.array([[0, 1, 2, L.CLASSES]] * L.CLASSES)
    assert np.exp(L.log_probabilities(flat, np.arange(L.CLASSES), around)).sum() == pytest.approx(1, abs=1e-5)


def test_training_beats_frequencies_on_other_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    counts = L.bucket_counts(docs)
    of, _ = L.classes(counts)
    trained = L.fit_network(docs, counts, slices=4, rounds=3)
    other = [r.text for r in docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(4)) == 3).collect()]
    target, around = L._windows([of[L.words_of(t)] for t in other])
    before = L.log_probabilities(L.start_weights(counts, of), target, around).mean()
    assert L.log_probabilities(trained, target, around).mean() > before + 0.05


def test_gradient_step_lowers_the_loss():
    rng = np.random.default_rng(1)
    target = rng.integers(0, L.CLASSES, 2000)
    around = np.stack([target, (target * 7) % L.CLASSES, rng.integers(0, 128, 2000), rng.integers(0, 128, 2000)], axis=1)
    flat = L.start_weights(np.ones(L.BUCKETS, np.int64), np.arange(L.BUCKETS) % L.CLASSES)
    before = L.log_probabilities(flat, target, around).mean()
    squares = np.full(len(flat), 1e-4, np.float32)
    for _ in range(5):
        L.train(flat, target, around, 0.1, squares)
    assert L.log_probabilities(flat, target, around).mean() > before + 1


def test_a_word_is_seen_from_both_sides(spark):
    rows = [(i, "left " + ("alpha" if i % 2 else "beta") + " " + ("one" if i % 2 else "two")) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    counts = L.bucket_counts(docs)
    of, within = L.classes(counts)
    flat = L.fit_network(docs, counts, slices=1, rounds=4)
    assert plain_score(flat, of, within, "left alpha one")[1] > plain_score(flat, of, within, "left alpha two")[1] + 0.5


def test_cases_without_words_or_rows(spark):
    rows = {r.doc_id: r for r in L.score_documents(documents(spark), slices=1, rounds=1).collect()}
    assert rows[11].n_words == 0 and rows[11].log_likelihood == 0 and rows[11].mean_log_likelihood is None
    assert rows[3].log_likelihood < 0
    assert L.score_documents(empty(spark)).count() == 0


def test_each_slice_trains_the_network(spark):
    slices = {}
    for r in spark.range(400).select("id", F.pmod(F.xxhash64("id"), F.lit(L.SLICES)).alias("slice")).collect():
        slices.setdefault(r.slice, r.id)
    assert len(slices) == L.SLICES
    for turn in (0, 3, 4, 9, L.SLICES - 1):
        docs = spark.createDataFrame([(slices[turn], "alpha beta gamma " * 50)], "doc_id long, text string")
        counts = L.bucket_counts(docs)
        start = L.start_weights(counts, L.classes(counts)[0])
        assert not np.array_equal(L.fit_network(docs, counts), start)


def plain_step(flat, target, around, rate, squares):
    weights, steps = L.unpacked(flat), L.unpacked(squares)
    hidden = np.tanh(weights[1] + sum(weights[0][k][around[:, k]] for k in range(4)))
    off = np.exp(hidden @ weights[2] + weights[3])
    off /= off.sum(axis=1, keepdims=True)
    off[np.arange(len(target)), target] -= 1
    off /= len(target)
    inner, table = (off @ weights[2].T) * (1 - hidden**2), np.zeros_like(weights[0])
    for k in range(4):
        np.add.at(table[k], around[:, k], inner)
    for w, s, g in zip(weights, steps, (table, inner.sum(axis=0), hidden.T @ off, off.sum(axis=0))):
        s += g * g
        w -= rate * g / (np.sqrt(s) + 1e-6)


def some_words(n):
    rng = np.random.default_rng(n)
    counts = rng.integers(0, 50, L.BUCKETS)
    flat = L.start_weights(counts, L.classes(counts)[0])
    return flat, rng.integers(0, L.CLASSES, n), rng.integers(0, L.CLASSES + 1, (n, len(L.AROUND)))


def test_training_makes_its_table_once_and_equals_the_plain_steps(monkeypatch):
    flat, target, around = some_words(300)
    own, squares, want, want_squares = flat.copy(), np.full(len(flat), 1e-4, np.float32), flat.copy(), np.full(len(flat), 1e-4, np.float32)
    for at in range(0, 300, 128):  # the last one is shorter
        plain_step(want, target[at : at + 128], around[at : at + 128], 0.1, want_squares)
    made, zeros = [], np.zeros
    monkeypatch.setattr(np, "zeros", lambda *a, **b: made.append(a) or zeros(*a, **b))
    L.train(own, target, around, 0.1, squares, batch=128)
    assert len(made) == 1  # not one a step
    assert np.allclose(own, want, atol=1e-4) and np.allclose(squares, want_squares, rtol=1e-3, atol=1e-6)


def test_scoring_keeps_what_it_works_on_small():
    flat, target, around = some_words(20_000)
    tracemalloc.start()
    got = L.log_probabilities(flat, target, around)
    most = tracemalloc.get_traced_memory()[1] - got.nbytes
    tracemalloc.stop()
    assert most < 2 << 20
    weights = L.unpacked(flat)
    hidden = np.tanh(weights[1] + sum(weights[0][k][around[:, k]] for k in range(4)))
    logits = hidden @ weights[2] + weights[3]
    assert np.allclose(got, logits[np.arange(len(target)), target] - np.log(np.exp(logits).sum(axis=1)), atol=1e-4)
