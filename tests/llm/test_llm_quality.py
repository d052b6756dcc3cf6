import random

import numpy as np
import pytest

from pyspark.sql import functions as F

from climora.llm import quality_forest as Q
from climora.llm.queries import op8_quality_forest
from llm_cases import documents, empty, sentence, texts


def plain(text):
    """The contract's counts by walking the text."""
    text = text or ""
    spaces = {chr(32), *(chr(c) for c in range(9, 14))}
    words, word = [], ""
    for c in text + " ":
        if c in spaces:
            if word:
                words.append(word)
            word = ""
        else:
            word += c
    lines, dup = set(), 0
    for line in text.split("\n"):
        if any(c not in spaces for c in line):
            dup += line in lines
            lines.add(line)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(5)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered)


def test_counts_equal_the_plain_definition():
    rng = random.Random(1)
    cases = [t for t in texts() if t is None or len(t) < 9000]
    for _ in range(200):
        cases.append(" ".join(rng.choice(("a", "b", "c|", "\n", "d\x0b", "\x1ce", "ü ", "\x85")) for _ in range(rng.randrange(0, 60))))
    for text in cases:
        assert Q.counts(text)[:5] == plain(text)


def test_held_out_junk_is_found_and_clean_texts_stay(spark):
    sf = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rng = random.Random(4)
    seen = {i for i in labels if rng.random() < 0.5}
    docs, table = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    fitted = table.where(table.doc_id.isin(list(seen)))
    rows = [r for r in Q.judge_quality(docs, fitted).collect() if r.doc_id in labels and r.doc_id not in seen and not r.base_failed]
    kept, good = np.array([r.kept for r in rows]), np.array([labels[r.doc_id] == 1 for r in rows])
    assert kept[good].mean() > 0.98
    assert kept[~good].mean() < 0.2


def test_forest_finds_what_is_unlike_the_rest():
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.normal(size=(500, 3)), rng.normal(size=(5, 3)) + 9])
    forest = Q.fit_forest(x)
    scores = forest.scores(x)
    assert scores[500:].min() > np.quantile(scores[:500], 0.99)


def test_path_length_equals_a_walk():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(60, 2))
    forest = Q.fit_forest(x, trees=5, rows=32)
    for row, score in zip(x, forest.scores(x)):
        total = 0.0
        for t in range(5):
            at = 0
            while forest.feature[t, at] >= 0:
                at = forest.child[t, at] + int(row[forest.feature[t, at]] >= forest.cut[t, at])
            total += forest.depth[t, at]
        assert score == pytest.approx(2.0 ** (-total / 5 / float(Q._expected(32))))


def test_threshold_loses_few_good_rows():
    scores, good = np.array([0.9, 0.8, 0.8, 0.7, 0.6, 0.5]), np.array([False, False, True, False, True, True])
    assert Q.calibrated(scores, good, 0.0) == 0.9
    assert Q.calibrated(scores, good, 0.4) == 0.7
    assert Q.calibrated(scores, np.ones(6, bool)) == 2.0


def test_query_over_the_cases(spark, tmp_path):
    documents(spark, extra=True).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(0, 1), (1, 1), (20, 0), (None, 1), (3, None)], "doc_id long, quality int").write.parquet(str(tmp_path / "labels.parquet"))
    rows = op8_quality_forest(spark, str(tmp_path)).collect()
    text = {r.doc_id: r.text for r in documents(spark).collect()}
    assert len(rows) == documents(spark).count()
    for r in rows:
        want = plain(text[r.doc_id]) if len(text[r.doc_id] or "") < 9000 else Q.counts(text[r.doc_id])[:5]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0])
        assert not (r.base_failed and r.kept)


def test_without_labels_or_rows(spark):
    none = spark.createDataFrame([], "doc_id long, quality int")
    rows = Q.judge_quality(documents(spark), none).collect()
    assert all(r.kept != r.base_failed for r in rows)
    assert Q.judge_quality(empty(spark), none).count() == 0


def test_very_long_text_counts_once_per_window():
    text = sentence(random.Random(5), 40) + " "
    assert Q.counts(text * 50)[4] == 2000


def test_every_labelled_row_counts(spark):
    """The bad rows come last in the order of hashes by which 20,000 labelled rows were chosen before."""
    order = [r.id for r in spark.range(20_300).orderBy(F.xxhash64("id")).collect()]
    bad = set(order[-300:])
    rng = random.Random(6)
    rows = [(i, " ".join(rng.choice(("##", "$%&", "||", "*")) for _ in range(30)) if i in bad else sentence(rng, 14)) for i in order]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i not in bad)) for i in order], "doc_id long, quality int")
    kept = {r.doc_id: r.kept for r in Q.judge_quality(docs, labels).collect() if not r.base_failed}
    assert bad & set(kept) and not any(kept[i] for i in bad & set(kept))
    assert np.mean([k for i, k in kept.items() if i not in bad]) >= 0.995


def _known(spark, good):
    rows = [(i * 7 - 2**62, ok, 12 + i, *range(9)) for i, ok in enumerate(good)]
    counted = ", ".join(f"{c} long" for c in Q.COUNTS)
    return spark.createDataFrame(rows, f"id long, good boolean, {counted}").withColumn("place", F.xxhash64("id")).repartition(5)


def test_trees_draw_from_all_rows(spark):
    good = [i % 4 > 0 for i in range(2000)]
    known = _known(spark, good)
    hashes = {r.n_words - 12: r.place for r in known.collect()}
    sent, takes = Q.drawn(known, 40, 16)
    got = {}
    for r in sent.collect():
        got.setdefault(r.tree, []).append((r.place, r.n_words - 12))
    assert takes == 16 and set(got) == set(range(40))
    places = np.array([hashes[i] for i in range(2000)], np.int64).view(np.uint64)
    fine = [i for i in range(2000) if good[i]]
    for tree, rows in got.items():
        order = np.array(fine)[np.argsort(Q.place_of(places[fine], np.array([tree])))]
        first = [i for _, i in sorted(rows)[:takes]]
        some = [i for i in first if good[i]]
        assert some == order[: len(some)].tolist() and len(first) == takes
    bad = sum(not good[i] for rows in got.values() for _, i in sorted(rows)[:takes])
    assert 0 < bad < 0.06 * 40 * takes
    assert len({i for rows in got.values() for _, i in sorted(rows)[:takes]}) > 400
    sent, takes = Q.drawn(_known(spark, [False] * 9), 3, 16)
    assert takes == 9 and sent.count() == 27


@pytest.mark.parametrize("rows, levels, most_lost", [(3000, 7, 0.05), (3000, 10**6, 0.005), (3000, 900, 0.3), (5, 3, 0.0)])
def test_threshold_equals_that_of_arrays(spark, rows, levels, most_lost):
    rng = np.random.default_rng(rows + levels)
    good = rng.random(rows) < 0.7
    scores = np.round((rng.random(rows) + 0.4 * ~good) / 2 * levels) / levels
    frame = spark.createDataFrame([(float(s), bool(g)) for s, g in zip(scores, good)], "anomaly double, good boolean").repartition(3)
    assert Q.threshold(frame, most_lost) == Q.calibrated(scores, good, most_lost)
    assert Q.threshold(frame.where("good"), most_lost) == 2.0
