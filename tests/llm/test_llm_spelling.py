import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from climora.llm import spelling_variants as S
from llm_cases import documents, empty

COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]
SMALL = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def counted(rows, every=97):
    found = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(SMALL)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            found[run] += 1
    return found


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    long, short = sorted((a, b), key=len, reverse=True)
    return len(long) == len(short) + 1 and any(long[:k] + long[k + 1 :] == short for k in range(len(long)))


def brute(counts, shortest=5, least=3):
    words = {w: n for w, n in counts.items() if len(w) >= shortest and n >= least}
    rows, forms = {}, {}
    for w, n in words.items():
        others = [(-m, o) for o, m in words.items() if near(w, o)]
        best = min(others, default=(0, None))
        good = best[1] is not None and -best[0] >= 2 * n
        forms[w] = best[1] if good else None
        rows[w] = (n, len(others), -best[0] if good else None)
    out = []
    for w, (n, many, form_n) in rows.items():
        root = w
        while forms[root]:
            root = forms[root]
        out.append((w, forms[w], root, n, many, form_n))
    return sorted(out)


def found(frame):
    assert frame.columns == COLUMNS
    return sorted(tuple(r) for r in frame.collect())


def misspelt(seed, words=60, letters="abcdeé×"):
    """Words with many variants, chains of them and ties."""
    rng = random.Random(seed)
    known = ["".join(rng.choice(letters) for _ in range(rng.randrange(5, 9))) for _ in range(words)]
    rows = []
    for w in known:
        for step in range(8):
            k = rng.randrange(len(w))
            w = rng.choice([w[:k] + w[k + 1 :], w[:k] + rng.choice(letters) + w[k:], w[:k] + rng.choice(letters) + w[k + 1 :]])
            rows += [(rng.randrange(50), w.upper() if rng.random() < 0.2 else w)] * rng.choice([2, 3, 6, 12, 24, 3 << step])
    rng.shuffle(rows)
    return [(i, " ".join(w for d, w in rows if d == i)) for i in range(50)]


@pytest.mark.parametrize("symbols, crowded", [(12, 64), (2, 64), (1, 3), (3, 0), (12, 1)])
def test_equals_brute_force(spark, monkeypatch, symbols, crowded):
    pairs = S.near_pairs
    monkeypatch.setattr(S, "near_pairs", lambda words: pairs(words, symbols, crowded))
    monkeypatch.setattr(S, "_CELLS", 50)
    rows = misspelt(symbols + crowded)
    want = brute(counted(rows))
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert found(S.spelling_groups(frame)) == want
    assert any(r[1] and r[1] != r[2] for r in want)


def test_documents_with_all_cases(spark, monkeypatch):
    monkeypatch.setattr(S, "_RUNS", 50)
    monkeypatch.setattr(S, "_HELD", 30)
    docs = documents(spark, extra=True).withColumns({n: F.lit("own") for n in ("word", "n", "root", "form", "other")})
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert found(S.spelling_groups(docs)) == brute(counted(rows))
    assert {r.word: r.n for r in S.word_counts(docs).collect()} == counted(rows)
    assert found(S.spelling_groups(empty(spark))) == []
    assert found(S.spelling_groups(spark.createDataFrame([(1, None), (2, "12 3"), (None, "")], "doc_id long, text string"))) == []


def test_null_ids_and_bytes_that_are_no_text(spark):
    rows = [(None, "house house house hause"), (None, "hause hause houses")]
    assert found(S.spelling_groups(spark.createDataFrame(rows, "doc_id long, text string"))) == brute(counted(rows))
    raw = spark.createDataFrame([(1, b"house \xff house\xffhouse")], "doc_id long, raw binary").select("doc_id", F.col("raw").cast("string").alias("text"))
    assert {r.word: r.n for r in S.word_counts(raw).collect()} == counted([(1, "house house house")])


def test_words_of_any_length(spark):
    long = "ab" * 3000
    rows = [(i, f"{long} {long}x {long} {long}") for i in range(3)]
    assert found(S.spelling_groups(spark.createDataFrame(rows, "doc_id long, text string"), every=10**9)) == [
        (long, None, long, 9, 1, None), (long + "x", long, long, 3, 1, 9)
    ]


def test_roots_of_a_long_path(spark):
    forms = [(f"w{k:02}", f"w{k + 1:02}") for k in range(30)]
    assert {tuple(r) for r in S._roots(spark.createDataFrame(forms, "word string, form string")).collect()} == {(w, "w30") for w, _ in forms}


@pytest.mark.parametrize("symbols", [1, 2, 5, None])
def test_neighbourhoods_hold_all_edits(symbols):
    rng = random.Random(2)
    letters = "abcxyzéÿ"
    alphabet = S._Alphabet(symbols)
    words = ["".join(rng.choice(letters) for _ in range(rng.randrange(1, 7))) for _ in range(40)]
    for whole in (False, True):
        reached = {w: set() for w in words}
        for at, numbers in alphabet.neighbours(words, whole):
            for k, number in zip(at, numbers):
                reached[words[k]].add(int(number))
        for w in words:
            for k in range(len(w) + 1):
                for edited in (w[:k] + w[k + 1 :], w[:k] + rng.choice(letters) + w[k:], w[:k] + rng.choice(letters) + w[k + 1 :]):
                    if edited:
                        there = int(alphabet.numbers([edited])[0]) in reached[w]
                        if whole:
                            assert there
                        else:
                            back = {int(n) for _, ns in alphabet.neighbours([edited], False) for n in ns}
                            assert there or int(alphabet.numbers([w])[0]) in back


def test_edits_of_a_crowd_are_counted_once():
    alphabet = S._Alphabet(None)
    made = np.concatenate([n for _, n in alphabet.neighbours(["abbc"], True)])
    size = len(S._LETTERS)
    assert len(set(made.tolist())) == len(made) == 1 + 3 + 4 * (size - 1) + 4 * (size - 1) + size
