import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from climora.llm import suffix_dedup as S
from climora.llm.queries import op1_suffix_dedup
from llm_cases import documents, empty


def brute(rows, length):
    """Rows of (id, text): bytes kept, bytes removed and runs, by looking every string up; ids are distinct."""
    first, out = {}, {}
    for id_, text in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        data = (text or "").encode()
        gone = [False] * len(data)
        for at in range(len(data) - length + 1):
            if first.setdefault(data[at : at + length], (id_, at)) != (id_, at):
                gone[at : at + length] = [True] * length
        kept = bytes(b for b, g in zip(data, gone) if not g)
        runs = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out[id_] = (len(data), sum(gone), runs, kept)
    return out


def found(frame, length):
    return {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in S.remove_repeats(frame, length=length).collect()}


@pytest.mark.parametrize("length", [100, 40])
def test_equals_brute_force(spark, length):
    frame = documents(spark)
    rows = {r.doc_id: r.text for r in frame.collect()}
    assert found(frame, length) == brute(list(rows.items()), length)


def test_small_buckets_compare_across_boundaries(spark, monkeypatch):
    monkeypatch.setattr(S, "BUCKET_ROWS", 40)
    monkeypatch.setattr(S, "SAMPLE_ROWS", 300)
    rng = random.Random(5)
    pool = ["".join(rng.choice("abcd ") for _ in range(rng.randrange(60, 260))) for _ in range(12)]
    rows = [(i, "".join(rng.choice(pool) + rng.choice(("", "x", "yz")) for _ in range(rng.randrange(0, 6)))) for i in range(60)]
    rows += [(100 + i, pool[0] * 3) for i in range(40)] + [(200, "q" * 500), (201, "q" * 330), (None, pool[1] + pool[2])]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert found(frame, 100) == brute(rows, 100)


def test_repeated_rows_do_not_remove_each_other(spark):
    text = "abcdefghij" * 5 + "0123456789klm" * 9
    frame = spark.createDataFrame([(1, text), (1, text), (2, text)], "doc_id long, text string")
    rows = S.remove_repeats(frame).collect()
    assert sorted((r.doc_id, bytes(r.kept)) for r in rows) == sorted([(1, brute([(1, text)], 100)[1][3])] * 2 + [(2, b"")])


def test_records_hold_every_string_once():
    rng = random.Random(2)
    text = "".join(rng.choice("ab") for _ in range(3000)) + "z" * 400
    data = np.frombuffer(text.encode(), np.uint8)
    _, _, _, packed = S.chosen_suffixes(data, np.array([0, 1500]), np.array([1500, 3400]))
    starts = [(p >> 14) + k for p in packed.tolist() for k in range((p >> 7 & 127) + 1)]
    assert sorted(starts) == sorted([*range(1401), *range(1801)])


def test_multikey_order_is_lexicographic():
    rng = np.random.default_rng(4)
    columns = [rng.integers(0, 4, 500) for _ in range(4)]
    order = S.multikey_order([c.copy() for c in columns])
    rows = list(zip(*(c[order].tolist() for c in columns)))
    assert rows == sorted(rows)


def test_splitters_deal_in_order():
    rng = np.random.default_rng(6)
    rows = [rng.integers(0, 3, 400).astype(np.uint64), rng.integers(0, 3, 400).astype(np.uint64), rng.integers(0, 40, 400), rng.integers(0, 9, 400)]
    splitters = S._splitters([tuple(int(x) for x in r) for r in zip(*rows)], 17)
    bucket = S.bucket_of(splitters, rows)
    keys = [tuple(int(c[i]) for c in rows) for i in range(400)]
    split = list(zip(*(s.tolist() for s in splitters)))
    assert bucket.tolist() == [sum(s <= k for s in split) for k in keys]


def test_query_digests_what_is_kept(spark, tmp_path):
    frame = documents(spark)
    frame.dropDuplicates(["doc_id"]).write.parquet(str(tmp_path / "documents.parquet"))
    want = brute([(r.doc_id, r.text) for r in frame.dropDuplicates(["doc_id"]).collect()], 100)
    for r in op1_suffix_dedup(spark, str(tmp_path)).collect():
        n, removed, spans, kept = want[r.doc_id]
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == (n, removed, spans, hashlib.sha256(kept).hexdigest())


def test_carried_columns_and_empty_tables(spark):
    frame = documents(spark).withColumn("_climora", F.lit(1))
    assert S.remove_repeats(frame, carry=("lang", "source")).columns == ["doc_id", "lang", "source", "n_bytes", "n_removed", "n_spans", "kept"]
    assert S.remove_repeats(empty(spark)).count() == 0


def test_readable_leaves_out_cut_characters(spark):
    frame = spark.createDataFrame([(b"a\xc3",), ("ü".encode(),), (None,)], "kept binary")
    assert [r[0] for r in frame.select(S.readable("kept")).collect()] == ["a", "ü", None]
