import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from climora.llm import components as C
from climora.llm import simhash_dedup as S
from climora.llm.components import components
from climora.llm.storage import stored
from llm_cases import documents, empty


def brute_print(text, k=4):
    words, word = [], b""
    for byte in (text or "").encode():
        if byte == 32 or 9 <= byte <= 13:
            if word:
                words.append(word)
            word = b""
        else:
            word += bytes([byte + 32 if 65 <= byte <= 90 else byte])
    if word:
        words.append(word)
    shingles = [words[i : i + k] for i in range(len(words) - k + 1)] or ([words] if words else [])
    hashes = [xxhash.xxh64_intdigest(b" ".join(s), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(rows, bits=4):
    """Smallest id reachable for each row of (id, fingerprint); rows without an id connect too."""
    left, out = list(range(len(rows))), {}
    label = list(range(len(rows)))
    changed = True
    while changed:
        changed = False
        for i in left:
            for j in left:
                if bin(rows[i][1] ^ rows[j][1]).count("1") <= bits and label[i] != label[j]:
                    label[i] = label[j] = min(label[i], label[j])
                    changed = True
    for i in left:
        ids = [r[0] for r, k in zip(rows, label) if k == label[i] and r[0] is not None]
        out[i] = min(ids, default=None)
    return out


def test_fingerprints_equal_the_plain_definition(spark):
    frame = documents(spark)
    for row in S.simhash_groups(frame).join(frame.select("doc_id", "text"), "doc_id").collect():
        assert int(row.fingerprint, 16) == brute_print(row.text)


def test_hash_is_that_of_spark(spark):
    assert spark.range(1).select(F.xxhash64(F.lit("über four"))).first()[0] % 2**64 == xxhash.xxh64_intdigest("über four".encode(), seed=42)


def test_all_values_of_a_segment_are_within_three_bits_of_a_codeword():
    decoded, near = S._patterns()
    assert all(bin(e).count("1") <= 3 for e in decoded.tolist())
    assert all(bin(e).count("1") <= 4 for row in near.tolist() for e in row if e >= 0)
    values = np.random.default_rng(1).integers(0, 1 << 23, 1000)
    assert (S._syndromes(values ^ decoded[S._syndromes(values)]) == 0).all()


def test_prints_up_to_four_bits_apart_share_a_key():
    rng = random.Random(3)
    for _ in range(400):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), rng.randrange(0, 5)):
            b ^= 1 << bit
        rows, keys = S.golay_keys(np.array([a, b], np.uint64))
        assert set(keys[rows == 0].tolist()) & set(keys[rows == 1].tolist())


@pytest.mark.parametrize("split", [(4, 0, 0), (0, 1, 3), (3, 0, 1), (2, 2, 0), (0, 2, 2), (1, 1, 1), (2, 1, 1), (1, 2, 1), (1, 1, 2)])
def test_every_split_of_the_bits_shares_a_key(split):
    rng = random.Random(sum(10**i * n for i, n in enumerate(split)))
    for _ in range(300):
        a = rng.getrandbits(64)
        b = a
        for (first, width), bits in zip(S._SEGMENTS, split):
            for bit in rng.sample(range(first, first + width), bits):
                b ^= 1 << bit
        rows, keys = S.golay_keys(np.array([a, b], np.uint64))
        assert set(keys[rows == 0].tolist()) & set(keys[rows == 1].tolist())


@pytest.mark.parametrize("seed", [1, 2])
def test_groups_equal_brute_force_on_clustered_prints(spark, seed):
    rng = random.Random(seed)
    prints = []
    for _ in range(12):
        centre = rng.getrandbits(64)
        for _ in range(40):
            value = centre
            for bit in rng.sample(range(64), rng.randrange(0, 9)):
                value ^= 1 << bit
            prints.append(value)
    prints = sorted(set(prints))
    rng.shuffle(prints)
    frame = spark.createDataFrame([(p - 2**64 if p >= 2**63 else p, i) for i, p in enumerate(prints)], "print long, rep long")
    found = {r.node: r.component for r in S.link_components(frame).collect()}
    want = brute_groups(list(enumerate(prints)))
    assert {i: found.get(i, i) for i in range(len(prints))} == want


def test_groups_of_the_cases(spark):
    frame = documents(spark).withColumn("doc_id", F.when(F.col("doc_id") != 14, F.col("doc_id")))
    rows = S.simhash_groups(frame).collect()
    assert len(rows) == frame.count()
    want = brute_groups([(r.doc_id, int(r.fingerprint, 16)) for r in rows])
    assert [r.component_id for r in rows] == [want[i] for i in range(len(rows))]


def test_one_of_each_group_stays_with_its_columns(spark):
    frame = documents(spark, extra=True)
    kept = S.simhash_dedup(frame)
    assert kept.columns == frame.columns
    groups = {r.doc_id: r.component_id for r in S.simhash_groups(frame).collect()}
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(groups.values()))
    assert {r.label for r in kept.collect()} == {"own"}


def test_empty_tables(spark):
    assert S.simhash_groups(empty(spark)).count() == 0
    assert S.simhash_dedup(empty(spark)).count() == 0


def test_components_of_paths_hubs_and_loops(spark):
    links = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 160)] + [(7, 7), (None, 3), (200, 201), (201, 200)]
    found = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()}
    assert found == {**{i: 0 for i in range(61)}, **{i: 100 for i in range(100, 160)}, 200: 200, 201: 200}


def test_components_make_no_round_that_changes_nothing(spark, monkeypatch):
    written = []
    monkeypatch.setattr(C, "stored", lambda frame, label, *by: written.append(label) or stored(frame, label, *by))

    def found(links):
        written.clear()
        return {r.node: r.component for r in C.components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()}

    assert found([(1, 5), (6, 1), (1, 7), (2, 3)]) == {1: 1, 5: 1, 6: 1, 7: 1, 2: 2, 3: 2}
    assert "star" not in written  # they are stars already
    assert found([(1, 2), (3, 2), (9, 8)]) == {1: 1, 2: 1, 3: 1, 8: 8, 9: 8}
    assert written.count("star") == 2  # one round
    assert found([]) == {}


def test_the_second_comparison_joins_components_only(spark, monkeypatch):
    given = []

    def counted(links, left, right):
        given.append(links.distinct().count())
        return C.components(links, left, right)

    monkeypatch.setattr(S, "components", counted)
    centre = random.Random(3).getrandbits(62)
    prints = [centre, *(centre ^ 1 << b for b in range(12)), centre ^ 0x3FF << 40]
    frame = spark.createDataFrame([(p, i) for i, p in enumerate(prints)], "print long, rep long")
    found = {r.node: r.component for r in S.link_components(frame).collect()}
    assert found == {i: 0 for i in range(13)}
    assert given[0] >= 12 and given[1] == 0  # all are near the smallest: nothing is left to join
