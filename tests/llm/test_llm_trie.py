import random
import zlib
from collections import defaultdict
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from climora.llm import prefix_trie as T

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def ordered(rows):
    """Turns of each conversation; ties only differ in role or in the length of their text here."""
    found = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            found[conv].append((turn is not None, turn, role or "", len(text or ""), text or ""))
    return {c: [(t[2], t[4]) for t in sorted(turns)] for c, turns in found.items()}


def rebuilt(convs, family=100, most=5):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % (most + 1)
        donor = c - (abs(c) % family) * (1 if c >= 0 else -1)
        out[c] = convs.get(donor, [])[:h] + own[h:]
    return out


def brute(convs):
    members = defaultdict(list)
    for c in sorted(convs):
        for d in range(len(convs[c]) + 1):
            members[tuple(convs[c][:d])].append(c)
    kids = defaultdict(list)
    for key in members:
        if key:
            kids[key[:-1]].append(key)

    def below(key):
        todo = [key]
        while todo:
            yield (k := todo.pop())
            todo += kids[k]

    rows = []
    for key, own in members.items():
        ends = ",".join(str(c) for c in own if len(convs[c]) == len(key))
        tree = list(below(key))
        rows.append((
            min(own), len(key), min(members[key[:-1]]) if key else None, len(own), len(kids[key]), sum(not kids[k] for k in tree),
            sum((len(members[k]) - 1) * len(k[-1][1]) for k in tree if k), sha256(ends.encode()).hexdigest(),
        ))
    return sorted(rows, key=str)


def found(frame):
    assert frame.columns == COLUMNS
    return sorted((tuple(r) for r in frame.collect()), key=str)


def conversations(seed, n=60):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-250, 900), n):
        for t in range(rng.randrange(1, 9)):
            rows.append((c, rng.choice([t, t, t, None]), rng.choice(["user", "bot", None]), rng.choice(["a", "bé", "", None, "long 😀 text"])))
    rows += rows[:9]  # repeated rows are turns of their own
    rows += [(None, 0, "user", "a"), (300, None, None, None), (301, 1, "user", "x" * 200_000)]
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_equals_brute_force(spark, monkeypatch, seed):
    monkeypatch.setattr(T, "TURNS_PER_BLOCK", 3)
    monkeypatch.setattr(T, "ARCS_PER_BLOCK", 16)
    monkeypatch.setattr(T, "IDS_PER_PIECE", 2)
    rows = conversations(seed)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3).withColumns({n: F.lit("own") for n in ("depth", "index", "pos", "n", "a", "node")})
    assert found(T.family_trie(frame)) == brute(rebuilt(ordered(rows)))
    assert found(T.conversation_trie(frame)) == brute(ordered(rows))


def test_turnless_conversations_belong_to_the_root(spark):
    few = [c for c in range(301, 400) if zlib.crc32(str(c).encode()) % 6 >= 2][:4]
    rows = [(c, 0, "user", "a") for c in few]  # no conversation 300: their one turn goes, and none comes
    assert found(T.family_trie(spark.createDataFrame(rows, SCHEMA))) == brute({c: [] for c in few})


def test_no_rows(spark):
    frame = spark.createDataFrame([], SCHEMA)
    assert found(T.family_trie(frame)) == [] and found(T.family_trie(spark.createDataFrame([(None, 1, "a", "b")], SCHEMA))) == []


def test_one_long_conversation(spark, monkeypatch):
    monkeypatch.setattr(T, "ARCS_PER_BLOCK", 64)
    rows = [(7, t, "user", str(t % 3)) for t in range(700)] + [(8, t, "user", str(t % 3)) for t in range(650)] + [(9, 0, "user", "0")]
    assert found(T.conversation_trie(spark.createDataFrame(rows, SCHEMA))) == brute(ordered(rows))


@pytest.mark.parametrize("shuffled", [False, True])
def test_ranks_of_lists_with_and_without_locality(spark, shuffled):
    rng = random.Random(3)
    order = list(range(500))
    if shuffled:
        rng.shuffle(order)
    links = spark.createDataFrame(list(zip(order, order[1:] + [-1])), "id long, next long")
    ranks = {r.id: r["rank"] for r in T.list_ranks(links, 16).collect()}
    assert [ranks[i] for i in order] == list(range(500))


def test_index_counts_through(spark):
    frame = spark.createDataFrame([(i * 7 % 101, "own") for i in range(101)], "k int, file string").repartition(5)
    assert sorted(r["index"] for r in T.indexed(frame, "test", "k").where("k = index").collect()) == list(range(101))
