import numpy as np
import pytest
from pyspark.sql import functions as F

from climora.llm import embedding_dedup as E


def brute(rows, threshold=0.9):
    """n_links and component of each row of (id, vector)."""
    def usable(v):
        return v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)

    links = {i: set() for i, _ in enumerate(rows)}
    for i, (_, a) in enumerate(rows):
        for j, (_, b) in enumerate(rows):
            if i != j and usable(a) and usable(b) and len(a) == len(b):
                x, y = np.array(a, float), np.array(b, float)
                if x @ y / np.sqrt((x @ x) * (y @ y)) >= threshold:
                    links[i].add(j)
    label = {i: rows[i][0] for i in links}
    for _ in rows:
        for i in links:
            label[i] = min([label[i], *(label[j] for j in links[i])])
    return sorted((rows[i][0], len(links[i]), label[i], rows[i][0] == label[i]) for i in links)


def vectors(seed, n=160, d=8):
    rng = np.random.default_rng(seed)
    rows = []
    centres = rng.normal(size=(12, d))
    for i in range(n):
        rows.append((i, (centres[rng.integers(12)] + rng.normal(size=d) * rng.choice([0.05, 0.3, 1.0])).astype(np.float32).tolist()))
    rows[5] = (5, rows[4][1])
    rows[6] = (6, [2 * x for x in rows[4][1]])
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("block", [(4, 8), (30, 60)])
def test_equals_brute_force(spark, monkeypatch, seed, block):
    monkeypatch.setattr(E, "BLOCK_ROWS", block)
    rows = vectors(seed)
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = sorted(tuple(r) for r in E.embedding_groups(frame).select("vec_id", "n_links", "component_id", "kept").collect())
    assert found == brute(rows)


def test_recall_is_whole_on_given_vectors_and_their_neighbours(spark):
    given = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").orderBy("vec_id").toPandas()
    x = np.array(given.embedding.tolist(), np.float32)
    rng = np.random.default_rng(8)
    near = x[::5] + rng.normal(size=x[::5].shape) * np.linalg.norm(x[::5], axis=1, keepdims=True) * rng.uniform(0.2, 0.7, (len(x[::5]), 1)) / np.sqrt(x.shape[1])
    x = np.concatenate((x, near.astype(np.float32)))
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>").repartition(4)
    found = E.embedding_groups(table).toPandas().sort_values("vec_id")
    x = x.astype(float)
    x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
    links = np.concatenate([(x[a : a + 1000] @ x.T >= 0.9).sum(axis=1) - 1 for a in range(0, len(x), 1000)])
    assert (links == found.n_links.to_numpy()).all() and 100 < links.sum() < 2 * len(near)


def test_cases(spark):
    rows = [
        (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, None), (4, []), (5, [0.0, 0.0]), (6, [float("nan"), 1.0]), (7, [float("inf"), 1.0]),
        (8, [1.0, None]), (9, [1.0, 0.0, 0.0]), (10, [-1.0, 0.0]), (11, [1e200, 1e190]), (12, [0.9, 0.1]), (12, [0.9, 0.1]),
    ]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({n: F.lit("own") for n in ("rep", "cell", "label", "kept")})
    found = sorted(tuple(r) for r in E.embedding_groups(frame).collect())
    want = {1: (4, 1), 2: (4, 1), 11: (4, 1), 12: (4, 1)}
    assert found == sorted((i, *want.get(i, (0, i)), want.get(i, (0, i))[1] == i) for i, _ in rows)
    none = spark.createDataFrame([(None, [1.0, 0.0]), (1, [1.0, 0.0])], "vec_id long, embedding array<double>")
    assert {tuple(r) for r in E.embedding_groups(none).collect()} == {(None, 0, None, True), (1, 0, 1, True)}
    assert E.embedding_groups(frame.limit(0)).count() == 0
    assert E.embedding_groups(frame.where("vec_id = 3")).collect()[0][1:] == (0, 3, True)


def test_a_cell_is_skipped_only_without_partners():
    rng = np.random.default_rng(5)
    unit = E._unit(rng.normal(size=(400, 6)))
    centres = E.fit_centres(unit, 20)
    home = (unit @ centres.T).argmax(axis=1)
    angle = np.arccos(np.clip((unit * centres[home]).sum(axis=1), -1, 1))
    low = np.array([angle[home == k].min(initial=np.inf) for k in range(20)])
    high = np.array([angle[home == k].max(initial=-np.inf) for k in range(20)])
    goes = E.visited(unit, centres, 0.9, low, high)
    for i, j in zip(*np.nonzero(unit @ unit.T >= 0.9)):
        assert goes[i, home[j]]
    assert not goes.all()


@pytest.mark.parametrize("block", [(4, 8), (30, 60)])
def test_every_length_is_compared_with_its_own(spark, monkeypatch, block):
    monkeypatch.setattr(E, "BLOCK_ROWS", block)
    rows = vectors(1) + [(i + 1000, v) for i, v in vectors(2, n=70, d=5)] + [(2000, [1.0, 0.0]), (2001, [1.0, 0.0]), (2002, [1.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = sorted(tuple(r) for r in E.embedding_groups(frame).select("vec_id", "n_links", "component_id", "kept").collect())
    assert found == brute(rows)
    assert sum(r[1] for r in found if 1000 <= r[0] < 2000) > 0 and (2001, 1, 2000, False) in found


def test_blocks_are_bounded_by_bytes(spark, monkeypatch):
    assert E._block_rows(10**9, 64) == 16_384 and E._block_rows(10**9, 4096) == 2048 and E._block_rows(100, 64) == 256
    assert E._block_rows(10**9, 10**8) == 1
    monkeypatch.setattr(E, "BLOCK_BYTES", 8 * 8 * 5)
    rows = vectors(2)
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert sorted(tuple(r) for r in E.embedding_groups(frame).select("vec_id", "n_links", "component_id", "kept").collect()) == brute(rows)
