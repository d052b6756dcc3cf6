"""Near copies among embeddings: spherical k-means cells, blocked cosine products, one kept per group.

Each distinct vector has the cell of its nearest centre as home. A vector at home in cell c lies on c's
side of the plane between the centres of c and of any other cell; so a vector y can have a partner at home in c only
if it is no farther from that plane than the angle of the threshold allows, and only if its angle to the centre of c is
within that angle of those found in c. y visits all cells that meet both, so no link is lost. Every pair is
counted where one of the two is at home and the other visits. Each length of vectors has centres and cells of its own. Homes and visitors of a cell are cut into blocks,
so that no cell, however full, meets in one task.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from climora.llm.components import components
from climora.llm.storage import small_batches, stored

#: Bounds of the sample that the centres are fitted on, of the number of centres, and of a block's rows and bytes (in doubles).
SAMPLE_ROWS = 20_000
MOST_CELLS = 4096
BLOCK_ROWS = (256, 16_384)
BLOCK_BYTES = 64 << 20
_ROWS = 1024  # of a product at a time
_SLACK = 1e-9


def _unit(values: np.ndarray) -> np.ndarray:
    scaled = values / np.abs(values).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _by_length(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch]]:
    """The rows of each batch, by the length of their vectors."""
    for batch in batches:
        lengths = pc.list_value_length(batch.column("vec"))
        for length in pc.unique(lengths).to_pylist():
            yield length, batch.filter(pc.equal(lengths, length))


def fit_centres(sample: np.ndarray, cells: int, rounds: int = 8, seed: int = 3) -> np.ndarray:
    """Unit centres of spherical k-means; empty cells keep their last centre."""
    rng = np.random.default_rng(seed)
    centres = sample[rng.permutation(len(sample))[:cells]].copy()
    for _ in range(rounds):
        cell = np.concatenate([(sample[a : a + _ROWS] @ centres.T).argmax(axis=1) for a in range(0, len(sample), _ROWS)])
        sums = np.zeros_like(centres)
        np.add.at(sums, cell, sample)
        size = np.sqrt((sums * sums).sum(axis=1))
        centres[size > 0] = sums[size > 0] / size[size > 0, None]
    return centres


def visited(unit: np.ndarray, centres: np.ndarray, threshold: float, nearest: np.ndarray, farthest: np.ndarray) -> np.ndarray:
    """Which cells each vector has to visit; ``nearest`` and ``farthest`` are the angles met in each cell."""
    reach = math.acos(threshold) + _SLACK
    close = unit @ centres.T
    home = close.argmax(axis=1)
    apart = np.sqrt(np.maximum(2 - 2 * centres @ centres.T, 0))
    behind = close[np.arange(len(unit)), home][:, None] - close
    by_plane = behind <= (math.sin(reach) if reach < math.pi / 2 else 2.0) * apart[home] + _SLACK
    angle = np.arccos(np.clip(close, -1, 1))
    return by_plane & (angle <= farthest + reach) & (angle >= nearest - reach)


def _homes(centres: dict[int, tuple[int, np.ndarray]]):
    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for length, batch in _by_length(batches):
            first, own = centres[length]
            close = _unit(_matrix(batch.column("vec"))) @ own.T
            cell = close.argmax(axis=1)
            angle = np.arccos(np.clip(close[np.arange(len(cell)), cell], -1, 1))
            yield pa.RecordBatch.from_arrays(
                [batch.column("rep"), batch.column("n"), batch.column("vec"), pa.array((cell + first).astype(np.int32)), pa.array(angle)],
                ["rep", "n", "vec", "cell", "angle"],
            )

    return assign


def _visits(centres: dict[int, tuple[int, np.ndarray]], threshold: float, nearest: np.ndarray, farthest: np.ndarray):
    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for length, batch in _by_length(batches):
            first, own = centres[length]
            part = slice(first, first + len(own))
            goes = visited(_unit(_matrix(batch.column("vec"))), own, threshold, nearest[part], farthest[part])
            cells = [(np.nonzero(g)[0] + first).astype(np.int32) for g in goes]
            yield pa.RecordBatch.from_arrays(
                [batch.column("rep"), batch.column("n"), batch.column("vec"), pa.array(cells, pa.list_(pa.int32()))],
                ["rep", "n", "vec", "cells"],
            )

    return visit


def _block_rows(n: int, longest: int) -> int:
    """Rows of a block when ``n`` vectors of up to ``longest`` components are compared; long vectors make for short blocks."""
    rows = max(BLOCK_ROWS[0], min(BLOCK_ROWS[1], int(10 * math.sqrt(n))))
    return max(1, min(rows, BLOCK_BYTES // (8 * longest)))


def _forest(linked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Component numbers of the rows and columns of a table of links."""
    rows, cols = np.arange(linked.shape[0]), np.arange(linked.shape[1]) + linked.shape[0]
    while True:
        new_cols = np.minimum(cols, np.where(linked, rows[:, None], len(rows) + len(cols)).min(axis=0))
        new_rows = np.minimum(rows, np.where(linked, new_cols[None, :], len(rows) + len(cols)).min(axis=1))
        if (new_rows == rows).all() and (new_cols == cols).all():
            return rows, cols
        rows, cols = new_rows, new_cols


def _products(threshold: float):
    def product(table: pa.Table) -> pa.Table:
        """Links of the visitors of a block with its homes: their number, and edges that keep the components."""
        at_home = table.column("home").to_numpy()
        rep, n = table.column("rep").to_numpy(), table.column("n").to_numpy()
        unit = _unit(_matrix(table.column("vec")))
        homes, guests = np.nonzero(at_home)[0], np.nonzero(~at_home)[0]
        out = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64))]
        for at in range(0, len(guests), _ROWS):
            some = guests[at : at + _ROWS]
            if not len(homes):
                continue
            linked = unit[some] @ unit[homes].T >= threshold
            same = rep[some][:, None] == rep[homes][None, :]
            linked |= same
            out.append((rep[some], linked @ n[homes] - same.sum(axis=1), rep[some]))
            linked &= ~same
            r, c = np.nonzero(linked.any(axis=1))[0], np.nonzero(linked.any(axis=0))[0]
            if len(r):
                ids = np.concatenate((rep[some][r], rep[homes][c]))
                group = np.concatenate(_forest(linked[np.ix_(r, c)]))
                first = np.full(len(ids) + 1, np.iinfo(np.int64).max)
                np.minimum.at(first, group, ids)
                edges = ids != first[group]
                out.append((ids[edges], np.zeros(int(edges.sum()), np.int64), first[group][edges]))
        return pa.table([pa.array(np.concatenate(x)) for x in zip(*out)], ["rep", "links", "other"])

    return product


def embedding_groups(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = 0.9) -> DataFrame:
    """One row per vector: ``id_col``, n_links, component_id and kept.

    Vectors that are null, empty, zero, or hold null or non-finite components link with nothing, nor do
    those without an id; they are groups of their own. Vectors link with those of their own length. Equal
    vectors are compared once. Rows that repeat an id count as vectors of their own and share a group if
    their vectors do. An empty table gives no rows; other columns are not read.
    """
    if not 0 < threshold <= 1:
        raise ValueError("the threshold has to be above 0, and 1 at most")
    spark = vectors.sparkSession
    small_batches(spark)
    raw = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vec"))
    whole = (
        F.col("id").isNotNull() & F.col("vec").isNotNull()
        & F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
        & F.exists("vec", lambda x: x != 0)
    )
    each = stored(raw.withColumn("whole", F.coalesce(whole, F.lit(False))), "vectors")
    usable = F.col("whole")
    distinct = stored(each.where(usable).groupBy("vec").agg(F.min("id").alias("rep"), F.count("*").alias("n")), "vectors-distinct")
    lengths = {r.w: r["count"] for r in distinct.groupBy(F.size("vec").alias("w")).count().orderBy("w").collect()}
    if not lengths:
        return each.select(F.col("id").alias(id_col), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    n = sum(lengths.values())
    block = _block_rows(n, max(lengths))
    cells = min(MOST_CELLS, -(-n // block))
    centres, n_cells = {}, 0  # by length: the number of its first cell, and its centres
    for length, many in lengths.items():
        sample = (
            distinct.where(F.size("vec") == length).orderBy(F.xxhash64("rep"), "rep")
            .limit(-(-SAMPLE_ROWS * many // n)).select("vec").toArrow()
        )
        centres[length] = n_cells, fit_centres(_unit(_matrix(sample.column("vec"))), -(-cells * many // n))
        n_cells += len(centres[length][1])
    kind = dict(distinct.dtypes)["vec"]
    homes = stored(distinct.select("rep", "n", "vec").mapInArrow(_homes(centres), f"rep long, n long, vec {kind}, cell int, angle double"), "vectors-homes")
    nearest, farthest, home_blocks = np.full(n_cells, np.inf), np.full(n_cells, -np.inf), np.zeros(n_cells, np.int64)
    for row in homes.groupBy("cell").agg(F.min("angle").alias("low"), F.max("angle").alias("high"), F.count("*").alias("n")).collect():  # MOST_CELLS at most, and one more per length
        nearest[row.cell], farthest[row.cell], home_blocks[row.cell] = row.low, row.high, -(-row.n // block)
    going = homes.select("rep", "n", "vec").mapInArrow(_visits(centres, threshold, nearest, farthest), f"rep long, n long, vec {kind}, cells array<int>")
    guests = stored(going, "vectors-visits")
    guest_blocks = np.zeros(n_cells, np.int64)
    for row in guests.select(F.explode("cells").alias("cell")).groupBy("cell").count().collect():
        guest_blocks[row.cell] = -(-row["count"] // block)
    sizes = F.broadcast(spark.createDataFrame(  # MOST_CELLS rows at most, and one more per length
        [(k, int(h), int(g)) for k, (h, g) in enumerate(zip(home_blocks, guest_blocks)) if h and g], "cell int, homes int, guests int"
    ))
    spot = F.xxhash64("rep")
    at_home = homes.join(sizes, "cell").select(
        "cell", F.expr("pmod(xxhash64(rep), homes)").cast("int").alias("i"), F.explode(F.expr("sequence(0, guests - 1)")).alias("j"),
        F.lit(True).alias("home"), "rep", "n", "vec",
    )
    visiting = guests.withColumn("cell", F.explode("cells")).join(sizes, "cell").select(
        "cell", F.explode(F.expr("sequence(0, homes - 1)")).alias("i"), F.pmod(spot, F.col("guests")).cast("int").alias("j"),
        F.lit(False).alias("home"), "rep", "n", "vec",
    )
    found = stored(
        at_home.unionByName(visiting).groupBy("cell", "i", "j").applyInArrow(_products(threshold), "rep long, links long, other long"), "vectors-links"
    )
    links = found.where("other = rep").groupBy("rep").agg(F.sum("links").alias("links"))
    groups = components(found.where("other <> rep"), "rep", "other").withColumnRenamed("node", "rep")
    judged = stored(
        distinct.select("vec", "rep").join(links, "rep").join(groups, "rep", "left")
        .select("vec", "links", F.coalesce("component", "rep").alias("component")),
        "vectors-judged",
    )
    in_groups = each.where(usable).join(judged, "vec").select("id", "links", "component")
    alone = each.where(~usable).select("id", F.lit(0).cast("long").alias("links"), F.col("id").alias("component"))
    return in_groups.unionByName(alone).select(
        F.col("id").alias(id_col), F.col("links").alias("n_links"), F.col("component").alias("component_id"),
        F.col("id").eqNullSafe(F.col("component")).alias("kept"),
    )
