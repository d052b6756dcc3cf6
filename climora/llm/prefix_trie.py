"""The prefix trie of conversations, and sums over its subtrees by an Euler tour.

A node is a distinct sequence of first turns. Its key is its depth and the exclusive-or of the hashes of its (place,
turn) pairs, twice 64 bits, which is a prefix sum: it is summed within blocks of turns and over blocks, so a conversation of any
length is no task of its own. Nodes are numbered in the order of (smallest member, depth); arc 2i enters node i, arc
2i + 1 leaves it.

Each arc knows the next one of the tour: down to the first child, on to the next sibling, or back up. The list is ranked
in blocks of neighbouring arcs: every chain of arcs that follow each other inside a block is contracted to one, by pointer
jumping in numpy, until one chain is left, with wider blocks each time as chains thin out. Where neighbours in number are
no neighbours in the tour, a round of random mates contracts the list instead. Ranks then go back down level by level.

Leaves and savings weigh on the arcs that enter their nodes. With prefix sums over the ranked tour, the sum of a subtree
is what the tour gathers between entering and leaving its top.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from climora.llm.checksum_sql import crc32_sql
from climora.llm.storage import small_batches, stored

# Turns, arcs or sums that are gathered in one block; ids of conversations in one piece of text.
TURNS_PER_BLOCK = 1024
ARCS_PER_BLOCK = 65_536
IDS_PER_PIECE = 2048
_NODE = ("depth", "px", "py")


def indexed(frame: DataFrame, label: str, *order: str) -> DataFrame:
    """``frame`` with its place ``index`` (from 0) in the given order, by a distributed sort.

    The rows are written sorted, in files numbered in order; a place is that in the file after the rows of earlier files.
    """
    table = stored(frame.repartitionByRange(*order).sortWithinPartitions(*order), label)
    name = F.col("_metadata.file_name")
    file = F.struct(F.regexp_extract(name, r"part-(\d+)", 1).cast("long").alias("number"), F.regexp_extract(name, r"-c(\d+)", 1).alias("more"))
    placed = table.select(F.struct(*frame.columns).alias("own"), file.alias("file"), F.col("_metadata.row_index").alias("row"))
    earlier = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    files = placed.groupBy("file").agg(F.count("*").alias("n")).select(
        "file", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("first")
    )
    # One row per partition of the sort.
    return placed.join(F.broadcast(files), "file").select("own.*", (F.col("first") + F.col("row")).alias("index"))


def numbered_turns(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns as (conv_id, pos, a, b, chars) with two hashes in place of the text, and (conv_id, first, n) of all conversations.

    Turns go by ``turn``, null first; rows of one turn by role, length and hash of their text. Null roles and texts
    count as empty. Rows without a conversation are left out.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn"), F.xxhash64(role).alias("r"), F.length(text).cast("long").alias("chars"),
        F.xxhash64(role, text).alias("a"), F.xxhash64(F.lit(1), text, role).alias("b"), role.alias("role"),
    )
    placed = stored(indexed(rows, "trie-turns", "conv_id", "turn", "role", "chars", "a", "b").drop("turn", "r", "role"), "trie-numbered")
    starts = stored(placed.groupBy("conv_id").agg(F.min("index").alias("first"), F.count("*").alias("n")), "trie-starts")
    turns = placed.join(starts.select("conv_id", "first"), "conv_id").select(
        "conv_id", (F.col("index") - F.col("first")).alias("pos"), "a", "b", "chars"
    )
    return turns, starts.select("conv_id", "n")


def with_shared_heads(turns: DataFrame, convs: DataFrame, heads: DataFrame, most: int) -> tuple[DataFrame, DataFrame]:
    """Every conversation begins with the first turns of another one, in place of as many of its own.

    ``heads`` holds conv_id, donor and h: the first h turns of the donor (as many as there are, none without a donor),
    then the own turns after the first h. No h is above ``most``.
    """
    lengths = convs.select(F.col("conv_id").alias("donor"), F.col("n").alias("donor_n"))
    joined = (
        convs.join(heads, "conv_id").join(lengths, "donor", "left")
        .withColumn("take", F.least("h", F.coalesce("donor_n", F.lit(0))).cast("long"))
    )
    parts = stored(joined.select("conv_id", "donor", "h", "take", "n"), "trie-heads")
    tails = turns.join(parts.select("conv_id", "h", "take"), "conv_id").where("pos >= h")
    first = turns.where(F.col("pos") < most).withColumnRenamed("conv_id", "donor").join(
        parts.select("conv_id", "donor", "take").where("take > 0"), "donor"
    ).where("pos < take")
    both = tails.select("conv_id", (F.col("pos") - F.col("h") + F.col("take")).alias("pos"), "a", "b", "chars").unionByName(
        first.select("conv_id", "pos", "a", "b", "chars")
    )
    return both, parts.select("conv_id", (F.col("take") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("n"))


def _keyed(turns: DataFrame) -> DataFrame:
    """Adds depth, the key (px, py) of the prefix that ends in a turn, and that (bx, by) of the prefix before."""
    block = F.floor(F.col("pos") / TURNS_PER_BLOCK)
    salted = turns.select(
        "*", block.alias("block"), F.xxhash64("pos", "a", "b").alias("x"), F.xxhash64(F.lit(2), "b", "a", "pos").alias("y")
    )
    own = Window.partitionBy("conv_id", "block").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = salted.groupBy("conv_id", "block").agg(F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y")).select(
        "conv_id", "block", *[F.coalesce(F.bit_xor(c).over(earlier), F.lit(0)).alias(f"c{c}") for c in "xy"]
    )
    sums = salted.withColumns({f"s{c}": F.bit_xor(c).over(own) for c in "xy"}).join(carried, ["conv_id", "block"])
    key = {f"p{c}": F.col(f"s{c}").bitwiseXOR(F.col(f"c{c}")) for c in "xy"}
    before = {f"b{c}": key[f"p{c}"].bitwiseXOR(F.col(c)) for c in "xy"}
    return sums.withColumns(key | before).select(
        "conv_id", (F.col("pos") + 1).alias("depth"), "px", "py", "bx", "by", "chars"
    )


def _contracted(block: pd.DataFrame) -> pd.DataFrame:
    """Chains inside a block of arcs: head of each arc's chain and the distance to it; for heads, what follows the chain."""
    block = block.sort_values("id")
    ids, ahead, size = block.id.to_numpy(), block.next.to_numpy(), block.size_.to_numpy()
    place = np.minimum(np.searchsorted(ids, ahead), len(ids) - 1)
    inside = ids[place] == ahead
    before = np.arange(len(ids))
    before[place[inside]] = np.nonzero(inside)[0]
    away = np.where(before == np.arange(len(ids)), 0, size[before])
    while (before[before] != before).any():
        away, before = away + away[before], before[before]
    last = ~inside
    follows, length = np.empty_like(ids), np.empty_like(ids)
    follows[before[last]] = ahead[last]
    length[before[last]] = (away + size)[last]
    return pd.DataFrame({"id": ids, "head": ids[before], "away": away, "next": follows[before], "size_": length[before]})


_LEVEL = "id long, head long, away long, next long, size_ long"


def _mated(links: DataFrame, turn: int) -> DataFrame:
    """One round of random mates: an arc that drew 1, after one that drew 0, joins it."""
    def coin(column):
        return F.pmod(F.xxhash64(F.lit(turn), column), F.lit(2))

    before = links.where(coin(F.col("id")) == 0).select(F.col("id").alias("head"), F.col("next").alias("id"), F.col("size_").alias("away"))
    gone = stored(
        links.where(coin(F.col("id")) == 1).join(before, "id").select("id", "head", "away", "next", "size_"), "trie-mates"
    )
    grown = gone.select(F.col("head").alias("id"), F.col("next").alias("then"), F.col("size_").alias("more"))
    stay = links.join(gone.select("id"), "id", "left_anti").join(grown, "id", "left").select(
        "id", F.col("id").alias("head"), F.lit(0).cast("long").alias("away"),
        F.when(F.col("more").isNull(), F.col("next")).otherwise(F.col("then")).alias("next"),
        (F.col("size_") + F.coalesce("more", F.lit(0))).alias("size_"),
    )
    return stay.unionByName(gone)


def list_ranks(links: DataFrame, per_block: int | None = None) -> DataFrame:
    """Rank (0 for the first) of each id in the one list that ``links`` (id, next; -1 at the end) form; ids are dense from 0."""
    width = most = per_block or ARCS_PER_BLOCK
    current, levels, turn = links.select("id", "next", F.lit(1).cast("long").alias("size_")), [], 0
    local, crowded = True, 0
    while True:
        if local:
            wide = width
            level = current.groupBy(F.floor(F.col("id") / F.lit(wide)).alias("block")).applyInPandas(_contracted, _LEVEL)
        else:
            level = _mated(current, turn)
        level = stored(level, "trie-chains")
        levels.append(level)
        current = level.where("id = head").select("id", "next", "size_")
        turn += 1
        left, crowded = current.groupBy(F.floor(F.col("id") / F.lit(width)).alias("block")).agg(F.count("*").alias("n")).agg(
            F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("n"), F.lit(0))
        ).first()
        if left <= 1:
            break
        local = most // crowded >= 2
        if local:
            width *= most // crowded
    ranks = None
    for level in reversed(levels):
        here = level.select("id", "head", "away")
        if ranks is None:
            ranks = here.select("id", F.col("away").alias("rank"))
        else:
            above = ranks.select(F.col("id").alias("head"), F.col("rank").alias("base"))
            ranks = here.join(above, "head").select("id", (F.col("base") + F.col("away")).alias("rank"))
    return ranks


def _subtree_sums(arcs: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Sum over each node's subtree; ``arcs`` holds rank, node, and weights that are 0 on arcs that leave."""
    block = F.floor(F.col("rank") / ARCS_PER_BLOCK)
    rows = stored(arcs.withColumn("block", block), "trie-arcs")
    own = Window.partitionBy("block").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)  # a row per block of arcs
    carried = rows.groupBy("block").agg(*[F.sum(c).alias(c) for c in columns]).select(
        "block", *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"c_{c}") for c in columns]
    )
    sums = rows.withColumns({f"s_{c}": F.sum(c).over(own) for c in columns}).join(carried, "block")
    # Weights are not negative: the sum on leaving is the largest of the two.
    return sums.groupBy("node").agg(
        *[(F.max(F.col(f"s_{c}") + F.col(f"c_{c}")) - F.min(F.col(f"s_{c}") + F.col(f"c_{c}")) + F.max(c)).alias(c) for c in columns]
    )


def _pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of one node's sorted ids as pieces of comma-joined text."""
    key, held = None, []

    def piece():
        return pa.RecordBatch.from_pylist([dict(zip(_NODE, key), first=held[0], text=",".join(map(str, held)))], _PIECE_ROW)

    for batch in batches:
        depth, px, py, conv = (batch[n].to_pylist() for n in (*_NODE, "conv_id"))
        for *k, c in zip(depth, px, py, conv):
            if k != key or len(held) >= IDS_PER_PIECE:
                if held:
                    yield piece()
                key, held = k, []
            held.append(c)
    if held:
        yield piece()


_PIECE_ROW = pa.schema([*[(n, pa.int64()) for n in _NODE], ("first", pa.int64()), ("text", pa.string())])


def _digests(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 over each node's sorted pieces, which pass one after another."""
    key, digest = None, None

    def row():
        return pa.RecordBatch.from_pylist([dict(zip(_NODE, key), ends_sha256=digest.hexdigest())], _DIGEST_ROW)

    for batch in batches:
        depth, px, py, text = (batch[n].to_pylist() for n in (*_NODE, "text"))
        for *k, t in zip(depth, px, py, text):
            if k == key:
                digest.update(b",")
            else:
                if digest is not None:
                    yield row()
                key, digest = k, hashlib.sha256()
            digest.update(t.encode())
    if digest is not None:
        yield row()


_DIGEST_ROW = pa.schema([*[(n, pa.int64()) for n in _NODE], ("ends_sha256", pa.string())])


def _ends(ends: DataFrame) -> DataFrame:
    """Digest of the sorted conv_ids that end at each node.

    A digest is sequential by nature: the pieces of a node, each some thousand ids, pass through one task, none is held.
    """
    long = ", ".join(f"{n} long" for n in _NODE)
    pieces = ends.repartitionByRange(*_NODE, "conv_id").sortWithinPartitions(*_NODE, "conv_id").mapInArrow(
        _pieces, f"{long}, first long, text string"
    )
    return pieces.repartition(*_NODE).sortWithinPartitions(*_NODE, "first").mapInArrow(_digests, f"{long}, ends_sha256 string")


def prefix_trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """Nodes of the trie of conversations whose turns are numbered (``numbered_turns``).

    Columns: conv_id (smallest member), depth, parent_conv_id (null for the root), n_convs, n_children, n_leaves,
    saved_tokens (of the subtree: members beyond the first, times the code points of the last text), ends_sha256.
    Conversations without turns are members of the root. No conversations give no nodes.

    Two prefixes are held for one if 128 bits of hashes agree.
    """
    small_batches(turns.sparkSession)
    rows = stored(_keyed(turns), "trie-prefixes")
    zero = F.lit(0).cast("long")
    root = convs.groupBy().agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0").select(
        zero.alias("depth"), zero.alias("px"), zero.alias("py"), "conv_id", "n_convs", zero.alias("chars"),
        F.lit(None).cast("long").alias("bx"), F.lit(None).cast("long").alias("by"),
    )
    grouped = rows.groupBy(*_NODE).agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"),
        F.max("chars").alias("chars"), F.max("bx").alias("bx"), F.max("by").alias("by"),
    )
    nodes = stored(indexed(grouped.unionByName(root), "trie-nodes", "conv_id", "depth").withColumnRenamed("index", "node"), "trie-numbers")
    tops = nodes.select(
        (F.col("depth") + 1).alias("depth"), F.col("px").alias("bx"), F.col("py").alias("by"),
        F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"),
    )
    children = nodes.where("depth > 0").join(tops, ["depth", "bx", "by"]).select("node", "parent", "parent_conv_id")
    # Siblings stand next to each other in the order of (parent, node).
    family = stored(indexed(children, "trie-children", "parent", "node"), "trie-siblings")
    later = family.select((F.col("index") - 1).alias("index"), F.col("parent").alias("next_parent"), F.col("node").alias("next_node"))
    after = family.join(later, "index", "left").select(
        "node", "parent", "parent_conv_id", F.when(F.col("next_parent") == F.col("parent"), F.col("next_node")).alias("sibling")
    )
    below = family.groupBy("parent").agg(F.min("node").alias("child"), F.count("*").alias("n_children")).withColumnRenamed("parent", "node")
    tree = stored(
        nodes.join(after, "node", "left").join(below, "node", "left").select(
            "node", *_NODE, "conv_id", "parent_conv_id", "n_convs", F.coalesce("n_children", zero).alias("n_children"),
            ((F.col("n_convs") - 1) * F.col("chars")).alias("own"),
            F.coalesce(F.col("child") * 2, F.col("node") * 2 + 1).alias("down"),
            F.coalesce(F.col("sibling") * 2, F.col("parent") * 2 + 1, F.lit(-1)).alias("on"),
        ),
        "trie-tree",
    )
    links = tree.select(F.explode(F.array(
        F.struct((F.col("node") * 2).alias("id"), F.col("down").alias("next")),
        F.struct((F.col("node") * 2 + 1).alias("id"), F.col("on").alias("next")),
    )).alias("arc")).select("arc.*")
    leaf = F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long")
    weights = tree.select(F.explode(F.array(
        F.struct((F.col("node") * 2).alias("id"), leaf.alias("n_leaves"), F.col("own").alias("saved_tokens")),
        F.struct((F.col("node") * 2 + 1).alias("id"), zero.alias("n_leaves"), zero.alias("saved_tokens")),
    )).alias("arc")).select("arc.*")
    arcs = list_ranks(links).join(weights, "id").select("rank", F.floor(F.col("id") / 2).alias("node"), "n_leaves", "saved_tokens")
    sums = _subtree_sums(arcs, ("n_leaves", "saved_tokens"))
    turned = rows.join(convs.select("conv_id", F.col("n").alias("depth")), ["conv_id", "depth"]).select(*_NODE, "conv_id")
    bare = convs.where("n = 0").select(zero.alias("depth"), zero.alias("px"), zero.alias("py"), "conv_id")
    return tree.join(sums, "node").join(_ends(turned.unionByName(bare)), list(_NODE), "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The trie of the conversations as they are; see ``numbered_turns`` for nulls, ties and repeats, ``prefix_trie`` for the rest."""
    return prefix_trie(*numbered_turns(conversations))


def family_trie(conversations: DataFrame, family: int = 100, most: int = 5) -> DataFrame:
    """The trie after every conversation c was given the first turns of conversation c - c % ``family``.

    The number of turns is the unsigned CRC-32 of c in decimal digits, modulo ``most`` + 1. The remainder of a negative c is not
    positive, as in SQL.
    """
    turns, convs = numbered_turns(conversations)
    heads = convs.select(
        "conv_id", (F.col("conv_id") - F.col("conv_id") % family).alias("donor"),
        (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (most + 1)).alias("h"),
    )
    return prefix_trie(*with_shared_heads(turns, convs, heads, most))


def trie_sql(family: int = 100, most: int = 5) -> str:
    """``family_trie`` in SQL, with whole prefixes as keys and every pair of a node and one above it."""
    return f"""
    WITH t AS (
        SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS pos,
            length(coalesce(text, '')) AS chars, sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS e
        FROM conversations WHERE conv_id IS NOT NULL
    ),
    c AS (SELECT conv_id, count(*) AS n, {crc32_sql("CAST(conv_id AS VARCHAR)")} % {most + 1} AS h FROM t GROUP BY conv_id),
    p AS (
        SELECT c.conv_id, c.conv_id - c.conv_id % {family} AS donor, c.h, least(c.h, coalesce(d.n, 0)) AS take
        FROM c LEFT JOIN c AS d ON d.conv_id = c.conv_id - c.conv_id % {family}
    ),
    r AS (
        SELECT p.conv_id, t.pos, t.e, t.chars FROM p JOIN t ON t.conv_id = p.donor AND t.pos < p.take
        UNION ALL
        SELECT p.conv_id, t.pos - p.h + p.take, t.e, t.chars FROM p JOIN t ON t.conv_id = p.conv_id AND t.pos >= p.h
    ),
    k AS (
        SELECT conv_id, pos + 1 AS depth, chars, string_agg(e, '' ORDER BY pos) OVER (PARTITION BY conv_id ORDER BY pos) AS key FROM r
        UNION ALL SELECT conv_id, 0, 0, '' FROM c
    ),
    l AS (SELECT conv_id, max(depth) AS depth FROM k GROUP BY conv_id),
    v AS (
        SELECT k.depth, k.key, min(k.conv_id) AS conv_id, count(*) AS n_convs, max(k.chars) AS chars,
            coalesce(string_agg(CASE WHEN l.depth = k.depth THEN CAST(k.conv_id AS VARCHAR) END, ',' ORDER BY k.conv_id), '') AS ends
        FROM k JOIN l ON l.conv_id = k.conv_id GROUP BY k.depth, k.key
    ),
    n AS (SELECT depth - 1 AS depth, left(key, 64 * (depth - 1)) AS key, count(*) AS n_children FROM v WHERE depth > 0 GROUP BY ALL),
    a AS (
        SELECT v.*, coalesce(n.n_children, 0) AS n_children, u.conv_id AS parent_conv_id FROM v
        LEFT JOIN n ON n.depth = v.depth AND n.key = v.key
        LEFT JOIN v AS u ON u.depth = v.depth - 1 AND u.key = left(v.key, 64 * (v.depth - 1))
    ),
    s AS (
        SELECT left(key, 64 * above) AS key, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((n_convs - 1) * chars) AS saved
        FROM (SELECT a.*, unnest(range(depth + 1)) AS above FROM a) GROUP BY 1
    )
    SELECT a.conv_id, a.depth, a.parent_conv_id, a.n_convs, a.n_children, CAST(s.n_leaves AS BIGINT) AS n_leaves,
        CAST(s.saved AS BIGINT) AS saved_tokens, sha256(a.ends) AS ends_sha256
    FROM a JOIN s ON s.key = a.key
    """
