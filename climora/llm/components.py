"""Connected components by alternating stars, each round a written table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from climora.llm.storage import dropped, stored


def _smallest(pairs: DataFrame) -> DataFrame:
    """The smallest node each ``node`` sees, and whether its neighbours are all larger or it has a single one (settled), written."""
    low = F.min("other")
    return stored(
        pairs.groupBy("node").agg(
            F.least("node", low).alias("low"), ((low > F.col("node")) | (low == F.max("other"))).alias("settled")
        ),
        "smallest",
    )


def _linked_to_smallest(pairs: DataFrame, smallest: DataFrame, keep: str) -> DataFrame:
    """Every neighbour that passes ``keep`` is linked to the smallest node its ``node`` sees; ``smallest`` is removed.

    The minima are written before: the join then shuffles both sides itself, and Spark can split a
    node that holds most of the pairs.
    """
    linked = (
        pairs.where(keep)
        .join(smallest, "node")
        .select(F.col("other").alias("node"), F.col("low").alias("other"))
        .unionByName(
            smallest.where("low <> node").select("node", F.col("low").alias("other"))
        )
        .where("node <> other")
        .distinct()
    )
    table = stored(linked, "star")
    dropped(smallest)
    return table


def components(links: DataFrame, left: str, right: str) -> DataFrame:
    """Columns node and component (the smallest node reachable) for each node that has a link.

    ``links`` holds undirected links between integer ids, in any direction, repeated or not. Links of
    a node to itself and links with a null end are left out. No links give no rows. A path of n nodes
    takes O(log n) rounds; each round is two aggregations and two joins over the links that are left. The
    minima of a round tell first whether all components are stars already, so no round is made only to see that nothing changes.
    """
    links = links.select(F.col(left).alias("node"), F.col(right).alias("other"))
    table = stored(
        links.where("node <> other")
        .select(F.greatest("node", "other").alias("node"), F.least("node", "other").alias("other"))
        .distinct(),
        "links",
    )
    while True:
        both = table.unionByName(table.select(F.col("other").alias("node"), F.col("node").alias("other")))
        smallest = _smallest(both)
        # then each node is the centre of larger ones, or has only its centre
        if smallest.agg(F.bool_and("settled")).first()[0] is not False:
            dropped(smallest)
            break
        large = _linked_to_smallest(both, smallest, "other > node")
        small = _linked_to_smallest(large, _smallest(large), "true")
        dropped(large)
        dropped(table)
        table = small
    stars = table.select("node", F.col("other").alias("component"))
    return stars.unionByName(
        stars.select(F.col("component").alias("node"), "component").distinct()
    )
