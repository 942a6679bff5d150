"""Connected components of a graph of any size, by alternating stars.

Each round hangs every node's larger neighbours below its smallest neighbour, then its smaller ones
too, until nothing changes; the number of rounds grows with the logarithm of the graph's diameter. Only
minima are aggregated, so a node with very many links needs no list of them. Rounds are checkpointed in
the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hubbub.llm.common import cut


#: Links in one file of a checkpoint.
LINKS_PER_FILE = 200_000


def _state(edges: DataFrame) -> tuple:
    key = F.xxhash64("u", "v").cast("decimal(20,0)")
    row = edges.agg(F.count(F.lit(1)), F.sum(key)).first()
    return row[0], row[1]


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b) to (node, component); a component is named by its smallest node.

    Links to oneself and null ends are ignored; only linked nodes are returned.
    """
    both = edges.where("a IS NOT NULL AND b IS NOT NULL AND a != b")
    first = both.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    stars = cut(first.coalesce(edges.sparkSession.sparkContext.defaultParallelism))
    state = _state(stars)
    while state[0]:
        ways = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = ways.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = ways.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # A graph that has become small goes on in few files; a round never has more links.
        stars = small.unionByName(least.withColumnRenamed("m", "v")).distinct()
        stars = cut(stars.coalesce(1 + state[0] // LINKS_PER_FILE))
        before, state = state, _state(stars)
        if state == before:
            break
    nodes = stars.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.unionByName(nodes.select(F.col("component").alias("node"), "component").distinct())
