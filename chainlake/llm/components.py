"""Connected components of a distributed link table, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chainlake.session import discard, settle


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of `links` (a, b); root is one node of its component.

    Each round every node moves to the neighbour (or itself) of least hash, the links are
    carried over to the chosen nodes, and what became a loop or a repeat goes. A fresh hash
    per round shrinks any graph, long chains too, by a constant factor on average. The moves
    of all rounds are then composed. A hub's links are reduced by a combining aggregate
    before the shuffle, and joined to its one new name in a join that can split. Each round
    is a table in the shared folder.
    """
    links = settle(links.where("a <> b").select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    moves: list[DataFrame] = []
    while not links.isEmpty():
        both = links.union(links.select("b", "a"))
        order = lambda c: F.struct(F.xxhash64(F.col(c), F.lit(len(moves))), F.col(c))
        near = both.groupBy(F.col("a").alias("node")).agg(F.min(order("b")).alias("near"))
        move = settle(near.select("node", F.when(F.col("near") < order("node"), F.col("near")["b"])
                                  .otherwise(F.col("node")).alias("to")))
        moves.append(move)
        to_a, to_b = (move.select(F.col("node").alias(c), F.col("to").alias(f"to_{c}")) for c in "ab")
        carried = (links.join(to_a, "a").join(to_b, "b").where("to_a <> to_b")
                   .select(F.least("to_a", "to_b").alias("a"), F.greatest("to_a", "to_b").alias("b")))
        done, links = links, settle(carried.distinct())
        discard(done)
    if not moves:
        return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    found = moves[0].withColumnRenamed("to", "root")
    for move in moves[1:]:
        step = move.select(F.col("node").alias("root"), F.col("to"))
        found = found.join(step, "root", "left").select("node", F.coalesce("to", "root").alias("root"))
    found = settle(found)
    discard(links, *moves)
    return found
