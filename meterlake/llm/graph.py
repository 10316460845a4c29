"""Connected components of an edge table by repeated contraction, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.llm import scratch

#: Rounds whose moves are joined in one plan, so that no plan grows with the number of rounds.
FOLD = 3


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``component`` (its smallest node) for each node of an edge table ``a``, ``b``.

    In each round a node moves to the least of its neighbourhood and the edges follow, without
    loops and repeats.  Rounds take turns between the nodes' own order, which ends stars around
    their least node at once, and a random order, which shortens chains by a constant factor, so
    the rounds grow with the logarithm of the nodes.  Minima are combined before the shuffle, and
    a joined hub is split by the skewed-join rule.  Rows with a null end are left out.  Every round
    is a table in the shared folder; at the end they are followed from the last, smallest one back,
    ``FOLD`` in a plan, so the driver plans and broadcasts a few at a time however many rounds
    there were.  Nodes may be of any type that can be ordered.
    """
    live = edges.where("a IS NOT NULL AND b IS NOT NULL").where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    live = scratch.write(live, "edges")
    maps = []
    turn = 0
    while not live.isEmpty():
        both = live.union(live.select("b", "a")).toDF("node", "other")
        if turn % 2 == 0:
            least = both.groupBy("node").agg(F.min("other").alias("m")).select("node", F.least("node", "m").alias("to"))
        else:
            rank = lambda c: F.struct(F.xxhash64(F.lit(turn), F.col(c)).alias("r"), F.col(c).alias("v"))
            least = both.groupBy("node").agg(F.min(rank("other")).alias("m")).select("node", F.least(rank("node"), F.col("m"))["v"].alias("to"))
        moved = scratch.write(least, "moves")
        maps.append(moved)
        nxt = (
            live.join(moved.toDF("a", "ta"), "a").join(moved.toDF("b", "tb"), "b").where("ta <> tb")
            .select(F.least("ta", "tb").alias("a"), F.greatest("ta", "tb").alias("b")).distinct()
        )
        nxt = scratch.write(nxt, "edges")
        scratch.drop(live)
        live = nxt
        turn += 1
    if not maps:
        return live.select(F.col("a").alias("node"), F.col("b").alias("component"))
    # Where the nodes of a round end up: where those that they moved to do.  The first round has all nodes.
    found = maps.pop()
    while maps:
        later, here = [found], found
        for moved in reversed(maps[-FOLD:]):
            here = moved.join(here.toDF("to", "_to"), "to", "left").select("node", F.coalesce("_to", "to").alias("to"))
        later += maps[-FOLD:]
        del maps[-FOLD:]
        found = scratch.write(here, "found")
        scratch.drop(*later)
    root = found.groupBy("to").agg(F.min("node").alias("component"))
    out = scratch.write(found.join(root, "to").select("node", "component"), "components")
    scratch.drop(live, found)
    return out
