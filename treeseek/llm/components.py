"""Connected components of a graph given as edges, by contraction in rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from treeseek.llm.rows import HOT_ROWS
from treeseek.operators.skew import hot_keys, join_unique
from treeseek.session import materialise, materialise_counted


def components(edges: DataFrame, hot: int = HOT_ROWS) -> DataFrame:
    """From edges (a, b): ``node`` and ``root``, one node of its component, for all nodes with edges.

    Each round hangs every node under that of its neighbours and itself which
    comes first in an order that is drawn anew (a hash of round and node), and
    puts edges between the nodes that were chosen. An order drawn at random
    leaves about half of them, so that there are few rounds however long a
    chain is; a second pass resolves the names from the last round to the
    first. Every round is written to the shared folder. A node with very many
    edges is counted and dealt out over tasks.
    """
    both = edges.where("a != b")
    both = both.unionByName(both.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    live, n = materialise_counted(both, "edges")
    parents = []
    while n:
        drawn = F.lit(len(parents))
        own, other = (F.struct(F.xxhash64(drawn, c).alias("draw"), F.col(c).alias("node")) for c in ("a", "b"))
        first = live.groupBy("a").agg(F.min(other).alias("first"), F.count(F.lit(1)).alias("n"))
        degree = materialise(first.select("a", F.least("first", own)["node"].alias("up"), "n"), "degrees")
        large = hot_keys(degree.select("a", "n"), ["a"], hot)
        parent = degree.select(F.col("a"), "up")
        parents.append(parent)
        moved = join_unique(live, parent, ["a"], large, ["b"]).select(F.col("b").alias("a"), F.col("up").alias("b"))
        moved = join_unique(moved, parent, ["a"], large, ["b"]).select(F.col("up").alias("a"), "b")
        live, n = materialise_counted(moved.where("a != b").distinct(), "edges")
    if not parents:
        return both.select(F.col("a").alias("node"), F.col("b").alias("root"))
    found = _flat(parents[-1])
    for parent in reversed(parents[:-1]):
        upper = found.select(F.col("node").alias("up"), F.col("root"))
        counts = materialise(parent.groupBy("up").agg(F.count(F.lit(1)).alias("n")), "degrees")
        named = join_unique(parent, upper, ["up"], hot_keys(counts, ["up"], hot), ["a"], "left")
        found = materialise(named.select(F.col("a").alias("node"), F.coalesce("root", "up").alias("root")), "roots")
    return found


def _flat(parent: DataFrame) -> DataFrame:
    return parent.select(F.col("a").alias("node"), F.col("up").alias("root"))
