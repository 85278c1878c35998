"""Workspaces: a chain of versions, nearest first, seen as one."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def chain(workspaces: dict[str, str | None], name: str) -> list[str]:
    """The workspace and its bases, nearest first."""
    result = [name]
    while workspaces.get(result[-1]):
        base = workspaces[result[-1]]
        if base in result:
            raise ValueError(f"workspace {name} is its own base")
        result.append(base)
    return result


def overlay(
    docs: DataFrame,
    workspaces: Sequence[str],
    key: Sequence[str] = ("node_id", "dimension"),
    deleted: str = "deleted",
) -> DataFrame:
    """What a workspace shows: its own rows, and base rows it does not replace.

    A base row goes as soon as a nearer workspace has the node at all, changed
    or deleted, before any filter runs. Only the keys of the nearer workspaces
    meet the base, so a small workspace never shuffles a large base: the size
    on hand at run time decides between broadcast and shuffle.
    """
    gone = F.coalesce(F.col(deleted), F.lit(False)) if deleted in docs.columns else F.lit(False)
    layers = []
    for position, workspace in enumerate(workspaces):
        rows = docs.where((F.col("workspace") == workspace) & ~gone)
        nearer = list(workspaces[:position])
        if nearer:
            replaced = docs.where(F.col("workspace").isin(nearer)).select(*key)
            rows = rows.join(replaced, list(key), "left_anti")
        layers.append(rows)
    return reduce(DataFrame.unionByName, layers).select(docs.columns)


def first_hit(
    hits: DataFrame, workspaces: Sequence[str], order: Sequence[Column] = (), key: Sequence[str] = ("node_id", "dimension")
) -> DataFrame:
    """One hit per node out of a chain: the best in hit order, ties to the nearer workspace."""
    rank = F.array_position(F.array(*[F.lit(w) for w in workspaces]), F.col("workspace"))
    best = Window.partitionBy(*key).orderBy(*order, rank)
    return (
        hits.where(F.col("workspace").isin(list(workspaces)))
        .withColumn("_rank", F.row_number().over(best))
        .where(F.col("_rank") == 1)
        .drop("_rank")
    )


def live_hits(hits: DataFrame, nodes: DataFrame, key: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Hits whose node still exists, and the stale ones for a warning."""
    keys = nodes.select(*key)
    return hits.join(keys, list(key), "left_semi"), hits.join(keys, list(key), "left_anti")
