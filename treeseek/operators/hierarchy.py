"""The node tree: paths, inherited flags, closest full-text root.

Everything a node inherits from its ancestors travels down with the path, one
level per step, so that no node is ever exploded into its ancestors.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from treeseek.functions.paths import ancestors
from treeseek.model import KEYS, TAG_DISABLED, TAG_REMOVED
from treeseek.operators.skew import hot_keys, join_unique
from treeseek.session import materialise, materialise_counted

_SCOPE = ("workspace", "dimension")
_PARENT = (*_SCOPE, "parent_id")
_CARRIED = ("path", "order_key", "depth", "closest_root", "disabled", "removed")


@dataclass(frozen=True)
class Resolved:
    """``nodes``: one row per reachable node. ``unreachable``: the other keys,
    nodes whose parents are missing or form a cycle."""

    nodes: DataFrame
    unreachable: DataFrame


def _edges(nodes: DataFrame, flags: DataFrame | None) -> DataFrame:
    tags = F.coalesce(F.col("tags"), F.array().cast("array<string>"))
    # Shifted and padded so that text order is numeric order, also below zero.
    position = F.lpad((F.coalesce(F.col("sort_index"), F.lit(0)) + F.lit(2**62)).cast("string"), 19, "0")
    if flags is not None:
        nodes = nodes.join(F.broadcast(flags.select("type", "fulltext_root")), "type", "left")
    elif "fulltext_root" not in nodes.columns:
        nodes = nodes.withColumn("fulltext_root", F.lit(False))
    # The dimension a node was taken from, where it stands in for a missing variant.
    origin = F.col("origin") if "origin" in nodes.columns else F.col("dimension")
    return nodes.select(
        *_SCOPE,
        "node_id",
        "parent_id",
        origin.alias("origin"),
        F.concat_ws(":", position, F.col("node_id")).alias("own_order"),
        F.coalesce(F.col("fulltext_root"), F.lit(False)).alias("own_root"),
        F.array_contains(tags, TAG_DISABLED).alias("own_disabled"),
        F.array_contains(tags, TAG_REMOVED).alias("own_removed"),
    )


def _start(edges: DataFrame) -> DataFrame:
    return edges.where(F.col("parent_id").isNull()).select(
        *KEYS,
        "origin",
        F.col("node_id").alias("path"),
        F.col("own_order").alias("order_key"),
        F.lit(0).alias("depth"),
        F.when(F.col("own_root"), F.col("node_id")).alias("closest_root"),
        F.col("own_disabled").alias("disabled"),
        F.col("own_removed").alias("removed"),
    )


def _descend(edges: DataFrame, parents: DataFrame, hot: DataFrame) -> DataFrame:
    above = parents.select(
        *_SCOPE, F.col("node_id").alias("parent_id"), *[F.col(c).alias(f"up_{c}") for c in _CARRIED]
    )
    return join_unique(edges, above, _PARENT, hot, spread=("node_id",)).select(
        *KEYS,
        "origin",
        F.concat_ws("/", "up_path", "node_id").alias("path"),
        F.concat_ws("/", "up_order_key", "own_order").alias("order_key"),
        (F.col("up_depth") + 1).alias("depth"),
        F.when(F.col("own_root"), F.col("node_id")).otherwise(F.col("up_closest_root")).alias("closest_root"),
        (F.col("own_disabled") | F.col("up_disabled")).alias("disabled"),
        (F.col("own_removed") | F.col("up_removed")).alias("removed"),
    )


def resolve(nodes: DataFrame, types: DataFrame | None = None, above: DataFrame | None = None) -> Resolved:
    """Path, depth, document order, inherited flags and closest root of every node.

    Only nodes that have children go through the level loop. Leaves, the bulk
    of a tree, take part in one join at the end.

    ``above`` holds resolved nodes that ``nodes`` may hang under: with it, a
    moved or changed subtree is resolved alone.
    """
    edges = materialise(_edges(nodes, types), "tree-edges")
    counts, n_parents = materialise_counted(
        edges.where(F.col("parent_id").isNotNull()).groupBy(*_PARENT).agg(F.count("*").alias("n")),
        "tree-parents",
    )
    hot = hot_keys(counts, _PARENT) if n_parents else None
    parents = counts.select(*_SCOPE, F.col("parent_id").alias("node_id"))
    inner = materialise(edges.join(parents, list(KEYS), "left_semi"), "tree-inner")

    start = _start(inner)
    if above is not None:
        start = start.unionByName(_descend(inner, above, hot))
    frontier, reached = materialise_counted(start, "tree-level")
    levels = [frontier]
    while reached:
        frontier, reached = materialise_counted(_descend(inner, frontier, hot), "tree-level")
        levels.append(frontier)
    paths = levels[0] if above is None else levels[0].unionByName(above.select(levels[0].columns))
    for level in levels[1:]:
        paths = paths.unionByName(level)

    resolved = _start(edges).unionByName(_descend(edges, paths, hot))
    slim = materialise(resolved, "tree-paths")
    return Resolved(slim, edges.select(*KEYS).join(slim.select(*KEYS), list(KEYS), "left_anti"))


def closure_of(edges: DataFrame) -> DataFrame:
    """(type, ancestor) pairs of every type, itself included, from (type, supertype).

    For type tables that come as data: one recursive query, in which a way that
    comes back to a type that it has passed ends.
    """
    return edges.sparkSession.sql(
        """
        WITH RECURSIVE above(type, ancestor, passed) AS (
          SELECT type, type, array(type)
          FROM (SELECT type FROM {edges} UNION SELECT supertype FROM {edges} WHERE supertype IS NOT NULL)
          UNION ALL
          SELECT above.type, step.supertype, array_append(above.passed, step.supertype)
          FROM above JOIN {edges} AS step ON step.type = above.ancestor
          WHERE step.supertype IS NOT NULL AND NOT array_contains(above.passed, step.supertype))
        SELECT DISTINCT type, ancestor FROM above""",
        edges=edges,
    )


def closest_roots(resolved: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(node, its full-text root) pairs, and the nodes that have no root above them."""
    pairs = resolved.where(F.col("closest_root").isNotNull()).select(
        *KEYS, F.col("closest_root").alias("root_id")
    )
    # The top of the tree is above all pages, so it is not worth a warning.
    missing = resolved.where(F.col("closest_root").isNull() & (F.col("depth") > 0)).select(*KEYS, "path")
    return pairs, missing


def below_marked(flat: DataFrame, marked: DataFrame, key: str = "path") -> DataFrame:
    """Rows of ``flat`` at or below a path in ``marked``, for tables that hold paths only.

    One row per matching prefix is built, so use :func:`resolve` where parents
    are known.
    """
    own = flat.withColumn("_prefix", F.explode(F.array_append(ancestors(F.col(key)), F.col(key))))
    hits = own.join(marked.select(F.col(key).alias("_prefix")), "_prefix", "left_semi")
    return hits.drop("_prefix").dropDuplicates([key])
