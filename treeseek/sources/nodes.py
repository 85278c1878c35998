"""Node scans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from treeseek.operators.skew import first_n


def scan(nodes: DataFrame, workspace: str | None = None, dimension: str | None = None) -> DataFrame:
    """Nodes of one workspace and dimension, or of all in one pass.

    Both are partition columns of a stored node table, so this prunes folders.
    """
    if workspace is not None:
        nodes = nodes.where(F.col("workspace") == workspace)
    if dimension is not None:
        nodes = nodes.where(F.col("dimension") == dimension)
    return nodes


def without_removed(resolved: DataFrame) -> DataFrame:
    """Removed subtrees are out, disabled ones stay in."""
    return resolved.where(~F.col("removed"))


def limit_per_index(docs: DataFrame, n: int) -> DataFrame:
    """The first ``n`` nodes by path of each workspace and dimension."""
    return first_n(docs, ("workspace", "dimension"), [F.asc("path")], n, spread=("node_id",))


def single(nodes: DataFrame, node_id: str) -> DataFrame:
    """One node in every workspace and dimension."""
    return nodes.where(F.col("node_id") == node_id)


def index_status(targets: DataFrame, nodes: DataFrame, node_ids: Sequence[str]) -> DataFrame:
    """Per (workspace, dimension) and node: was it there to be indexed."""
    wanted = targets.select("workspace", "dimension").distinct().withColumn(
        "node_id", F.explode(F.array(*[F.lit(i) for i in node_ids]))
    )
    present = nodes.where(F.col("node_id").isin(list(node_ids))).select(
        "workspace", "dimension", "node_id", F.lit("indexed").alias("found")
    )
    return wanted.join(present, ["workspace", "dimension", "node_id"], "left").select(
        "workspace", "dimension", "node_id", F.coalesce("found", F.lit("not found")).alias("status")
    )
