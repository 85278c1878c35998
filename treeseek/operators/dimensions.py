"""Dimensions: expand nodes to the dimensions that fall back to theirs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def specialise(nodes: DataFrame, variation: DataFrame) -> DataFrame:
    """Every node in its own dimension and in each one that falls back to it.

    ``variation(general, special, distance)`` lists all fallbacks, not only the
    direct ones. Where several variants reach the same dimension, the nearest
    one stays: an own variant is at distance 0. ``origin`` keeps the dimension
    the row came from.
    """
    own = nodes.withColumn("origin", F.col("dimension")).withColumn("_distance", F.lit(0))
    edges = F.broadcast(variation.select(F.col("general").alias("dimension"), "special", "distance"))
    copies = nodes.join(edges, "dimension").select(
        *[F.col("special").alias("dimension") if c == "dimension" else F.col(c) for c in nodes.columns],
        F.col("dimension").alias("origin"),
        F.col("distance").cast("int").alias("_distance"),
    )
    nearest = Window.partitionBy("workspace", "node_id", "dimension").orderBy("_distance")
    return (
        own.unionByName(copies)
        .withColumn("_rank", F.row_number().over(nearest))
        .where(F.col("_rank") == 1)
        .drop("_rank", "_distance")
    )


def fallback_pairs(direct: dict[str, str]) -> list[tuple[str, str, int]]:
    """All (general, special, distance) rows from special → general settings."""
    rows = []
    for special in direct:
        seen, current = [special], special
        while current in direct and direct[current] not in seen:
            current = direct[current]
            rows.append((current, special, len(seen)))
            seen.append(current)
    return rows
