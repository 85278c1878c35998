"""Document ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def address_id(node_id: Column, workspace: Column, dimension: Column, repository: str = "default") -> Column:
    """sha1 over the JSON of the full node address."""
    address = F.struct(
        F.lit(repository).alias("repository"),
        workspace.cast("string").alias("workspace"),
        dimension.cast("string").alias("dimension"),
        node_id.cast("string").alias("node_id"),
    )
    return F.sha1(F.to_json(address).cast("binary"))


def plain_id(node_id: Column, workspace: Column) -> Column:
    """sha1 over node id and workspace; the same in every dimension."""
    return F.sha1(F.concat(node_id.cast("string"), workspace.cast("string")).cast("binary"))
