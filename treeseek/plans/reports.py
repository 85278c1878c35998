"""Reports over an index."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from treeseek.functions.paths import value_at
from treeseek.model import NodeTypes
from treeseek.operators.mapping import DEFAULTS, UNMAPPED, conflicts, warnings
from treeseek.plans.search import Search, SearchResult


def search_report(search: Search, words: str, threshold: float = 0.7) -> tuple[DataFrame, DataFrame, int]:
    """The best ten hits, a better spelling if there is one, and the total."""
    found: SearchResult = search.fulltext(words).term_suggestions(words).limit(10).execute()
    return found.hits(), found.did_you_mean(threshold), found.total()


def view_node(docs: DataFrame, node_id: str, field: str | None = None) -> DataFrame:
    """All indexed fields of a node, or the value at one path."""
    rows = docs.where(F.col("node_id") == node_id)
    return rows if not field else rows.select("doc_id", "workspace", "dimension", value_at(rows, field).alias("value"))


def mapping_report(spark, types: NodeTypes) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The schema as rows, its conflicts, and properties without a mapping."""
    properties = types.property_frame(spark)
    known = spark.createDataFrame([(name,) for name in (*DEFAULTS, *UNMAPPED)], "declared string")
    unmapped = warnings(properties.where(F.col("mapping").isNull() & F.col("indexed")), known)
    schema = properties.where(F.col("mapping").isNotNull()).select("field", "mapping").distinct()
    return schema, conflicts(properties), unmapped
