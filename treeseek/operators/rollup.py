"""Full text: the parts of a page, and the page's text out of its parts."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from treeseek.functions.html import BUCKETS
from treeseek.model import KEYS, NodeTypes
from treeseek.operators.skew import ordered_chunks
from treeseek.session import materialise

ROOT = ("workspace", "dimension", "root_id")
_NO_ROWS = "array<struct<bucket:string,text:string>>"


def extract(nodes: DataFrame, extractors: Mapping[str, Mapping[str, Callable[[Column], Column]]]) -> DataFrame:
    """Rows (node key, bucket, text) from ``{type: {property: extractor}}``.

    One branch per distinct extractor, not per type; buckets of one node are
    joined by a blank in the order of its properties.
    """
    branches: dict[tuple, list[str]] = {}
    for type_name, by_property in extractors.items():
        for prop, function in by_property.items():
            branches.setdefault((prop, function), []).append(type_name)
    found = [
        F.when(F.col("type").isin(type_names), function(F.col("properties").getItem(prop))).otherwise(
            F.array().cast(_NO_ROWS)
        )
        for (prop, function), type_names in sorted(branches.items(), key=lambda b: b[0][0])
    ]
    if not found:
        found = [F.array().cast(_NO_ROWS)]
    rows = nodes.select(*KEYS, F.flatten(F.array(*found)).alias("rows"))

    def bucket(name: str) -> Column:
        own = F.filter("rows", lambda r: r["bucket"] == name)
        return F.struct(
            F.lit(name).alias("bucket"),
            F.array_join(F.transform(own, lambda r: F.trim(r["text"])), " ").alias("text"),
        )

    per_bucket = F.array(*[bucket(b) for b in BUCKETS])
    return rows.select(*KEYS, F.inline(F.filter(per_bucket, lambda r: F.length(r["text"]) > 0)))


def extractors_of(types: NodeTypes) -> dict[str, dict[str, Callable]]:
    """Extractors per type, for types with full text switched on."""
    found = {}
    for node_type in types:
        if types.is_fulltext_enabled(node_type.name):
            own = {n: p.extractor for n, p in types.properties(node_type.name).items() if p.extractor}
            if own:
                found[node_type.name] = own
    return found


def parts(extracted: DataFrame, resolved: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The parts table, and the nodes with text but no root.

    A part is filed under its closest root, which may be the node itself. Parts
    of hidden or removed nodes and empty parts are left out. Text is extracted
    once per stored node and filed in every dimension that shows it.
    """
    tree = resolved.where(~F.col("removed") & ~F.col("disabled")).select(
        *KEYS, "origin", F.col("closest_root").alias("root_id"), F.col("order_key").alias("part_order"), "path"
    )
    stored = extracted.where(F.length(F.trim("text")) > 0).withColumnRenamed("dimension", "origin")
    joined = stored.join(tree, ["workspace", "origin", "node_id"])
    filed = joined.where(F.col("root_id").isNotNull()).select(
        *ROOT, F.col("node_id").alias("part_node_id"), "part_order", "bucket", F.trim("text").alias("text")
    )
    lost = joined.where(F.col("root_id").isNull()).select(*KEYS, "path").distinct()
    return filed, lost


def chunked(parts_table: DataFrame) -> DataFrame:
    """Parts cut into ranges of document order, so that no page is one task's work."""
    return ordered_chunks(parts_table, (*ROOT, "bucket"), ("part_order", "part_node_id"), "parts")


def roll_up(chunks: DataFrame) -> DataFrame:
    """Text per page and bucket: its parts in document order, one blank between.

    Text is joined per range first; a page only meets its few ranges in the end.
    """
    group = (*ROOT, "bucket")
    ordered = F.array_sort(F.collect_list(F.struct("part_order", "part_node_id", "text")))
    pieces = chunks.groupBy(*group, "chunk").agg(
        F.array_join(F.transform(ordered, lambda r: r["text"]), " ").alias("text")
    )
    by_range = F.array_sort(F.collect_list(F.struct("chunk", "text")))
    return pieces.groupBy(*group).agg(
        F.array_join(F.transform(by_range, lambda r: r["text"]), " ").alias("text")
    )


def to_buckets(rolled: DataFrame) -> DataFrame:
    """One row per page with a ``fulltext`` struct of the seven buckets."""
    columns = [F.max(F.when(F.col("bucket") == b, F.col("text"))).alias(b) for b in BUCKETS]
    return rolled.groupBy(*ROOT).agg(*columns).select(*ROOT, F.struct(*BUCKETS).alias("fulltext"))


def tokenised(chunks: DataFrame, tokens: Column) -> DataFrame:
    """Parts with their terms instead of their text, written, since they are read twice."""
    terms = chunks.withColumn("tokens", tokens).withColumn("n_tokens", F.size("tokens"))
    return materialise(terms.drop("text"), "tokenised-parts")


def with_offsets(counted: DataFrame) -> DataFrame:
    """Tokenised parts with the place of their first term in the whole bucket, and in how many ranges the bucket lies.

    A running count in two steps: within each range, and over the ranges of a
    page. Neither step sees all parts of a large page.
    """
    group = (*ROOT, "bucket")
    per_range = counted.groupBy(*group, "chunk").agg(F.sum("n_tokens").alias("range_tokens"))
    earlier = Window.partitionBy(*group).orderBy("chunk")
    before_range = per_range.select(
        *group,
        "chunk",
        F.coalesce(
            F.sum("range_tokens").over(earlier.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ).alias("range_offset"),
        F.sum("range_tokens").over(Window.partitionBy(*group)).alias("dl"),
        F.count(F.lit(1)).over(Window.partitionBy(*group)).alias("n_ranges"),
    )
    within = (
        Window.partitionBy(*group, "chunk")
        .orderBy("part_order", "part_node_id")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    local = counted.withColumn("_local", F.coalesce(F.sum("n_tokens").over(within), F.lit(0)))
    return local.join(before_range, [*group, "chunk"]).select(
        *group, "chunk", "part_node_id", "tokens",
        (F.col("_local") + F.col("range_offset")).cast("int").alias("offset"), "dl", "n_ranges",
    )


def touched(parts_table: DataFrame, roots: DataFrame) -> DataFrame:
    """Only the parts of the given pages, for an incremental roll-up."""
    return parts_table.join(roots.select(*ROOT).distinct(), list(ROOT), "left_semi")


def replace_parts(parts_table: DataFrame, changed_nodes: DataFrame, new_parts: DataFrame) -> DataFrame:
    """Put, replace or remove the parts of single nodes.

    All parts of a changed node go, wherever it was filed before; its new ones
    come in. A node without new parts is thereby removed.
    """
    keys = changed_nodes.select("workspace", "dimension", F.col("node_id").alias("part_node_id")).distinct()
    kept = parts_table.join(keys, ["workspace", "dimension", "part_node_id"], "left_anti")
    return kept.select(parts_table.columns).unionByName(new_parts.select(parts_table.columns))
