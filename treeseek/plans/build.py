"""Build a whole index: documents, full-text parts, postings, statistics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from treeseek.functions.analysis import AnalyzerSet
from treeseek.functions.ids import address_id
from treeseek.model import KEYS, NodeTypes
from treeseek.operators import hierarchy, projection, rollup, text_index, validity, workspaces
from treeseek.operators.dimensions import specialise
from treeseek.operators.text_index import TextIndex
from treeseek.session import materialise
from treeseek.sources import nodes as node_source


@dataclass(frozen=True)
class BuildConfig:
    types: NodeTypes
    type_settings: Mapping[str, bool] | None = field(default_factory=lambda: {"*": True})
    index_all_workspaces: bool = True
    # Each workspace with its base. Workspaces with a base may hold changes only.
    workspaces: Mapping[str, str | None] = field(default_factory=dict)
    variation: Sequence[tuple[str, str, int]] = ()
    analyzers: AnalyzerSet = AnalyzerSet()
    doc_id: projection.IdGenerator = address_id
    limit: int | None = None
    checks: Mapping[str, Column] = field(default_factory=dict)


@dataclass(frozen=True)
class Built:
    """Everything a version of an index consists of. ``lost_parts`` are nodes
    with text but without a page, ``errors`` the quarantined documents."""

    docs: DataFrame
    parts: DataFrame
    tree: DataFrame
    text: TextIndex
    errors: DataFrame
    lost_parts: DataFrame
    unreachable: DataFrame


def build(nodes: DataFrame, config: BuildConfig, run_id: str = "build") -> Built:
    """From node table to index. Intermediate tables are written to the shared
    folder, so that an executor loss costs one step and not the build."""
    spark = nodes.sparkSession
    scoped = projection.publish_to_target(projection.scope_to_live(nodes, config.index_all_workspaces))
    layered = config.index_all_workspaces and any(config.workspaces.values())
    if layered:
        types = config.types.frame(spark)
        scoped = workspaces.complete(scoped, config.workspaces, types, variants=bool(config.variation))
        scoped = materialise(scoped, "whole-workspaces")
    tree = hierarchy.resolve(skeleton(scoped, config), config.types.frame(spark))

    documents = projection.project(scoped, tree.nodes, config.types, config.type_settings, config.doc_id)
    if config.limit is not None:
        documents = node_source.limit_per_index(documents, config.limit)
    good, bad = validity.split(documents, checks_of(config), run_id)

    # Written, so that HTML is taken apart once although ranges are found by reading twice.
    extracted = materialise(
        rollup.extract(
            scoped.where(projection.indexable(F.col("type"), config.type_settings)),
            rollup.extractors_of(config.types),
        ),
        "extracted",
    )
    parts, lost = rollup.parts(extracted, tree.nodes)
    chunks = rollup.chunked(parts)
    text = page_index(chunks, config)
    fulltext = rollup.to_buckets(rollup.roll_up(chunks)).withColumnRenamed("root_id", "node_id")
    docs = good.join(fulltext, list(KEYS), "left")
    if layered:
        gone = workspaces.tombstones(tree.nodes, config.workspaces, config.doc_id)
        docs = docs.withColumn("deleted", F.lit(False)).unionByName(gone, allowMissingColumns=True)
    docs = materialise(docs, "documents")
    return Built(docs, chunks.drop("chunk"), tree.nodes, text, bad, lost, tree.unreachable)


def checks_of(config: BuildConfig) -> dict[str, Column]:
    """What every document must hold, by the name of what is wrong if it does not."""
    return {
        "no document id": F.col("doc_id").isNotNull(),
        "unknown type": F.col("type_closure").isNotNull(),
        **config.checks,
    }


def skeleton(nodes: DataFrame, config: BuildConfig) -> DataFrame:
    """The columns that place a node, in every dimension that shows it.

    Only these go through the expansion and the tree; properties wait for the
    projection.
    """
    slim = nodes.select(*KEYS, "parent_id", "type", "tags", "sort_index")
    if not config.variation:
        return slim
    return specialise(slim, variation_frame(nodes.sparkSession, config))


def variation_frame(spark, config: BuildConfig) -> DataFrame:
    return spark.createDataFrame(list(config.variation), "general string, special string, distance int")


def page_index(chunks: DataFrame, config: BuildConfig) -> TextIndex:
    """The text index of pages, straight from their parts."""
    # One expression per bucket with an analyser of its own, else one for all.
    text, dimension = F.col("text"), F.col("dimension")
    tokens = config.analyzers.tokens(text, dimension, "")
    for name in config.analyzers.by_field:
        tokens = F.when(F.col("bucket") == name, config.analyzers.tokens(text, dimension, name)).otherwise(tokens)
    located = rollup.with_offsets(rollup.tokenised(chunks, tokens))
    inverted = text_index.invert_parts(located)
    doc_id = config.doc_id(F.col("root_id"), F.col("workspace"), F.col("dimension")).alias("doc_id")
    columns = ("field", "term", "tf", "positions", "dl")
    postings = materialise(inverted.select(doc_id, *text_index.SCOPE, *columns), "postings")
    return TextIndex(postings, text_index.field_stats(postings), text_index.term_stats(postings), config.analyzers)


def reindex_node(nodes: DataFrame, config: BuildConfig, resolved: DataFrame, node_id: str) -> DataFrame:
    """The documents of one node in every workspace and dimension, from a known tree."""
    single = node_source.single(nodes, node_id)
    return projection.project(
        projection.scope_to_live(single, config.index_all_workspaces),
        resolved.where(F.col("node_id") == node_id),
        config.types,
        config.type_settings,
        config.doc_id,
    )
