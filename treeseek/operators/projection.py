"""From node to search document."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from treeseek.functions.ids import address_id
from treeseek.functions.paths import ancestors, type_namespace
from treeseek.model import KEYS, LIVE, NodeTypes
from treeseek.operators.mapping import mapped_type, schema_of, to_column
from treeseek.operators.skew import hot_keys, join_unique
from treeseek.session import materialise

IdGenerator = Callable[[Column, Column, Column], Column]
REFERENCES = ("reference", "references")


def indexable(type_name: Column, settings: Mapping[str, bool] | None) -> Column:
    """Is the type indexed: its own setting, its namespace's, the general one, else no.

    Without any settings everything is indexed.
    """
    if settings is None:
        return F.lit(True)
    if not settings:
        return F.lit(False)
    table = F.create_map(*[v for k, flag in settings.items() for v in (F.lit(k), F.lit(bool(flag)))])
    return F.coalesce(
        F.try_element_at(table, type_name),
        F.try_element_at(table, F.concat(type_namespace(type_name), F.lit(":*"))),
        F.try_element_at(table, F.lit("*")),
        F.lit(False),
    )


def indexable_report(types: DataFrame, settings: Mapping[str, bool] | None) -> DataFrame:
    return types.select("type", indexable(F.col("type"), settings).alias("indexable"))


def with_type_closure(nodes: DataFrame, closure: DataFrame) -> DataFrame:
    """Adds ``type_closure``, from (type, ancestor) pairs of the configured types."""
    grouped = closure.groupBy("type").agg(F.array_sort(F.collect_set("ancestor")).alias("type_closure"))
    return nodes.join(grouped, "type", "left")


def scope_to_live(nodes: DataFrame, index_all_workspaces: bool) -> DataFrame:
    """Only the live workspace, unless all are indexed."""
    if index_all_workspaces:
        return nodes
    target = F.col("target_workspace") if "target_workspace" in nodes.columns else F.lit(None)
    return nodes.where(F.coalesce(target, F.col("workspace")) == LIVE)


def publish_to_target(nodes: DataFrame) -> DataFrame:
    """A node that is published takes the workspace it is published to."""
    if "target_workspace" not in nodes.columns:
        return nodes
    return nodes.withColumn("workspace", F.coalesce("target_workspace", "workspace")).drop("target_workspace")


def resolve_in_target(changes: DataFrame, nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Changed nodes as they are in the target, and those that are not there."""
    keys = list(KEYS)
    return changes.join(nodes, keys, "inner"), changes.join(nodes.select(*keys), keys, "left_anti")


def is_indexable(type_name: str, settings: Mapping[str, bool] | None) -> bool:
    """:func:`indexable` for the name of a type."""
    if settings is None:
        return True
    namespace = f"{type_name.partition(':')[0]}:*"
    return bool(next((settings[k] for k in (type_name, namespace, "*") if k in settings), False))


def property_columns(
    types: NodeTypes, drop: tuple[str, ...] = (), settings: Mapping[str, bool] | None = None
) -> list[Column]:
    """One typed column per mapped property, after the indexing expression of the node's own type.

    A type that switches a property off has null in its column, whatever other
    types do with it.
    """
    columns = []
    for name, mapping in sorted(schema_of(types, lambda t: is_indexable(t, settings)).items()):
        if name in drop:
            continue
        stored = F.col("properties").getItem(name)
        # Types by what they do with the property: no index at all, an expression of theirs, or references.
        by_use: dict[Callable | tuple[str, ...] | None, list[str]] = {}
        for node_type in types:
            prop = types.properties(node_type.name).get(name)
            if prop is None:
                continue
            if mapped_type(prop) is None:
                by_use.setdefault(None, []).append(node_type.name)
            elif callable(prop.indexing):
                by_use.setdefault(prop.indexing, []).append(node_type.name)
            elif prop.type in REFERENCES and mapping in ("keyword", "keywords"):
                by_use.setdefault(REFERENCES, []).append(node_type.name)
        value = to_column(stored, mapping)
        for use, names in by_use.items():
            if use is None:
                own = F.lit(None)
            elif use is REFERENCES:
                own = reference_column(stored, mapping)
            else:
                own = to_column(use(stored, F.col), mapping)
            value = F.when(F.col("type").isin(names), own).otherwise(value)
        columns.append(value.alias(name))
    return columns


def reference_ids(nodes: Column) -> Column:
    """The ids out of an array of referenced nodes."""
    return F.transform(nodes, lambda n: n["node_id"])


def reference_column(stored: Column, mapping: str) -> Column:
    """Ids of the nodes that a property refers to: all of them, or the first for ``keyword``.

    Stored is one reference or a JSON list of them, and a reference is a node
    (``{"node_id": …}``) or its id. Entries without an id are left out, and a
    text that is neither is null.
    """
    text = F.trim(stored)
    entries = F.when(text.startswith("["), F.from_json(text, "array<string>")).when(text != "", F.array(text))

    def node(entry: Column) -> Column:
        plain = F.struct(F.nullif(F.trim(entry), F.lit("")).alias("node_id"))
        return F.when(F.trim(entry).startswith("{"), F.from_json(entry, "node_id string")).otherwise(plain)

    ids = F.array_compact(reference_ids(F.transform(entries, node)))
    return ids if mapping == "keywords" else F.get(ids, F.lit(0))


def dangling_references(docs: DataFrame, fields: Sequence[str]) -> DataFrame:
    """References to nodes that are not there: (workspace, dimension, node_id, field, reference).

    Different references are counted first, so the look-up meets each once. If
    one that dangles is named by very many nodes, these are dealt out.
    """

    def listed(name: str) -> Column:
        value = F.col(name)
        ids = value if isinstance(docs.schema[name].dataType, T.ArrayType) else F.array(value)
        ids = F.coalesce(F.array_compact(ids), F.array().cast("array<string>"))
        return F.transform(ids, lambda i: F.struct(F.lit(name).alias("field"), i.alias("reference")))

    refs = docs.select(*KEYS, F.inline(F.concat(*[listed(name) for name in fields])))
    keys = ["workspace", "dimension", "reference"]
    there = docs.select("workspace", "dimension", F.col("node_id").alias("reference")).distinct()
    counts = refs.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    missing = materialise(counts.join(there, keys, "left_anti"), "dangling")
    found = join_unique(refs, missing.drop("n"), keys, hot_keys(missing, keys), spread=["node_id"])
    return found.select(*KEYS, "field", "reference")


def project(
    nodes: DataFrame,
    resolved: DataFrame,
    types: NodeTypes,
    settings: Mapping[str, bool] | None = None,
    doc_id: IdGenerator = address_id,
) -> DataFrame:
    """Search documents, without full text, of all indexable reachable nodes.

    ``nodes`` and ``resolved`` meet on the key a node is stored under. A node
    that also stands in for missing variants fans out here, in the one join
    that its properties go through.
    """
    spark = nodes.sparkSession
    kept = nodes.where(indexable(F.col("type"), settings))
    tree = resolved.where(~F.col("removed")).select(*KEYS, "origin", "path", "disabled")
    stored = kept.withColumnRenamed("dimension", "origin")
    joined = stored.join(tree, ["workspace", "origin", "node_id"]).join(
        F.broadcast(types.frame(spark).select("type", "type_closure")), "type", "left"
    )
    return joined.select(
        doc_id(F.col("node_id"), F.col("workspace"), F.col("dimension")).alias("doc_id"),
        *KEYS,
        "path",
        ancestors(F.col("path")).alias("ancestor_paths"),
        "type",
        "type_closure",
        F.col("disabled").alias("hidden"),
        F.coalesce(F.col("hidden_in_menu"), F.lit(False)).alias("hidden_in_menu"),
        "created",
        "last_modified",
        F.col("original_last_modified").alias("last_published"),
        *property_columns(types, settings=settings),
    )


def rename_fields(docs: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Names at the boundary, for readers that expect others."""
    return docs.withColumnsRenamed(dict(names))
