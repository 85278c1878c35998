"""The node tree: paths, subtrees, inherited flags, types, dimensions, workspaces."""

from __future__ import annotations

from pyspark.sql import functions as F

from treeseek.functions.paths import ancestors, prefixes, subtree
from treeseek.model import LIVE
from treeseek.operators import hierarchy, overlay, projection
from treeseek.operators.dimensions import fallback_pairs, specialise
from treeseek.plans.search import Search, SearchIndex
from treeseek.registry import query
from treeseek.registry.data import (
    SUPERTYPES_SQL,
    TREE_SQL,
    documents,
    supertype_edges,
    table,
    tree,
    tree_nodes,
)
from treeseek.sources import nodes as node_source


@query(
    "tree_paths",
    f"""WITH RECURSIVE {TREE_SQL}
    SELECT node_id, path, CAST(depth AS BIGINT) AS depth, disabled, removed, closest_root FROM tree""",
)
def tree_paths(spark, sf_dir):
    return tree(spark, sf_dir).nodes.select(
        "node_id", "path", F.col("depth").cast("bigint"), "disabled", "removed", "closest_root"
    )


@query(
    "subtree_filter",
    f"""WITH RECURSIVE {TREE_SQL}
    SELECT node_id, path FROM tree WHERE (path = 'r1/n5' OR starts_with(path, 'r1/n5/') OR starts_with(path, 'r2/'))
      AND NOT removed""",
)
def subtree_filter(spark, sf_dir):
    nodes = node_source.without_removed(tree(spark, sf_dir).nodes)
    below = subtree(F.col("path"), "r1/n5") | F.col("path").startswith("r2/")
    return nodes.where(below).select("node_id", "path")


@query(
    "ancestor_paths",
    f"""WITH RECURSIVE {TREE_SQL},
    split AS (SELECT node_id, string_split(path, '/') AS ids FROM tree)
    SELECT node_id, array_to_string(list_transform(range(1, len(ids)), lambda n: array_to_string(ids[1:n], '/')), '|')
      AS ancestor_paths
    FROM split""",
)
def ancestor_paths(spark, sf_dir):
    return tree(spark, sf_dir).nodes.select(
        "node_id", F.array_join(ancestors(F.col("path")), "|").alias("ancestor_paths")
    )


@query(
    "url_prefixes",
    """WITH split AS (SELECT page_id, string_split(url, '/') AS ids FROM pages)
    SELECT page_id, array_to_string(list_transform(range(1, len(ids) + 1), lambda n: array_to_string(ids[1:n], '/')), '|')
      AS prefixes
    FROM split""",
)
def url_prefixes(spark, sf_dir):
    return table(spark, sf_dir, "pages").select(
        "page_id", F.array_join(prefixes(F.col("url")), "|").alias("prefixes")
    )


@query(
    "below_hidden",
    f"""WITH RECURSIVE {TREE_SQL},
    marked AS (SELECT path FROM tree JOIN nodes USING (node_id) WHERE own_disabled)
    SELECT DISTINCT t.node_id, t.path FROM tree t JOIN marked m ON t.path = m.path OR starts_with(t.path, m.path || '/')""",
)
def below_hidden(spark, sf_dir):
    """Nodes at or below a marked one, from paths alone."""
    flat = tree(spark, sf_dir).nodes.select("node_id", "path")
    own = tree_nodes(spark, sf_dir).where(F.array_contains("tags", "disabled")).select("node_id")
    return hierarchy.below_marked(flat, flat.join(own, "node_id", "left_semi"))


@query(
    "closest_root",
    f"""WITH RECURSIVE {TREE_SQL}
    SELECT node_id, closest_root AS root_id FROM tree WHERE closest_root IS NOT NULL""",
)
def closest_root(spark, sf_dir):
    pairs, _ = hierarchy.closest_roots(tree(spark, sf_dir).nodes)
    return pairs.select("node_id", "root_id")


@query(
    "unreachable_nodes",
    f"""WITH RECURSIVE {TREE_SQL}
    SELECT node_id FROM nodes WHERE node_id NOT IN (SELECT node_id FROM tree)""",
)
def unreachable_nodes(spark, sf_dir):
    return tree(spark, sf_dir).unreachable.select("node_id")


@query(
    "limit_per_index",
    """WITH d AS (SELECT doc_id, lang AS dimension, lang || '/' || source || '/' || doc_id AS path FROM documents)
    SELECT doc_id, dimension, path FROM d
    QUALIFY row_number() OVER (PARTITION BY dimension ORDER BY path) <= 20""",
)
def limit_per_index(spark, sf_dir):
    found = node_source.limit_per_index(documents(spark, sf_dir), 20)
    return found.select("doc_id", "dimension", "path")


@query(
    "limit_large_index",
    """WITH d AS (SELECT event_id, CASE WHEN event_id % 8 = 0 THEN 'side' ELSE 'main' END AS dimension,
      'events/' || user_id || '/' || event_id AS path FROM events)
    SELECT event_id, dimension FROM d QUALIFY row_number() OVER (PARTITION BY dimension ORDER BY path) <= 4000""",
)
def limit_large_index(spark, sf_dir):
    """More nodes per index than a ranked window should hold; one index has most of them."""
    nodes = table(spark, sf_dir, "events").select(
        "event_id", F.lit("live").alias("workspace"), F.col("event_id").cast("string").alias("node_id"),
        F.when(F.col("event_id") % 8 == 0, "side").otherwise("main").alias("dimension"),
        F.concat_ws("/", F.lit("events"), F.col("user_id").cast("string"), F.col("event_id").cast("string")).alias("path"),
    )
    return node_source.limit_per_index(nodes, 4000).select("event_id", "dimension")


@query(
    "type_closure",
    f"""WITH RECURSIVE {SUPERTYPES_SQL}
    SELECT c.c_custkey, string_agg(t.ancestor, ',' ORDER BY t.ancestor) AS type_closure
    FROM customer c JOIN closure t ON t.type = c.c_mktsegment GROUP BY c.c_custkey""",
)
def type_closure(spark, sf_dir):
    nodes = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_mktsegment").alias("type"))
    typed = projection.with_type_closure(nodes, hierarchy.closure_of(supertype_edges(spark)))
    return typed.select("c_custkey", F.array_join("type_closure", ",").alias("type_closure"))


@query(
    "type_filter",
    f"""WITH RECURSIVE {SUPERTYPES_SQL}
    SELECT c_custkey, c_name FROM customer
    WHERE c_mktsegment IN (SELECT type FROM closure WHERE ancestor = 'Private')""",
)
def type_filter(spark, sf_dir):
    nodes = table(spark, sf_dir, "customer").withColumnRenamed("c_mktsegment", "type")
    typed = projection.with_type_closure(nodes, hierarchy.closure_of(supertype_edges(spark)))
    docs = typed.withColumn("doc_id", F.col("c_custkey"))
    return Search(SearchIndex(docs)).node_type("Private").matching().select("c_custkey", "c_name")


_VARIANTS = {"es": "en", "fr": "en", "de": "fr"}


@query(
    "specialise_dimensions",
    """WITH pairs(general, special, distance) AS (VALUES
      ('en', 'es', 1), ('en', 'fr', 1), ('fr', 'de', 1), ('en', 'de', 2)),
    nodes AS (
      SELECT source || '-' || length(text) AS node_id, lang AS dimension, min(doc_id) AS doc_id
      FROM documents GROUP BY ALL),
    reached AS (
      SELECT node_id, dimension, dimension AS origin, doc_id, 0 AS distance FROM nodes
      UNION ALL
      SELECT node_id, special, general, doc_id, distance FROM nodes JOIN pairs ON dimension = general)
    SELECT node_id, dimension, origin, doc_id FROM reached
    QUALIFY row_number() OVER (PARTITION BY node_id, dimension ORDER BY distance) = 1""",
)
def specialise_dimensions(spark, sf_dir):
    """Fallback es → en, fr → en, de → fr; texts of one source and length count as variants."""
    nodes = (
        table(spark, sf_dir, "documents")
        .groupBy(
            F.concat_ws("-", "source", F.length("text").cast("string")).alias("node_id"),
            F.col("lang").alias("dimension"),
        )
        .agg(F.min("doc_id").alias("doc_id"))
        .withColumn("workspace", F.lit(LIVE))
    )
    variation = spark.createDataFrame(
        fallback_pairs(_VARIANTS), "general string, special string, distance int"
    )
    return specialise(nodes, variation).select("node_id", "dimension", "origin", "doc_id")


# A user's workspace out of the labels: good texts are edited there, toxic ones deleted.
_OVERLAY_SQL = """
layers AS (
  SELECT doc_id, 'live' AS workspace, text, FALSE AS deleted FROM documents
  UNION ALL
  SELECT doc_id, 'user', 'Edited. ' || text, toxic = 1 FROM documents JOIN labels USING (doc_id)
  WHERE quality = 1 OR toxic = 1)"""


def _layers(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", F.col("doc_id").cast("string").alias("node_id"), F.lit(LIVE).alias("workspace"),
        F.lit("default").alias("dimension"), "text", F.lit(False).alias("deleted"),
    )
    labels = table(spark, sf_dir, "labels").where((F.col("quality") == 1) | (F.col("toxic") == 1))
    edited = docs.drop("workspace", "deleted", "text").join(
        table(spark, sf_dir, "documents").select("doc_id", "text").join(labels, "doc_id"), "doc_id"
    )
    user = edited.select(
        "doc_id", "node_id", F.lit("user").alias("workspace"), "dimension",
        F.concat(F.lit("Edited. "), F.col("text")).alias("text"), (F.col("toxic") == 1).alias("deleted"),
    )
    return docs.unionByName(user)


@query(
    "workspace_overlay",
    f"""WITH {_OVERLAY_SQL}
    SELECT doc_id, workspace, length(text) AS n FROM layers
    WHERE NOT deleted AND (workspace = 'user' OR doc_id NOT IN (SELECT doc_id FROM layers WHERE workspace = 'user'))
      AND length(text) > 500""",
)
def workspace_overlay(spark, sf_dir):
    index = SearchIndex(_layers(spark, sf_dir), workspaces={"user": "live", "live": None})
    seen = Search(index).in_workspace("user").where(F.length("text") > 500).matching()
    return seen.select("doc_id", "workspace", F.length("text").cast("bigint").alias("n"))


@query(
    "first_hit_per_node",
    f"""WITH {_OVERLAY_SQL}
    SELECT doc_id, workspace, length(text) AS n FROM layers WHERE length(text) > 500
    QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY CASE workspace WHEN 'user' THEN 1 ELSE 2 END) = 1""",
)
def first_hit_per_node(spark, sf_dir):
    index = SearchIndex(_layers(spark, sf_dir), workspaces={"user": "live", "live": None})
    seen = Search(index).in_workspace("user", "first_hit").where(F.length("text") > 500).matching()
    return seen.select("doc_id", "workspace", F.length("text").cast("bigint").alias("n"))


@query(
    "stale_hits",
    """SELECT doc_id, doc_id IN (SELECT doc_id FROM labels) AS live FROM documents""",
)
def stale_hits(spark, sf_dir):
    """Hits with a node behind them, and those without, told apart."""
    hits = documents(spark, sf_dir).select("doc_id")
    live, stale = overlay.live_hits(hits, table(spark, sf_dir, "labels"), ["doc_id"])
    return live.withColumn("live", F.lit(True)).unionByName(stale.withColumn("live", F.lit(False)))
