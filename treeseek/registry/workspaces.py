"""Queries on workspaces that hold changes only."""

from __future__ import annotations

from pyspark.sql import functions as F

from treeseek.plans.build import BuildConfig, build
from treeseek.plans.search import Search, SearchIndex
from treeseek.registry import query
from treeseek.registry.building import CONVERSATION_TYPES, conversation_nodes

# A workspace with changes only: long questions are edited, system turns removed, and answers that ask back moved to
# new pages.
_LONG = 100
_DRAFT_SQL = f"""
turns AS (
  SELECT conv_id, turn, role, text,
         role = 'system' AS gone, role = 'user' AND length(text) > {_LONG} AS edited,
         role = 'assistant' AND text LIKE '%?%' AS moved
  FROM conversations),
shown AS (
  SELECT CASE WHEN moved THEN 'd' ELSE 'c' END || conv_id AS node_id, turn,
         CASE role WHEN 'user' THEN 'h2' ELSE 'text' END AS bucket,
         trim(CASE WHEN edited THEN 'Edited. ' || text ELSE text END) AS text
  FROM turns WHERE NOT gone),
texts AS (
  SELECT node_id, string_agg(text, ' ' ORDER BY turn) FILTER (bucket = 'h2') AS h2,
         string_agg(text, ' ' ORDER BY turn) FILTER (bucket = 'text') AS body
  FROM shown WHERE text <> '' GROUP BY node_id),
pages AS (
  SELECT 'c' || conv_id AS node_id, CASE WHEN bool_or(gone OR edited OR moved) THEN 'user' ELSE 'live' END AS workspace
  FROM turns GROUP BY conv_id
  UNION ALL SELECT DISTINCT 'd' || conv_id, 'user' FROM turns WHERE moved)"""


def _draft_nodes(spark, sf_dir):
    turns = conversation_nodes(spark, sf_dir)
    text = F.col("properties")["text"]
    edited = (F.col("type") == "user") & (F.length(text) > _LONG)
    moved = (F.col("type") == "assistant") & text.contains("?")
    gone = F.col("type") == "system"
    page = F.concat(F.lit("d"), F.substring("parent_id", 2, 20))
    changed = turns.where(edited | moved | gone).withColumns(
        {
            "workspace": F.lit("user"),
            "tags": F.when(gone, F.array(F.lit("removed"))).otherwise(F.col("tags")),
            "parent_id": F.when(moved, page).otherwise(F.col("parent_id")),
            "properties": F.when(edited, F.create_map(F.lit("text"), F.concat(F.lit("Edited. "), text))).otherwise(
                F.col("properties")
            ),
        }
    )
    new = changed.where(moved).select("parent_id", "dimension").distinct().select(
        F.col("parent_id").alias("node_id"), F.lit(None).cast("string").alias("parent_id"),
        F.lit("user").alias("workspace"), "dimension", F.lit("Page").alias("type"),
        F.array().cast("array<string>").alias("tags"), F.lit(0).cast("bigint").alias("sort_index"),
        F.create_map().cast("map<string,string>").alias("properties"),
    )
    nodes = turns.unionByName(changed).unionByName(new)
    stamps = {c: F.lit(None).cast("timestamp") for c in ("created", "last_modified", "original_last_modified")}
    return nodes.withColumns(stamps | {"hidden_in_menu": F.lit(False)})


@query(
    "sparse_workspace",
    f"""WITH {_DRAFT_SQL}
    SELECT p.node_id, p.workspace, t.h2, t.body FROM pages p LEFT JOIN texts t USING (node_id)""",
)
def sparse_workspace(spark, sf_dir):
    """Nodes of two workspaces, built and seen from the one that holds changes only."""
    chain = {"user": "live", "live": None}
    built = build(_draft_nodes(spark, sf_dir), BuildConfig(CONVERSATION_TYPES, workspaces=chain))
    seen = Search(SearchIndex(built.docs, workspaces=chain)).in_workspace("user").node_type("Page").matching()
    return seen.select("node_id", "workspace", F.col("fulltext.h2").alias("h2"), F.col("fulltext.text").alias("body"))
