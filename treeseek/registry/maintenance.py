"""Publishing and incremental upkeep."""

from __future__ import annotations

from pyspark.sql import functions as F

from treeseek.operators import hierarchy, rollup, validity
from treeseek.plans.publish import index_names_with_postfix, stale
from treeseek.plans.search import Search, SearchIndex
from treeseek.registry import query
from treeseek.registry.building import _PARTS_SQL, conversation_parts
from treeseek.registry.data import TREE_SQL, documents, table, tree, tree_nodes
from treeseek.session import materialise, scratch_path
from treeseek.sources import nodes as node_source
from treeseek.streaming.changes import INDEX, REMOVE, ChangeLog, latest, merge, prepare, read_changes, refresh_fulltext


def _names(spark, sf_dir):
    """One index name per language, source and label state."""
    return documents(spark, sf_dir).select(
        F.concat_ws("-", F.lit("idx"), "dimension", "source").alias("index_name"), "source"
    ).distinct()


@query(
    "stale_versions",
    """SELECT DISTINCT 'idx-' || lang || '-' || source AS index_name FROM documents WHERE source <> 'src7'""",
)
def stale_versions(spark, sf_dir):
    names = _names(spark, sf_dir)
    return stale(names, names.where("source = 'src7'")).select("index_name")


@query(
    "names_by_postfix",
    """SELECT DISTINCT 'idx-' || lang || '-' || source AS index_name FROM documents WHERE source = 'src1'""",
)
def names_by_postfix(spark, sf_dir):
    return index_names_with_postfix(_names(spark, sf_dir), "src1").select("index_name")


@query(
    "dead_letter",
    """WITH judged AS (
      SELECT event_id, props, CASE WHEN value > 100 THEN 'value too large'
        WHEN event_type = 'error' THEN 'not an index event' END AS reason FROM events)
    SELECT left(sha1('run|' || event_id || '|' || reason), 12) AS reference, CAST(event_id AS VARCHAR) AS doc_id,
      reason, props AS payload FROM judged WHERE reason IS NOT NULL""",
)
def dead_letter(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumn("doc_id", F.col("event_id"))
    checks = {
        "broken JSON": validity.valid_json(F.col("props")),
        "value too large": F.col("value") <= 100,
        "not an index event": F.col("event_type") != "error",
    }
    _, bad = validity.split(events, checks, "run", F.col("props"))
    return bad.select("reference", "doc_id", "reason", "payload")


@query(
    "valid_items",
    """SELECT event_id FROM events WHERE value <= 100 AND event_type <> 'error' AND json_valid(props)""",
)
def valid_items(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumn("doc_id", F.col("event_id"))
    checks = {
        "broken JSON": validity.valid_json(F.col("props")),
        "value too large": F.col("value") <= 100,
        "not an index event": F.col("event_type") != "error",
    }
    good, _ = validity.split(events, checks, "run")
    return good.select("event_id")


_STATE_SQL = """
last AS (
  SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1)"""


def _changes(events):
    """The event stream as changes: an error removes the user's document."""
    return events.select(
        F.col("user_id").alias("doc_id"), F.col("event_id").alias("seq"),
        F.when(F.col("event_type") == "error", REMOVE).otherwise(INDEX).alias("op"), "event_type", "value",
    )


@query(
    "latest_change",
    f"""WITH {_STATE_SQL} SELECT user_id AS doc_id, event_id AS seq, event_type, value FROM last""",
)
def latest_change(spark, sf_dir):
    return latest(_changes(table(spark, sf_dir, "events")), ["doc_id"]).select("doc_id", "seq", "event_type", "value")


@query(
    "upsert_latest",
    f"""WITH {_STATE_SQL}
    SELECT user_id AS doc_id, event_type, value FROM last WHERE event_type <> 'error'
    UNION ALL
    SELECT doc_id, 'base', CAST(n_chars AS DOUBLE) FROM documents WHERE doc_id NOT IN (SELECT user_id FROM events)""",
)
def upsert_latest(spark, sf_dir):
    """A base table with all changes merged in."""
    base = documents(spark, sf_dir).select(
        "doc_id", F.lit("base").alias("event_type"), F.col("n_chars").cast("double").alias("value")
    )
    return merge(base, _changes(table(spark, sf_dir, "events")), ["doc_id"])


@query(
    "stream_upsert",
    f"""WITH {_STATE_SQL} SELECT user_id AS doc_id, event_type, value FROM last WHERE event_type <> 'error'""",
)
def stream_upsert(spark, sf_dir):
    """The event table read as a stream, logged in batches, and the state that results."""
    schema = table(spark, sf_dir, "events").schema
    stream = _changes(read_changes(spark, sf_dir, schema, pattern="events.parquet"))
    log = ChangeLog(spark, scratch_path(spark, "change-log"), stream.schema)
    log.start(stream, scratch_path(spark, "change-checkpoint")).awaitTermination()
    empty = spark.createDataFrame([], stream.drop("seq", "op").schema)
    return merge(empty, log.read(), ["doc_id"])


@query(
    "publish_to_target",
    f"""WITH t AS (SELECT event_id, user_id, event_type, value, CASE WHEN event_type = 'purchase' THEN 'live' ELSE 'draft' END
      AS workspace FROM events)
    SELECT user_id AS doc_id, workspace, value FROM t WHERE workspace = 'live'
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1""",
)
def publish_to_target(spark, sf_dir):
    """Only changes that end up live count when drafts are not indexed."""
    drafts = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("doc_id"), F.col("event_id").alias("seq"), F.lit("draft").alias("workspace"),
        F.when(F.col("event_type") == "purchase", "live").alias("target_workspace"), "value",
    )
    return latest(prepare(drafts, index_all_workspaces=False), ["doc_id"]).select("doc_id", "workspace", "value")


@query(
    "incremental_rollup",
    f"""WITH {_PARTS_SQL},
    touched AS (SELECT DISTINCT root_id FROM parts WHERE bucket = 'h2' AND length(text) > 200),
    changed AS (
      SELECT root_id, turn, bucket, CASE WHEN bucket = 'h2' AND length(text) > 200 THEN 'Edited. ' || text ELSE text END
        AS text
      FROM parts WHERE NOT (bucket = 'text' AND length(text) > 400)),
    again AS (SELECT DISTINCT root_id FROM parts WHERE (bucket = 'text' AND length(text) > 400)
      OR (bucket = 'h2' AND length(text) > 200))
    SELECT a.root_id, max(CASE WHEN bucket = 'h2' THEN t END) AS h2, max(CASE WHEN bucket = 'text' THEN t END) AS text
    FROM again a LEFT JOIN (SELECT root_id, bucket, string_agg(text, ' ' ORDER BY turn) AS t FROM changed GROUP BY ALL) p
      USING (root_id)
    GROUP BY a.root_id""",
)
def incremental_rollup(spark, sf_dir):
    """Long questions are edited, long answers removed; only their pages are joined anew."""
    parts = materialise(conversation_parts(spark, sf_dir), "parts")
    edited = parts.where((F.col("bucket") == "h2") & (F.length("text") > 200))
    removed = parts.where((F.col("bucket") == "text") & (F.length("text") > 400))
    changed = edited.unionByName(removed).select("workspace", "dimension", F.col("part_node_id").alias("node_id"))
    new_parts = edited.withColumn("text", F.concat(F.lit("Edited. "), F.col("text")))
    _, pages = refresh_fulltext(parts, changed, new_parts)
    return pages.select("root_id", "fulltext.h2", "fulltext.text")


@query(
    "replaced_parts",
    f"""WITH {_PARTS_SQL}
    SELECT part_node_id, CASE WHEN bucket = 'h2' THEN upper(bucket) ELSE text END AS text
    FROM parts WHERE bucket <> 'text'""",
)
def replaced_parts(spark, sf_dir):
    """User parts are put anew, assistant parts are removed."""
    parts = conversation_parts(spark, sf_dir)
    changed = parts.where(F.col("bucket").isin("h2", "text"))
    new_parts = parts.where(F.col("bucket") == "h2").withColumn("text", F.upper("bucket"))
    nodes = changed.select("workspace", "dimension", F.col("part_node_id").alias("node_id"))
    return rollup.replace_parts(parts, nodes, new_parts).select("part_node_id", "text")


@query(
    "moved_subtree",
    f"""WITH RECURSIVE {TREE_SQL}
    SELECT node_id, 'r3/' || substr(path, 4) AS path FROM tree
    WHERE path = 'r0/n0' OR starts_with(path, 'r0/n0/')""",
)
def moved_subtree(spark, sf_dir):
    """A nation moves to another region; only its subtree gets new paths."""
    before = tree(spark, sf_dir).nodes
    below = before.where(F.col("path").startswith("r0/n0/") | (F.col("path") == "r0/n0")).select("node_id")
    nodes = tree_nodes(spark, sf_dir).join(below, "node_id", "left_semi")
    moved = nodes.withColumn(
        "parent_id", F.when(F.col("node_id") == "n0", F.lit("r3")).otherwise(F.col("parent_id"))
    )
    target = before.where(F.col("path") == "r3")
    return hierarchy.resolve(moved, above=target).nodes.select("node_id", "path")


@query(
    "single_node_status",
    """WITH t AS (SELECT DISTINCT 'live' AS workspace, lang AS dimension FROM documents)
    SELECT t.workspace, t.dimension, '3' AS node_id,
      CASE WHEN t.dimension IN (SELECT lang FROM documents WHERE doc_id = 3) THEN 'indexed' ELSE 'not found' END AS status
    FROM t""",
)
def single_node_status(spark, sf_dir):
    nodes = documents(spark, sf_dir)
    return node_source.index_status(nodes, nodes, ["3"])


@query(
    "view_node",
    """SELECT doc_id, 'live' AS workspace, lang AS dimension, text AS value FROM documents WHERE doc_id = 3""",
)
def view_node(spark, sf_dir):
    from treeseek.plans.reports import view_node as view

    return view(documents(spark, sf_dir), "3", "fulltext.text")


@query(
    "hit_path",
    """SELECT n_chars AS value FROM documents WHERE doc_id = 3""",
)
def hit_path(spark, sf_dir):
    """The sort value of one hit, by path."""
    found = Search(SearchIndex(documents(spark, sf_dir))).sort_asc("n_chars").limit(None, all=True)
    return found.execute().hit_for_node("3", "sort_values.s0")
