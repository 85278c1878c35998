"""Queries on what is shipped: published versions kept up to date, and searches over several dimensions."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from treeseek.functions.analysis import Analyzer, AnalyzerSet
from treeseek.model import LIVE, NO_DIMENSION
from treeseek.operators import text_index
from treeseek.plans.build import BuildConfig, build
from treeseek.plans.publish import IndexStore
from treeseek.plans.realtime import follow
from treeseek.plans.search import Search, SearchIndex
from treeseek.registry import query
from treeseek.registry.building import CONVERSATION_TYPES, conversation_nodes
from treeseek.registry.data import TOKENS_SQL, documents, table
from treeseek.session import materialise, scratch_path, spread
from treeseek.streaming.changes import INDEX, REMOVE


@query(
    "live_upkeep",
    """WITH parts AS (
      SELECT 'c' || conv_id AS node_id, turn, CASE role WHEN 'system' THEN 'h1' ELSE 'text' END AS bucket,
             trim(text) AS text
      FROM conversations WHERE trim(text) <> '' AND role <> 'user')
    SELECT 'c' || c.conv_id AS node_id,
           string_agg(p.text, ' ' ORDER BY p.turn) FILTER (WHERE bucket = 'h1') AS h1,
           string_agg(p.text, ' ' ORDER BY p.turn) FILTER (WHERE bucket = 'text') AS text
    FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN parts p ON p.node_id = 'c' || c.conv_id
    GROUP BY c.conv_id""",
)
def live_upkeep(spark, sf_dir):
    """An index is built, published, and follows a stream of changes that takes out every turn of a user."""
    no_time = F.lit(None).cast("timestamp")
    nodes = conversation_nodes(spark, sf_dir).withColumns(
        {"created": no_time, "last_modified": no_time, "original_last_modified": no_time,
         "hidden_in_menu": F.lit(False)}
    )
    config = BuildConfig(CONVERSATION_TYPES)
    store = IndexStore(spark, f"talks_{uuid.uuid4().hex[:12]}")
    store.make_live(store.create(build(nodes, config)))
    removed = table(spark, sf_dir, "conversations").where("role = 'user'").select(
        (F.col("conv_id") * 1_000_000 + F.col("turn")).alias("seq"),
        F.lit(REMOVE).alias("op"),
        F.lit(LIVE).alias("workspace"),
        F.lit(NO_DIMENSION).alias("dimension"),
        F.concat(F.lit("c"), F.col("conv_id").cast("string"), F.lit("-"), F.col("turn").cast("string")).alias("node_id"),
    )
    log = scratch_path(spark, "changes")
    removed.write.parquet(log)
    now = nodes.where(F.col("type") != "user")
    stream = spark.readStream.schema(removed.schema).parquet(log)
    follow(store, stream, lambda: now, config, scratch_path(spark, "checkpoint")).awaitTermination()
    pages = store.current("docs").where("type = 'Page'")
    kept = materialise(pages.select("node_id", "fulltext.h1", "fulltext.text"), "followed")
    store.drop()
    return kept


@query(
    "live_index_events",
    """WITH shown AS (
      SELECT conv_id, turn, CASE role WHEN 'user' THEN 'h2' ELSE 'text' END AS bucket,
             trim(CASE role WHEN 'assistant' THEN 'Edited. ' || text ELSE text END) AS text
      FROM conversations WHERE role <> 'system'),
    parts AS (SELECT * FROM shown WHERE text <> '')
    SELECT 'c' || c.conv_id AS node_id,
           string_agg(p.text, ' ' ORDER BY p.turn) FILTER (WHERE bucket = 'h2') AS h2,
           string_agg(p.text, ' ' ORDER BY p.turn) FILTER (WHERE bucket = 'text') AS text
    FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN parts p USING (conv_id) GROUP BY c.conv_id""",
)
def live_index_events(spark, sf_dir):
    """An index follows three batches: answers are edited, questions come in anew, system turns go."""
    no_time = F.lit(None).cast("timestamp")
    first = conversation_nodes(spark, sf_dir).withColumns(
        {"created": no_time, "last_modified": no_time, "original_last_modified": no_time,
         "hidden_in_menu": F.lit(False)}
    )
    edited = F.create_map(F.lit("text"), F.concat(F.lit("Edited. "), F.col("properties")["text"]))
    now = first.where("type <> 'system'").withColumn(
        "properties", F.when(F.col("type") == "assistant", edited).otherwise(F.col("properties"))
    )
    config = BuildConfig(CONVERSATION_TYPES)
    store = IndexStore(spark, f"talks_{uuid.uuid4().hex[:12]}")
    store.make_live(store.create(build(first.where("type <> 'user'"), config)))
    log = scratch_path(spark, "changes")
    turns = table(spark, sf_dir, "conversations")
    for role, op in (("assistant", INDEX), ("user", INDEX), ("system", REMOVE)):
        batch = turns.where(F.col("role") == role).select(
            (F.col("conv_id") * 1_000_000 + F.col("turn")).alias("seq"),
            F.lit(op).alias("op"),
            F.lit(LIVE).alias("workspace"),
            F.lit(NO_DIMENSION).alias("dimension"),
            F.concat_ws("-", F.concat(F.lit("c"), F.col("conv_id").cast("string")), F.col("turn").cast("string")).alias("node_id"),
        )
        batch.write.mode("append").parquet(log)
        stream = spark.readStream.schema(batch.schema).parquet(log)
        follow(store, stream, lambda: now, config, f"{log}-checkpoint").awaitTermination()
    pages = store.current("docs").where("type = 'Page'")
    kept = materialise(pages.select("node_id", "fulltext.h2", "fulltext.text"), "followed")
    store.drop()
    return kept


def _twice(spark, sf_dir):
    """Every document in two dimensions, under one id."""
    docs = documents(spark, sf_dir)
    other = docs.withColumn("dimension", F.concat("dimension", F.lit("-x")))
    return docs.unionByName(other)


@query(
    "plain_id_search",
    f"""WITH {TOKENS_SQL}
    SELECT doc_id, dimension || d.x AS dimension, round(1 + sum(part), 6) AS score
    FROM bm25 CROSS JOIN (VALUES (''), ('-x')) AS d(x)
    WHERE term IN ('theron', 'tion', 'nicht') GROUP BY ALL""",
)
def plain_id_search(spark, sf_dir):
    """One id in several dimensions: each of them is a hit with a score of its own."""
    docs = _twice(spark, sf_dir)
    text = text_index.build(spread(docs), {"text": F.col("fulltext.text")})
    found = Search(SearchIndex(docs, text, boosts={"text": 1.0})).fulltext("theron tion nicht").limit(None, all=True)
    return found.matching().select("doc_id", "dimension", "score")


_FOLDED = "translate(lower(text), 'äöüéèê', 'aoueee')"


@query(
    "mixed_analysers",
    rf"""WITH w AS (
      SELECT doc_id, lang, list_filter(regexp_split_to_array(
        CASE WHEN lang IN ('de', 'fr') THEN {_FOLDED} ELSE lower(text) END, '[^\p{{L}}\p{{N}}]+'), lambda t: t <> '') AS t
      FROM documents)
    SELECT doc_id, lang AS dimension FROM w
    WHERE CASE WHEN lang IN ('de', 'fr') THEN list_contains(t, 'fur') OR list_contains(t, 'tre')
               ELSE list_contains(t, 'für') OR list_contains(t, 'tré') END""",
)
def mixed_analysers(spark, sf_dir):
    """Dimensions with folding and without in one query: each has the words of its own analyser."""
    docs = documents(spark, sf_dir)
    folding = Analyzer(fold=True)
    analyzers = AnalyzerSet(by_dimension={"de": folding, "fr": folding})
    text = text_index.build(spread(docs), {"text": F.col("fulltext.text")}, analyzers)
    found = Search(SearchIndex(docs, text, boosts={"text": 1.0})).fulltext("für tré")
    return found.matching().select("doc_id", "dimension")
