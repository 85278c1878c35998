"""The given tables seen as nodes, documents and parts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from treeseek.functions.analysis import AnalyzerSet
from treeseek.model import FIELD_BOOSTS, LIVE, NO_DIMENSION
from treeseek.operators import text_index
from treeseek.operators.hierarchy import Resolved, resolve
from treeseek.operators.text_index import TextIndex
from treeseek.plans.search import SearchIndex
from treeseek.session import scratch_path, spread

_indexes: dict[tuple[str, str], TextIndex] = {}
_trees: dict[tuple[str, str], Resolved] = {}


def forget() -> None:
    """Build indexes and trees anew the next time they are asked for."""
    _indexes.clear()
    _trees.clear()


# The same views for the SQL side.
TOKENS_SQL = r"""
docs AS (
  SELECT doc_id, lang AS dimension,
         list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda t: t <> '') AS tokens
  FROM documents),
lengths AS (SELECT doc_id, dimension, len(tokens) AS dl FROM docs WHERE len(tokens) > 0),
places AS (
  SELECT doc_id, dimension, unnest(tokens) AS term, unnest(range(len(tokens))) AS pos FROM docs),
postings AS (
  SELECT doc_id, dimension, term, count(*) AS tf FROM places GROUP BY ALL),
field_stats AS (SELECT dimension, count(*) AS n, avg(dl) AS avg_dl FROM lengths GROUP BY ALL),
term_stats AS (SELECT dimension, term, count(*) AS df FROM postings GROUP BY ALL),
bm25 AS (
  SELECT p.doc_id, p.dimension, p.term,
         ln(1 + (f.n - t.df + 0.5) / (t.df + 0.5))
           * p.tf * 2.2 / (p.tf + 1.2 * (0.25 + 0.75 * l.dl / f.avg_dl)) AS part
  FROM postings p
  JOIN lengths l USING (doc_id, dimension)
  JOIN field_stats f USING (dimension)
  JOIN term_stats t USING (dimension, term))"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str, hidden: bool = False) -> DataFrame:
    """Texts as search documents: the language is the dimension, the source the folder."""
    docs = table(spark, sf_dir, "documents")
    node_id = F.col("doc_id").cast("string")
    columns = [
        "doc_id",
        node_id.alias("node_id"),
        F.lit(LIVE).alias("workspace"),
        F.col("lang").alias("dimension"),
        F.concat_ws("/", "lang", "source", node_id).alias("path"),
        F.concat(F.col("source"), F.lit(":"), F.col("lang")).alias("type"),
        "source",
        "n_chars",
        F.struct(F.col("text").alias("text")).alias("fulltext"),
    ]
    if not hidden:
        return docs.select(*columns)
    labels = table(spark, sf_dir, "labels").select("doc_id", (F.col("toxic") == 1).alias("hidden"), "quality")
    return docs.join(labels, "doc_id", "left").select(*columns, "hidden", "quality")


def document_index(spark: SparkSession, sf_dir: str) -> TextIndex:
    """The text index of the documents, built once per session and kept in the shared folder."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _indexes:
        lazy = text_index.build(
            text_index.dealt(documents(spark, sf_dir), F.col("fulltext.text")), {"text": F.col("fulltext.text")}
        )
        _indexes[key] = text_index.save(lazy, scratch_path(spark, "document-index"))
    return _indexes[key]


def page_index(spark: SparkSession, sf_dir: str) -> TextIndex:
    """The text index of the HTML pages with their buckets, kept likewise."""
    from treeseek.registry.building import page_documents

    key = (spark.sparkContext.applicationId, f"{sf_dir}/pages")
    if key not in _indexes:
        lazy = text_index.build(
            page_documents(spark, sf_dir), {b: F.col(f"fulltext.{b}") for b in FIELD_BOOSTS}
        )
        _indexes[key] = text_index.save(lazy, scratch_path(spark, "page-index"))
    return _indexes[key]


def document_search(spark: SparkSession, sf_dir: str, hidden: bool = False) -> SearchIndex:
    return SearchIndex(
        documents(spark, sf_dir, hidden), document_index(spark, sf_dir), boosts={"text": FIELD_BOOSTS["text"]}
    )


def lazy_index(spark: SparkSession, sf_dir: str) -> TextIndex:
    return text_index.build(spread(documents(spark, sf_dir)), {"text": F.col("fulltext.text")}, AnalyzerSet())


TREE_SQL = """
nodes AS (
  SELECT 'r' || r_regionkey AS node_id, NULL AS parent_id, 'Region' AS type,
         CAST(r_regionkey AS BIGINT) AS sort_index, FALSE AS own_disabled, FALSE AS own_removed, FALSE AS own_root
  FROM region
  UNION ALL
  SELECT 'n' || n_nationkey, 'r' || n_regionkey, 'Nation', CAST(n_nationkey AS BIGINT), FALSE, FALSE, TRUE
  FROM nation
  UNION ALL
  SELECT 'c' || c_custkey, 'n' || c_nationkey, c_mktsegment, c_custkey, c_acctbal < 0, c_acctbal > 9500,
         c_mktsegment = 'BUILDING'
  FROM customer
  UNION ALL
  SELECT 'o' || o_orderkey, 'c' || o_custkey, 'Order', o_orderkey, FALSE, FALSE, FALSE FROM orders),
tree AS (
  SELECT node_id, type, node_id AS path, 0 AS depth, own_disabled AS disabled, own_removed AS removed,
         CASE WHEN own_root THEN node_id END AS closest_root
  FROM nodes WHERE parent_id IS NULL
  UNION ALL
  SELECT n.node_id, n.type, t.path || '/' || n.node_id, t.depth + 1, t.disabled OR n.own_disabled,
         t.removed OR n.own_removed, CASE WHEN n.own_root THEN n.node_id ELSE t.closest_root END
  FROM nodes n JOIN tree t ON n.parent_id = t.node_id)"""


def tree_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """region → nation → customer → orders as one tree.

    Customers in debt are disabled, the richest are removed; nations and
    customers of one segment are full-text roots.
    """
    no_tags = F.array().cast("array<string>")

    def nodes(df, node_id, parent_id, kind, position, tags=no_tags, root=F.lit(False)):
        return df.select(
            node_id.alias("node_id"),
            parent_id.cast("string").alias("parent_id"),
            F.lit(LIVE).alias("workspace"),
            F.lit(NO_DIMENSION).alias("dimension"),
            kind.alias("type"),
            tags.alias("tags"),
            position.cast("bigint").alias("sort_index"),
            root.alias("fulltext_root"),
        )

    def named(prefix, column):
        return F.concat(F.lit(prefix), F.col(column).cast("string"))

    balance = F.col("c_acctbal")
    tags = F.filter(
        F.array(F.when(balance < 0, "disabled"), F.when(balance > 9500, "removed")), lambda t: t.isNotNull()
    )
    return (
        nodes(table(spark, sf_dir, "region"), named("r", "r_regionkey"), F.lit(None), F.lit("Region"), F.col("r_regionkey"))
        .unionByName(
            nodes(
                table(spark, sf_dir, "nation"), named("n", "n_nationkey"), named("r", "n_regionkey"), F.lit("Nation"),
                F.col("n_nationkey"), root=F.lit(True),
            )
        )
        .unionByName(
            nodes(
                table(spark, sf_dir, "customer"), named("c", "c_custkey"), named("n", "c_nationkey"),
                F.col("c_mktsegment"), F.col("c_custkey"), tags, F.col("c_mktsegment") == "BUILDING",
            )
        )
        .unionByName(
            nodes(
                table(spark, sf_dir, "orders"), named("o", "o_orderkey"), named("c", "o_custkey"), F.lit("Order"),
                F.col("o_orderkey"),
            )
        )
    )


def tree(spark: SparkSession, sf_dir: str) -> Resolved:
    """The resolved tree, worked out once per session."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _trees:
        _trees[key] = resolve(tree_nodes(spark, sf_dir))
    return _trees[key]


# Supertypes of the customer segments and the other node kinds.
SUPERTYPES = {
    "BUILDING": "Business", "MACHINERY": "Business", "AUTOMOBILE": "Private", "FURNITURE": "Private",
    "HOUSEHOLD": "Private", "Business": "Party", "Private": "Party", "Party": "Node", "Order": "Node",
    "Nation": "Place", "Region": "Place", "Place": "Node",
}

SUPERTYPES_SQL = (
    "super(type, supertype) AS (VALUES "
    + ", ".join(f"('{t}', '{s}')" for t, s in SUPERTYPES.items())
    + """),
closure AS (
  SELECT DISTINCT type, type AS ancestor FROM super
  UNION ALL
  SELECT c.type, s.supertype FROM closure c JOIN super s ON c.ancestor = s.type)"""
)


def supertype_edges(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(SUPERTYPES.items()), "type string, supertype string")
