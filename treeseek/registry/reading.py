"""Queries on how content is read, listed, held back and reported."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from treeseek.model import LIVE, NodeType, NodeTypes
from treeseek.operators import hierarchy, rollup, validity
from treeseek.plans.build import BuildConfig, build
from treeseek.plans.publish import IndexStore
from treeseek.plans.reports import search_report
from treeseek.plans.search import Search
from treeseek.registry import query
from treeseek.registry.building import CONVERSATION_TYPES, conversation_nodes
from treeseek.registry.data import TOKENS_SQL, TREE_SQL, document_search, documents, table, tree_nodes
from treeseek.registry.fulltext import _HIGHLIGHT_SQL, _MISSPELT, _SUGGEST_SQL
from treeseek.session import materialise, mounted, scratch_path, spread
from treeseek.sources import assets, error_sinks, nodes
from treeseek.sources.node_types import from_table


def _stored(spark, sf_dir):
    """Documents as a node table in folders by workspace and dimension."""
    path = scratch_path(spark, "node-table")
    documents(spark, sf_dir).write.partitionBy("workspace", "dimension").parquet(path)
    return spark.read.parquet(path)


@query("scan_dimension", "SELECT doc_id, source FROM documents WHERE lang = 'de'")
def scan_dimension(spark, sf_dir):
    """Nodes of one workspace and dimension: only their folder is read."""
    return nodes.scan(_stored(spark, sf_dir), LIVE, "de").select("doc_id", "source")


@query("scan_all", "SELECT 'live' AS workspace, lang AS dimension, count(*) AS n FROM documents GROUP BY lang")
def scan_all(spark, sf_dir):
    found = nodes.scan(_stored(spark, sf_dir)).groupBy("workspace", "dimension").agg(F.count("*").alias("n"))
    return found.select("workspace", "dimension", "n")


# Files that a task writes one after the other, and that it reads: each costs a round trip to the file system, however
# small. Spark deals them out by size, so the first tasks have the long ones, which take longest to take apart.
FILES_A_TASK = 8000
FILES_READ_A_TASK = 500


def _page_files(spark, sf_dir):
    """Each page as a file, which ends with a line feed as the text sink puts it there."""
    path = scratch_path(spark, "page-files")
    pages = spread(table(spark, sf_dir, "pages").select("page_id", F.coalesce("html", F.lit("")).alias("html")))
    n = pages.count()
    tasks = -(-n // FILES_A_TASK)
    if tasks > pages.rdd.getNumPartitions():
        pages = pages.repartition(tasks)
    if mounted(spark, path):
        name = F.concat(F.lit("page_id="), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(".txt"))
        content = F.concat("html", F.lit("\n")).cast("binary")
        assets.write(pages.select(name.alias("name"), content.alias("content")), path)
    else:
        pages.write.partitionBy("page_id").option("maxRecordsPerFile", 1).text(path)
    files = assets.read(spark, path, recursiveFileLookup="true", pathGlobFilter="*.txt")
    # Spark counts 4 MB for opening a file and would read a few in a task.
    return files.coalesce(max(-(-n // FILES_READ_A_TASK), spark.sparkContext.defaultParallelism))


def _page_id():
    return F.regexp_extract("path", r"page_id=(\d+)", 1).cast("bigint").alias("page_id")


@query(
    "asset_files",
    r"""SELECT page_id, CAST(strlen(coalesce(html, '')) + 1 AS BIGINT) AS content_length, 'text/html' AS content_type,
      nullif(regexp_extract(html, '(?is)<html[^>]*\slang=["'']([^"'']*)["'']', 1), '') AS language
    FROM pages WHERE regexp_matches(html, '(?is)<(?:!doctype|html|head|body)[\s>]')""",
)
def asset_files(spark, sf_dir):
    """Pages in files, read as binary files and taken apart."""
    found = assets.extract(_page_files(spark, sf_dir)).select(_page_id(), "asset.*")
    return found.where("content_type = 'text/html'").select("page_id", "content_length", "content_type", "language")


@query(
    "asset_extractor",
    """SELECT page_id, sha1(coalesce(html, '') || chr(10)) AS digest,
      CAST(len(string_split(coalesce(html, ''), '<')) - 1 AS INTEGER) AS tags FROM pages""",
)
def asset_extractor(spark, sf_dir):
    """The same files through an extractor of one's own."""

    def digests(files):
        text = F.decode("content", "UTF-8")
        return files.select(_page_id(), F.sha1("content").alias("digest"), (F.size(F.split(text, "<")) - 1).alias("tags"))

    return assets.extract(_page_files(spark, sf_dir), digests)


@query(
    "types_from_table",
    """SELECT c_custkey, c_mktsegment || ',Party,Node' AS types, c_mktsegment = 'BUILDING' AS fulltext_root
    FROM customer""",
)
def types_from_table(spark, sf_dir):
    """Node types that come as rows, one for each segment of the customers."""
    no_properties = F.array().cast(
        "array<struct<name:string,type:string,mapping:string,indexing:boolean,extractor:string>>"
    )

    def rows(frame, name, above, root):
        supertypes = F.array(*[F.lit(s) for s in above]).cast("array<string>")
        return frame.select(
            name.alias("type"), supertypes.alias("supertypes"), F.lit(False).alias("abstract"),
            root.alias("fulltext_root"), F.lit(None).cast("boolean").alias("fulltext_enabled"),
            no_properties.alias("properties"),
        )

    customers = table(spark, sf_dir, "customer")
    segments = customers.select("c_mktsegment").distinct()
    one, unset = spark.range(1), F.lit(None).cast("boolean")
    own_root = F.when(F.col("c_mktsegment") == "BUILDING", F.lit(True))
    types = from_table(
        rows(segments, F.col("c_mktsegment"), ["Party"], own_root)
        .unionByName(rows(one, F.lit("Party"), ["Node"], unset))
        .unionByName(rows(one, F.lit("Node"), [], unset))
    ).frame(spark)
    return customers.join(types, F.col("c_mktsegment") == F.col("type")).select(
        "c_custkey", F.array_join("type_closure", ",").alias("types"), "fulltext_root"
    )


@query(
    "switched_versions",
    """SELECT 'd' || CAST(conv_id % 3 AS VARCHAR) || '-two' AS index_name, TRUE AS live,
      count(*) + count(DISTINCT conv_id) AS n, count(DISTINCT conv_id) AS pages
    FROM conversations GROUP BY conv_id % 3""",
)
def switched_versions(spark, sf_dir):
    """A version is replaced by one of its name, another made live, the old one removed: what is listed and served."""
    conv = F.regexp_extract("node_id", r"^c(\d+)", 1).cast("bigint")
    content = conversation_nodes(spark, sf_dir).withColumn("dimension", F.concat(F.lit("d"), (conv % 3).cast("string")))
    stamps = {c: F.lit(None).cast("timestamp") for c in ("created", "last_modified", "original_last_modified")}
    built = build(content.withColumns(stamps | {"hidden_in_menu": F.lit(False)}), BuildConfig(CONVERSATION_TYPES))
    store = IndexStore(spark, f"parted_{uuid.uuid4().hex[:12]}")
    for version in ("one", "one", "two"):
        store.create(built, version)
    store.make_live("one")
    store.make_live("two")
    store.remove_old()
    name = F.concat_ws("-", "dimension", "version").alias("index_name")
    listed = store.indices(prefix=store.alias).select("dimension", name, "live")
    # The view of all dimensions against the catalog.
    served = store.current("docs").groupBy("dimension").agg(
        F.count("*").alias("n"), F.count_if(F.col("type") == "Page").alias("pages")
    )
    found = materialise(listed.join(served, "dimension", "full").drop("dimension"), "switched")
    store.drop()
    return found


_ORPHANS_SQL = TREE_SQL.replace("FALSE, FALSE, TRUE\n  FROM nation", "FALSE, FALSE, FALSE\n  FROM nation")


@query(
    "orphan_parts",
    f"""WITH RECURSIVE {_ORPHANS_SQL}
    SELECT node_id, path FROM tree
    WHERE type = 'Order' AND closest_root IS NULL AND NOT disabled AND NOT removed""",
)
def orphan_parts(spark, sf_dir):
    """Visible orders with text whose customers are no pages, where nations are none either."""
    found = tree_nodes(spark, sf_dir)
    found = found.withColumn("fulltext_root", F.col("fulltext_root") & (F.col("type") != "Nation"))
    texts = found.where("type = 'Order'").select(
        "workspace", "dimension", "node_id", F.lit("text").alias("bucket"), F.col("node_id").alias("text")
    )
    _, lost = rollup.parts(texts, hierarchy.resolve(found).nodes)
    return lost.select("node_id", "path").distinct()


@query(
    "fulltext_switched_off",
    """SELECT 'c' || conv_id || '-' || turn AS node_id, CASE role WHEN 'system' THEN 'h1' ELSE 'text' END AS bucket,
      trim(text) AS text FROM conversations WHERE role <> 'user' AND trim(text) <> ''""",
)
def fulltext_switched_off(spark, sf_dir):
    """A type whose full text is off gives no text; the others do."""
    off = NodeType("user", ("Node",), fulltext_enabled=False, properties=CONVERSATION_TYPES.properties("user"))
    types = NodeTypes([off if t.name == "user" else t for t in CONVERSATION_TYPES])
    found = rollup.extract(conversation_nodes(spark, sf_dir), rollup.extractors_of(types))
    return found.select("node_id", "bucket", "text")


_DOCUMENT_MARKS_SQL = _HIGHLIGHT_SQL.replace("conv_id, turn", "doc_id").replace("FROM conversations", "FROM documents")


@query(
    "default_highlight",
    f"""WITH {TOKENS_SQL}, {_DOCUMENT_MARKS_SQL},
    page AS (
      SELECT doc_id, round(1 + sum(part), 6) AS score FROM bm25 WHERE term IN ('nicht', 'tion', 'ther')
      GROUP BY doc_id ORDER BY score DESC, doc_id LIMIT 10)
    SELECT doc_id, score, CASE WHEN len(hits) > 0 THEN array_to_string(hits, ' ... ') ELSE left(text, 150) END AS marks
    FROM page JOIN marked USING (doc_id)""",
)
def default_highlight(spark, sf_dir):
    """A page of hits with the highlights that a text query has if none are asked for."""
    hits = Search(document_search(spark, sf_dir)).fulltext("nicht tion ther").hits()
    return hits.select("doc_id", "score", F.array_join("highlight.text", " ... ").alias("marks"))


@query(
    "named_suggestion",
    f"""WITH {TOKENS_SQL}, {_SUGGEST_SQL}
    SELECT a.token_pos, a.token, b.term AS option, b.rank FROM asked a LEFT JOIN best b USING (token_pos)""",
)
def named_suggestion(spark, sf_dir):
    """A suggestion under a name of its own, as part of a search."""
    search = Search(document_search(spark, sf_dir)).suggestions(
        "spelling", {"text": _MISSPELT, "term": {"field": "fulltext.text"}}
    )
    return search.execute().suggestions()["spelling"].select("token_pos", "token", "option", "rank")


@query(
    "search_report",
    f"""WITH {TOKENS_SQL}, {_SUGGEST_SQL},
    better AS (
      SELECT CASE WHEN max(coalesce(b.score, 0)) >= 0.7
                  THEN string_agg(coalesce(b.term, a.token), ' ' ORDER BY a.token_pos) ELSE '' END AS did_you_mean
      FROM asked a LEFT JOIN best b ON a.token_pos = b.token_pos AND b.rank = 1),
    found AS (
      SELECT doc_id, round(1 + sum(part), 6) AS score FROM bm25 WHERE term IN (SELECT token FROM asked) GROUP BY doc_id)
    SELECT doc_id, score, did_you_mean, (SELECT count(*) FROM found) AS total
    FROM (SELECT * FROM found ORDER BY score DESC, doc_id LIMIT 10) AS page CROSS JOIN better""",
)
def report_of_search(spark, sf_dir):
    """The best ten, a better spelling and the total, as one table."""
    hits, better, total = search_report(Search(document_search(spark, sf_dir)), _MISSPELT)
    (spelling,) = better.first()
    return hits.select("doc_id", "score", F.lit(spelling).alias("did_you_mean"), F.lit(total).cast("bigint").alias("total"))


@query(
    "error_sinks",
    """WITH bad AS (
      SELECT event_id, CASE WHEN value > 100 THEN 'value too large' ELSE 'not an index event' END AS reason
      FROM events WHERE value > 100 OR event_type = 'error')
    SELECT sink, left(sha1('run|' || event_id || '|' || reason), 12) AS reference, CAST(event_id AS VARCHAR) AS doc_id,
      reason, (SELECT count(*) FROM bad) AS n
    FROM bad CROSS JOIN (VALUES ('json'), ('error_reports')) AS s(sink)""",
)
def errors_in_sinks(spark, sf_dir):
    """Events that fail a check go to two data sources, each counted while it is written, and are read from there."""
    events = table(spark, sf_dir, "events").withColumn("doc_id", F.col("event_id"))
    checks = {"value too large": F.col("value") <= 100, "not an index event": F.col("event_type") != "error"}
    _, bad = validity.split(events, checks, "run", F.col("props"))
    bad = materialise(bad, "quarantined")
    json_path, report_path = scratch_path(spark, "errors"), scratch_path(spark, "errors")
    n_json = error_sinks.store(bad, "json", {"path": json_path})
    n_reports = error_sinks.store(bad, error_sinks.REPORTS, {"path": report_path})
    reports = spark.read.schema("reference string, reason string, doc_id string, payload string").csv(
        report_path, sep="\t", quote="", escape=""
    )
    read = [(spark.read.schema(bad.schema).json(json_path), "json", n_json), (reports, error_sinks.REPORTS, n_reports)]
    found = [
        frame.select(F.lit(sink).alias("sink"), "reference", "doc_id", "reason", F.lit(n).cast("bigint").alias("n"))
        for frame, sink, n in read
    ]
    return found[0].unionByName(found[1])
