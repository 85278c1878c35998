"""From nodes to documents: ids, projection, HTML, assets, roll-up, mapping checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from treeseek.functions import html, ids
from treeseek.functions.analysis import AnalyzerSet
from treeseek.model import LIVE, NO_DIMENSION, NodeType, NodeTypes, Property
from treeseek.operators import hierarchy, mapping, projection, rollup, text_index
from treeseek.plans.build import BuildConfig, build
from treeseek.plans.search import Search, SearchIndex
from treeseek.registry import query
from treeseek.registry.data import TREE_SQL, documents, table, tree, tree_nodes
from treeseek.registry.fulltext import _BUCKET_SQL
from treeseek.session import spread
from treeseek.sources import assets


@query(
    "doc_ids",
    """SELECT doc_id AS source_id,
      sha1('{"repository":"default","workspace":"live","dimension":"' || lang || '","node_id":"' || doc_id || '"}') AS doc_id,
      sha1(doc_id || 'live') AS plain_id
    FROM documents""",
)
def doc_ids(spark, sf_dir):
    node = (F.col("node_id"), F.col("workspace"))
    return documents(spark, sf_dir).select(
        F.col("doc_id").alias("source_id"),
        ids.address_id(*node, F.col("dimension")).alias("doc_id"),
        ids.plain_id(*node).alias("plain_id"),
    )


_SETTINGS = {"src1:*": False, "src1:en": True, "src2:*": True, "src3:de": False, "*": True}


@query(
    "indexable_filter",
    """SELECT doc_id, source || ':' || lang AS type FROM documents
    WHERE NOT (source = 'src1' AND lang <> 'en') AND NOT (source = 'src3' AND lang = 'de')""",
)
def indexable_filter(spark, sf_dir):
    docs = documents(spark, sf_dir)
    return docs.where(projection.indexable(F.col("type"), _SETTINGS)).select("doc_id", "type")


@query(
    "type_report",
    """SELECT DISTINCT source || ':' || lang AS type,
      NOT (source = 'src1' AND lang <> 'en') AND NOT (source = 'src3' AND lang = 'de') AS indexable
    FROM documents""",
)
def type_report(spark, sf_dir):
    types = documents(spark, sf_dir).select("type").distinct()
    return projection.indexable_report(types, _SETTINGS)


@query(
    "live_only",
    """SELECT doc_id, CASE WHEN quality = 1 THEN 'live' ELSE 'draft' END AS workspace FROM labels WHERE quality = 1""",
)
def live_only(spark, sf_dir):
    """Drafts count as live once they are published there."""
    drafts = table(spark, sf_dir, "labels").select(
        "doc_id", F.lit("draft").alias("workspace"), F.when(F.col("quality") == 1, LIVE).alias("target_workspace")
    )
    return projection.publish_to_target(projection.scope_to_live(drafts, index_all_workspaces=False))


@query(
    "resolve_in_target",
    """SELECT doc_id, doc_id IN (SELECT doc_id FROM labels WHERE quality = 1) AS found FROM documents""",
)
def resolve_in_target(spark, sf_dir):
    """Changed nodes that are in the target, and those to skip."""
    changes = documents(spark, sf_dir).select("doc_id", "workspace", F.lit("all").alias("dimension"), "node_id")
    target = table(spark, sf_dir, "labels").where("quality = 1").select(
        F.lit(LIVE).alias("workspace"), F.lit("all").alias("dimension"), F.col("doc_id").cast("string").alias("node_id")
    )
    found, skipped = projection.resolve_in_target(changes, target)
    return (
        found.select("doc_id", F.lit(True).alias("found"))
        .unionByName(skipped.select("doc_id", F.lit(False).alias("found")))
    )


def page_documents(spark, sf_dir):
    """HTML pages as search documents with their buckets."""
    return spread(table(spark, sf_dir, "pages")).select(
        F.col("page_id").alias("doc_id"),
        F.col("page_id").cast("string").alias("node_id"),
        F.lit(LIVE).alias("workspace"),
        F.lit(NO_DIMENSION).alias("dimension"),
        F.col("url").alias("path"),
        html.buckets(F.col("html")).alias("fulltext"),
    )


@query(
    "html_buckets",
    f"""WITH {_BUCKET_SQL}
    SELECT page_id, field AS bucket, text FROM buckets WHERE text <> ''""",
)
def html_buckets(spark, sf_dir):
    return spread(table(spark, sf_dir, "pages")).select("page_id", F.inline(html.bucket_rows(F.col("html"))))


@query(
    "asset_fields",
    r"""WITH a AS (
      SELECT page_id, html, regexp_replace(regexp_replace(html,
        '(?is)<!--.*?-->|<script[^>]*>.*?</script>|<style[^>]*>.*?</style>', ' ', 'g'),
        '(?is)<head[^>]*>.*?</head>', ' ', 'g') AS body FROM pages)
    SELECT page_id, trim(regexp_replace(
        replace(replace(replace(replace(replace(replace(regexp_replace(body, '(?s)<[^>]*>', ' ', 'g'),
          '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;', '&'),
        '[ \t\r\n]+', ' ', 'g')) AS content,
      nullif(trim(regexp_replace(
        replace(replace(replace(replace(replace(replace(
          regexp_replace(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), '(?s)<[^>]*>', ' ', 'g'),
          '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;', '&'),
        '[ \t\r\n]+', ' ', 'g')), '') AS title,
      'text/html' AS content_type, CAST(strlen(html) AS BIGINT) AS content_length,
      nullif(regexp_extract(html, '(?is)<html[^>]*\slang=["'']([^"'']*)["'']', 1), '') AS language
    FROM a""",
)
def asset_fields(spark, sf_dir):
    text = F.col("html")
    asset = assets.fields(text, F.col("url"), F.octet_length(text))
    return (
        spread(table(spark, sf_dir, "pages"))
        .select("page_id", asset.alias("asset"))
        .select("page_id", *[f"asset.{f}" for f in ("content", "title", "content_type", "content_length", "language")])
    )


# Conversations as pages, their turns as content below them.
_BUCKET_OF_ROLE = {"system": "h1", "user": "h2", "assistant": "text"}
CONVERSATION_TYPES = NodeTypes(
    [
        NodeType("Node"),
        NodeType("Page", ("Node",), fulltext_root=True),
        *[
            NodeType(
                role, ("Node",),
                properties={"text": Property(extractor=lambda v, b=bucket: html.into(b, v))},
            )
            for role, bucket in _BUCKET_OF_ROLE.items()
        ],
    ]
)


def conversation_nodes(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations")
    conv = F.concat(F.lit("c"), F.col("conv_id").cast("string"))
    common = [F.lit(LIVE).alias("workspace"), F.lit(NO_DIMENSION).alias("dimension")]
    no_tags = F.array().cast("array<string>").alias("tags")
    no_properties = F.create_map().cast("map<string,string>").alias("properties")
    pages = turns.select("conv_id").distinct().select(
        conv.alias("node_id"), F.lit(None).cast("string").alias("parent_id"), *common, F.lit("Page").alias("type"),
        no_tags, F.col("conv_id").alias("sort_index"), no_properties,
    )
    content = turns.select(
        F.concat_ws("-", conv, F.col("turn").cast("string")).alias("node_id"), conv.alias("parent_id"), *common,
        F.col("role").alias("type"), no_tags, F.col("turn").alias("sort_index"),
        F.create_map(F.lit("text"), F.col("text")).alias("properties"),
    )
    return pages.unionByName(content)


def conversation_parts(spark, sf_dir):
    nodes = conversation_nodes(spark, sf_dir)
    resolved = hierarchy.resolve(nodes, CONVERSATION_TYPES.frame(spark))
    extracted = rollup.extract(nodes, rollup.extractors_of(CONVERSATION_TYPES))
    parts, _ = rollup.parts(extracted, resolved.nodes)
    return parts


_PARTS_SQL = """
parts AS (
  SELECT 'c' || conv_id AS root_id, turn, 'c' || conv_id || '-' || turn AS part_node_id,
         CASE role WHEN 'system' THEN 'h1' WHEN 'user' THEN 'h2' ELSE 'text' END AS bucket, trim(text) AS text
  FROM conversations WHERE trim(text) <> '')"""


@query(
    "fulltext_rollup",
    f"""WITH {_PARTS_SQL}
    SELECT root_id, bucket, string_agg(text, ' ' ORDER BY turn) AS text FROM parts GROUP BY ALL""",
)
def fulltext_rollup(spark, sf_dir):
    chunks = rollup.chunked(conversation_parts(spark, sf_dir))
    return rollup.roll_up(chunks).select("root_id", "bucket", "text")


@query(
    "rollup_postings",
    rf"""WITH {_PARTS_SQL},
    pages AS (SELECT root_id, bucket, string_agg(text, ' ' ORDER BY turn) AS text FROM parts GROUP BY ALL),
    tokens AS (SELECT root_id, bucket,
      list_filter(regexp_split_to_array(lower(text), '[^\p{{L}}\p{{N}}]+'), lambda t: t <> '') AS t FROM pages),
    places AS (SELECT root_id, bucket, len(t) AS dl, unnest(t) AS term, unnest(range(len(t))) AS pos FROM tokens)
    SELECT root_id, bucket AS field, term, count(*) AS tf, any_value(dl) AS dl, min(pos) AS first_pos,
           max(pos) AS last_pos, CAST(sum(pos) AS BIGINT) AS pos_sum
    FROM places GROUP BY ALL""",
)
def rollup_postings(spark, sf_dir):
    """Postings of pages out of their parts: positions run through the whole page."""
    analyzers = AnalyzerSet()
    chunks = rollup.chunked(conversation_parts(spark, sf_dir))
    located = rollup.with_offsets(rollup.tokenised(chunks, analyzers.default.tokens(F.col("text"))))
    return text_index.invert_parts(located).select(
        "root_id", "field", "term", F.col("tf").cast("bigint"), F.col("dl").cast("bigint"),
        F.get("positions", F.lit(0)).cast("bigint").alias("first_pos"),
        F.element_at("positions", -1).cast("bigint").alias("last_pos"),
        F.aggregate("positions", F.lit(0).cast("bigint"), lambda a, p: a + p).alias("pos_sum"),
    )


@query(
    "page_search",
    rf"""WITH {_PARTS_SQL},
    pages AS (SELECT root_id, bucket, string_agg(text, ' ' ORDER BY turn) AS text FROM parts GROUP BY ALL),
    tokens AS (SELECT root_id, bucket,
      list_filter(regexp_split_to_array(lower(text), '[^\p{{L}}\p{{N}}]+'), lambda t: t <> '') AS t FROM pages),
    lengths AS (SELECT root_id, bucket, len(t) AS dl FROM tokens WHERE len(t) > 0),
    postings AS (SELECT root_id, bucket, term, count(*) AS tf FROM (
      SELECT root_id, bucket, unnest(t) AS term FROM tokens) GROUP BY ALL),
    field_stats AS (SELECT bucket, count(*) AS n, avg(dl) AS avg_dl FROM lengths GROUP BY ALL),
    term_stats AS (SELECT bucket, term, count(*) AS df FROM postings GROUP BY ALL),
    scored AS (
      SELECT p.root_id, p.bucket, sum(ln(1 + (f.n - s.df + 0.5) / (s.df + 0.5))
        * p.tf * 2.2 / (p.tf + 1.2 * (0.25 + 0.75 * l.dl / f.avg_dl))) AS part
      FROM postings p JOIN lengths l USING (root_id, bucket) JOIN field_stats f USING (bucket)
      JOIN term_stats s USING (bucket, term) WHERE p.term IN ('ther', 'nicht', 'elle', 'tion') GROUP BY ALL)
    SELECT root_id AS node_id, round(1 + max(CASE bucket WHEN 'h1' THEN 20 WHEN 'h2' THEN 12 ELSE 1 END * part), 6) AS score
    FROM scored GROUP BY root_id""",
)
def page_search(spark, sf_dir):
    """From nodes to ranked pages: the whole build, then a query with bucket weights."""
    no_time = F.lit(None).cast("timestamp")
    nodes = conversation_nodes(spark, sf_dir).withColumns(
        {"created": no_time, "last_modified": no_time, "original_last_modified": no_time,
         "hidden_in_menu": F.lit(False)}
    )
    built = build(nodes, BuildConfig(CONVERSATION_TYPES))
    found = Search(SearchIndex(built.docs, built.text)).fulltext("ther nicht elle tion")
    return found.matching().select("node_id", "score")


@query(
    "tree_rollup",
    f"""WITH RECURSIVE {TREE_SQL},
    parts AS (
      SELECT t.closest_root AS root_id, o.o_orderkey, c.c_custkey, trim(o.o_orderpriority) AS text
      FROM tree t JOIN orders o ON t.node_id = 'o' || o.o_orderkey JOIN customer c ON c.c_custkey = o.o_custkey
      WHERE NOT t.disabled AND NOT t.removed AND t.closest_root IS NOT NULL)
    SELECT root_id, string_agg(text, ' ' ORDER BY c_custkey, o_orderkey) AS text FROM parts GROUP BY root_id""",
)
def tree_rollup(spark, sf_dir):
    """Texts of orders in their nation or customer page; hidden and removed subtrees left out."""
    orders = table(spark, sf_dir, "orders").select(
        F.lit(LIVE).alias("workspace"), F.lit(NO_DIMENSION).alias("dimension"),
        F.concat(F.lit("o"), F.col("o_orderkey").cast("string")).alias("node_id"),
        F.lit("text").alias("bucket"), F.col("o_orderpriority").alias("text"),
    )
    parts, _ = rollup.parts(orders, tree(spark, sf_dir).nodes)
    return rollup.roll_up(rollup.chunked(parts)).select("root_id", "text")


@query(
    "parts_without_root",
    f"""WITH RECURSIVE {TREE_SQL}
    SELECT node_id, path FROM tree WHERE closest_root IS NULL AND depth > 0""",
)
def parts_without_root(spark, sf_dir):
    _, missing = hierarchy.closest_roots(tree(spark, sf_dir).nodes)
    return missing.select("node_id", "path")


CUSTOMER_TYPES = NodeTypes(
    [
        NodeType("Node", properties={"name": Property("string")}),
        NodeType("Party", ("Node",), properties={
            "balance": Property("double", mapping="double"),
            "nation": Property("integer"),
            "in_debt": Property("boolean", indexing=lambda value, node: (node("properties")["balance"].cast("double") < 0).cast("string")),
            "words": Property("array", indexing=lambda value, node: F.to_json(F.split(node("properties")["name"], "#"))),
            "note": Property("string", indexing=False),
            "photo": Property("Asset"),
            "position": Property("string", mapping="geo_point"),
        }),
        *[NodeType(s, ("Party",)) for s in ("BUILDING", "MACHINERY", "AUTOMOBILE", "FURNITURE", "HOUSEHOLD")],
        NodeType("Region", ("Node",)), NodeType("Nation", ("Node",)), NodeType("Order", ("Node",)),
    ]
)


@query(
    "projection",
    f"""WITH RECURSIVE {TREE_SQL}
    SELECT t.path, c.c_name AS name, c.c_acctbal AS balance, c.c_nationkey AS nation, c.c_acctbal < 0 AS in_debt,
      t.disabled AS hidden, 'Customer|' || string_split(c.c_name, '#')[2] AS words, c.c_mktsegment || ',Party,Node' AS type_closure,
      CAST(c.c_nationkey AS DOUBLE) AS lat
    FROM tree t JOIN customer c ON t.node_id = 'c' || c.c_custkey WHERE NOT t.removed""",
)
def project_customers(spark, sf_dir):
    """Typed documents of all customers in the tree."""
    properties = F.create_map(
        F.lit("name"), F.col("c_name"), F.lit("balance"), F.col("c_acctbal").cast("string"),
        F.lit("nation"), F.col("c_nationkey").cast("string"),
        F.lit("note"), F.lit("never indexed"),
        F.lit("position"), F.concat_ws(",", F.col("c_nationkey").cast("string"), F.lit("7.5")),
    )
    details = table(spark, sf_dir, "customer").select(
        F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("node_id"), properties.alias("properties")
    )
    no_time = F.lit(None).cast("timestamp")
    nodes = tree_nodes(spark, sf_dir).join(details, "node_id").withColumns(
        {"created": no_time, "last_modified": no_time, "original_last_modified": no_time,
         "hidden_in_menu": F.lit(None).cast("boolean")}
    )
    docs = projection.project(nodes, tree(spark, sf_dir).nodes, CUSTOMER_TYPES)
    return docs.select(
        "path", "name", "balance", "nation", "in_debt", "hidden", F.array_join("words", "|").alias("words"),
        F.array_join("type_closure", ",").alias("type_closure"), F.col("position.lat").alias("lat"),
    )


ORDER_TYPES = NodeTypes(
    [
        NodeType("Order", properties={
            "customer": Property("reference"),
            "parts": Property("references"),
            "main": Property("references", max_items=1),
        }),
        # Another type stores plain text under the same name.
        NodeType("Note", properties={"customer": Property("string")}),
    ]
)


@query(
    "reference_fields",
    """WITH lines AS (SELECT l_orderkey, string_agg('p' || l_partkey, ',' ORDER BY l_partkey) AS parts,
      'p' || min(l_partkey) AS main FROM (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem) GROUP BY ALL)
    SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN '{"node_id":"c' || o_custkey || '"}' ELSE 'c' || o_custkey END AS customer,
      CASE WHEN o_orderkey % 5 > 0 THEN parts END AS parts, CASE WHEN o_orderkey % 5 > 0 THEN main END AS main FROM orders LEFT JOIN lines ON l_orderkey = o_orderkey""",
)
def reference_fields(spark, sf_dir):
    """One reference and many, stored as ids and as nodes, become ids while projecting."""

    def node(node_id):
        return F.struct(node_id.alias("node_id"), F.lit("Node").alias("type"))

    lines = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.transform(F.array_sort(F.collect_set("l_partkey")), lambda k: F.concat(F.lit("p"), k.cast("string"))).alias("ids")
    )
    customer = F.concat(F.lit("c"), F.col("o_custkey").cast("string"))
    as_nodes = F.col("o_orderkey") % 2 == 0
    note = F.col("o_orderkey") % 5 == 0
    parts = F.when(~note & as_nodes, F.to_json(F.transform("ids", node))).when(~note, F.to_json("ids"))
    nodes = table(spark, sf_dir, "orders").join(lines, "o_orderkey", "left").select(
        "o_orderkey",
        F.when(note, "Note").otherwise("Order").alias("type"),
        F.create_map(
            F.lit("customer"),
            F.when(note | (F.col("o_orderkey") % 3 == 0), F.to_json(F.struct(customer.alias("node_id")))).otherwise(customer),
            F.lit("parts"), parts,
            F.lit("main"), F.when(as_nodes, parts).when(~note, F.get("ids", F.lit(0))),
        ).alias("properties"),
    )
    docs = nodes.select("o_orderkey", *projection.property_columns(ORDER_TYPES))
    return docs.select("o_orderkey", "customer", F.array_join("parts", ",").alias("parts"), "main")


@query(
    "dangling_references",
    """SELECT 'o' || o_orderkey AS node_id, 'customer' AS field, 'c' || o_custkey AS reference FROM orders
    WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)""",
)
def dangling_references(spark, sf_dir):
    """Orders of customers that are not indexed, since they are in debt."""
    place = [F.lit(LIVE).alias("workspace"), F.lit(NO_DIMENSION).alias("dimension")]
    customers = table(spark, sf_dir, "customer").where("c_acctbal >= 0").select(
        *place, F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("node_id"),
        F.lit(None).cast("string").alias("customer"),
    )
    orders = table(spark, sf_dir, "orders").select(
        *place, F.concat(F.lit("o"), F.col("o_orderkey").cast("string")).alias("node_id"),
        F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("customer"),
    )
    found = projection.dangling_references(orders.union(customers), ["customer"])
    return found.select("node_id", "field", "reference")


def _part_properties(spark, sf_dir):
    """Properties as the parts name them: noun is the field, adjective the mapping."""
    words = F.split("p_name", " ")
    return table(spark, sf_dir, "part").select(
        F.col("p_brand").alias("type"), F.get(words, F.lit(1)).alias("field"), F.get(words, F.lit(0)).alias("mapping"),
        F.get(words, F.lit(0)).alias("declared"),
    )


@query(
    "conflicting_types",
    """WITH p AS (SELECT p_brand AS type, split_part(p_name, ' ', 2) AS field, split_part(p_name, ' ', 1) AS mapping FROM part)
    SELECT field, string_agg(DISTINCT mapping, ',' ORDER BY mapping) AS mappings FROM p GROUP BY field
    HAVING count(DISTINCT mapping) > 1""",
)
def conflicting_types(spark, sf_dir):
    return mapping.conflicts(_part_properties(spark, sf_dir)).select(
        "field", F.array_join("mappings", ",").alias("mappings")
    )


@query(
    "mapping_warnings",
    """SELECT DISTINCT p_brand AS type, split_part(p_name, ' ', 2) AS field, split_part(p_name, ' ', 1) AS declared
    FROM part WHERE split_part(p_name, ' ', 1) NOT IN ('red', 'blue', 'small', 'large', 'hot')""",
)
def mapping_warnings(spark, sf_dir):
    known = spark.createDataFrame([(w,) for w in ("red", "blue", "small", "large", "hot")], "declared string")
    return mapping.warnings(_part_properties(spark, sf_dir), known).distinct()


@query(
    "renamed_fields",
    "SELECT doc_id AS identifier, source AS folder, lang AS dimension FROM documents",
)
def renamed_fields(spark, sf_dir):
    docs = documents(spark, sf_dir).select("doc_id", "source", "dimension")
    return projection.rename_fields(docs, {"doc_id": "identifier", "source": "folder"})
