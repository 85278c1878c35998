"""Bucket and metric aggregations."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from treeseek.operators.aggregate import counts_by_index
from treeseek.plans.search import Search, SearchIndex
from treeseek.registry import query
from treeseek.registry.data import documents, table


def _parts(spark, sf_dir):
    return Search(SearchIndex(table(spark, sf_dir, "part").withColumn("doc_id", F.col("p_partkey"))))


def _items(spark, sf_dir):
    return Search(SearchIndex(table(spark, sf_dir, "lineitem").withColumn("doc_id", F.col("l_orderkey"))))


@query(
    "terms_agg",
    """SELECT p_brand AS brands, count(*) AS doc_count FROM part GROUP BY p_brand
    ORDER BY doc_count DESC, brands LIMIT 10""",
)
def terms_agg(spark, sf_dir):
    return _parts(spark, sf_dir).field_based_aggregation("brands", "p_brand").execute().aggregations()["brands"]


@query(
    "terms_agg_array",
    """SELECT word AS words, count(*) AS doc_count FROM (
      SELECT p_partkey, unnest(list_distinct(string_split(p_name, ' '))) AS word FROM part)
    GROUP BY word ORDER BY doc_count DESC, words LIMIT 5""",
)
def terms_agg_array(spark, sf_dir):
    docs = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("doc_id"), F.split("p_name", " ").alias("words_of_name")
    )
    found = Search(SearchIndex(docs)).field_based_aggregation("words", "words_of_name", size=5)
    return found.execute().aggregations()["words"]


@query(
    "metrics",
    """SELECT min(p_retailprice) AS low, max(p_retailprice) AS high, round(avg(p_retailprice), 6) AS mean,
      CAST(sum(p_size) AS BIGINT) AS total, count(p_type) AS n FROM part WHERE p_size > 10""",
)
def metrics(spark, sf_dir):
    found = _parts(spark, sf_dir).greater_than("p_size", 10)
    for name, field, kind in (
        ("low", "p_retailprice", "min"), ("high", "p_retailprice", "max"), ("mean", "p_retailprice", "avg"),
        ("total", "p_size", "sum"), ("n", "p_type", "value_count"),
    ):
        found = found.field_based_aggregation(name, field, kind)
    return found.execute().metrics().withColumn("mean", F.round("mean", 6))


@query(
    "metrics_empty",
    """SELECT count(p_size) AS n, CAST(coalesce(sum(p_size), 0) AS BIGINT) AS total FROM part WHERE p_size > 1000""",
)
def metrics_empty(spark, sf_dir):
    """No hits: counts and sums are zero."""
    found = _parts(spark, sf_dir).greater_than("p_size", 1000).field_based_aggregation("s", "p_size", "stats")
    row = found.execute().aggregations()["s"]
    return row.select(F.col("s_count").alias("n"), F.col("s_sum").alias("total"))


@query(
    "stats",
    """SELECT count(l_quantity) AS q_count, min(l_quantity) AS q_min, max(l_quantity) AS q_max,
      round(avg(l_quantity), 6) AS q_avg, round(sum(l_quantity), 2) AS q_sum FROM lineitem""",
)
def stats(spark, sf_dir):
    row = _items(spark, sf_dir).field_based_aggregation("q", "l_quantity", "stats").execute().aggregations()["q"]
    return row.withColumns({"q_avg": F.round("q_avg", 6), "q_sum": F.round("q_sum", 2)})


@query(
    "nested_avg",
    """SELECT p_type AS types, count(*) AS doc_count, round(avg(p_retailprice), 6) AS price, max(p_size) AS size
    FROM part GROUP BY p_type ORDER BY doc_count DESC, types LIMIT 4""",
)
def nested_avg(spark, sf_dir):
    found = (
        _parts(spark, sf_dir)
        .field_based_aggregation("types", "p_type", size=4)
        .field_based_aggregation("price", "p_retailprice", "avg", "types")
        .field_based_aggregation("size", "p_size", "max", "types")
    )
    return found.execute().aggregations()["types"].withColumn("price", F.round("price", 6))


@query(
    "nested_terms",
    """WITH top AS (SELECT p_type, count(*) AS n FROM part GROUP BY p_type ORDER BY n DESC, p_type LIMIT 3),
    pairs AS (SELECT p_type, p_brand, count(*) AS doc_count, round(avg(p_size), 6) AS size FROM part
      WHERE p_type IN (SELECT p_type FROM top) GROUP BY ALL)
    SELECT p_type AS types, p_brand AS brands, doc_count, size FROM pairs
    QUALIFY row_number() OVER (PARTITION BY p_type ORDER BY doc_count DESC, p_brand) <= 4""",
)
def nested_terms(spark, sf_dir):
    found = (
        _parts(spark, sf_dir)
        .field_based_aggregation("types", "p_type", size=3)
        .field_based_aggregation("brands", "p_brand", "terms", "types", 4)
        .field_based_aggregation("size", "p_size", "avg", "types.brands")
    )
    return found.execute().aggregations()["types.brands"].withColumn("size", F.round("size", 6))


@query(
    "custom_agg",
    """WITH top AS (SELECT l_returnflag AS flags, count(*) AS doc_count FROM lineitem GROUP BY ALL),
    pairs AS (SELECT l_returnflag AS flags, l_linestatus AS status, count(*) AS doc_count,
      round(avg(l_discount), 6) AS discount FROM lineitem GROUP BY ALL)
    SELECT * FROM pairs""",
)
def custom_agg(spark, sf_dir):
    """One nested definition instead of several calls."""
    definition = {
        "terms": {"field": "l_returnflag"},
        "aggs": {
            "status": {"terms": {"field": "l_linestatus"}, "aggs": {"discount": {"avg": {"field": "l_discount"}}}}
        },
    }
    found = _items(spark, sf_dir).aggregation("flags", definition)
    return found.execute().aggregations()["flags.status"].withColumn("discount", F.round("discount", 6))


@query(
    "multi_agg",
    """WITH long AS (
      SELECT 'p_brand' AS facet, p_brand AS key, count(*) AS doc_count FROM part WHERE p_size < 40 GROUP BY ALL
      UNION ALL SELECT 'p_type', p_type, count(*) FROM part WHERE p_size < 40 GROUP BY ALL
      UNION ALL SELECT 'p_size', CAST(p_size AS VARCHAR), count(*) FROM part WHERE p_size < 40 GROUP BY ALL)
    SELECT * FROM long QUALIFY row_number() OVER (PARTITION BY facet ORDER BY doc_count DESC, key) <= 10""",
)
def multi_agg(spark, sf_dir):
    """Several aggregations of one query in one pass."""
    found = _parts(spark, sf_dir).less_than("p_size", 40)
    found = found.transform(lambda docs: docs.withColumn("p_size", F.col("p_size").cast("string")))
    for name in ("p_brand", "p_type", "p_size"):
        found = found.field_based_aggregation(name, name)
    results = found.execute().aggregations(share=True)
    facets = [
        buckets.select(F.lit(name).alias("facet"), F.col(name).alias("key"), "doc_count")
        for name, buckets in results.items()
    ]
    return functools.reduce(DataFrame.union, facets)


@query(
    "histogram",
    """SELECT CAST(floor(o_totalprice / 50000) * 50000 AS DOUBLE) AS prices, count(*) AS doc_count FROM orders
    GROUP BY ALL""",
)
def histogram(spark, sf_dir):
    docs = SearchIndex(table(spark, sf_dir, "orders").withColumn("doc_id", F.col("o_orderkey")))
    spec = {"histogram": {"field": "o_totalprice", "interval": 50000}}
    return Search(docs).aggregation("prices", spec).execute().aggregations()["prices"]


@query(
    "date_histogram",
    """SELECT strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS month, count(*) AS doc_count,
      round(max(o_totalprice), 6) AS top FROM orders GROUP BY ALL""",
)
def date_histogram(spark, sf_dir):
    docs = SearchIndex(table(spark, sf_dir, "orders").withColumn("doc_id", F.col("o_orderkey")))
    spec = {
        "date_histogram": {"field": "o_orderdate", "calendar_interval": "month"},
        "aggs": {"top": {"max": {"field": "o_totalprice"}}},
    }
    found = Search(docs).aggregation("month", spec).execute().aggregations()["month"]
    return found.select(F.date_format("month", "yyyy-MM-dd").alias("month"), "doc_count", F.round("top", 6).alias("top"))


@query(
    "cardinality",
    """SELECT count(DISTINCT l_partkey) AS exact_parts, TRUE AS parts_close,
      count(DISTINCT l_suppkey) AS exact_suppliers, TRUE AS suppliers_close FROM lineitem""",
)
def cardinality(spark, sf_dir):
    """Approximate by definition: checked to be within five percent of the exact number."""
    found = _items(spark, sf_dir)
    for name, field in (("parts", "l_partkey"), ("suppliers", "l_suppkey")):
        found = found.field_based_aggregation(name, field, "cardinality")
    near = found.execute().metrics().first()
    exact = found.matching().agg(
        F.count_distinct("l_partkey").alias("exact_parts"), F.count_distinct("l_suppkey").alias("exact_suppliers")
    )
    return exact.select(
        "exact_parts",
        (F.abs(F.col("exact_parts") - near.parts) <= 0.05 * F.col("exact_parts")).alias("parts_close"),
        "exact_suppliers",
        (F.abs(F.col("exact_suppliers") - near.suppliers) <= 0.05 * F.col("exact_suppliers")).alias("suppliers_close"),
    )


@query(
    "percentiles",
    """SELECT quantile_disc(l_extendedprice, 0.05) AS p5, quantile_disc(l_extendedprice, 0.5) AS p50,
      quantile_disc(l_extendedprice, 0.95) AS p95 FROM lineitem""",
)
def percentiles(spark, sf_dir):
    """With an accuracy at which the result is exact here."""
    spec = {"percentiles": {"field": "l_extendedprice", "percents": [5, 50, 95], "accuracy": 1_000_000}}
    row = _items(spark, sf_dir).aggregation("price", spec).execute().aggregations()["price"]
    return row.select(*[F.get("price", F.lit(i)).alias(f"p{p}") for i, p in enumerate((5, 50, 95))])


@query(
    "build_report",
    """SELECT 'live' AS workspace, lang AS dimension, count(*) AS n_docs FROM documents GROUP BY lang""",
)
def build_report(spark, sf_dir):
    return counts_by_index(documents(spark, sf_dir))


@query(
    "filtered_total",
    """SELECT p_type AS types, count(*) AS doc_count, CAST(sum(count(*)) OVER () AS BIGINT) AS total
    FROM part WHERE p_brand = 'Brand#5' GROUP BY p_type""",
)
def filtered_total(spark, sf_dir):
    """Buckets and total hits come from all matches, whatever the page."""
    found = _parts(spark, sf_dir).exact_match("p_brand", "Brand#5").limit(1).field_based_aggregation("types", "p_type")
    result = found.execute()
    return result.aggregations()["types"].withColumn("total", F.lit(result.total()))
