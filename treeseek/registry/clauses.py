"""Filter clauses, sorting, paging, counting."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from treeseek.functions import dates
from treeseek.functions.geo import cell_column, distance_m, point_column, with_cell
from treeseek.model import KEYWORD_LIMIT
from treeseek.operators import filters
from treeseek.plans.search import Search, SearchIndex
from treeseek.registry import query
from treeseek.registry.data import documents, table
from treeseek.session import materialise


def _parts(spark, sf_dir):
    return SearchIndex(table(spark, sf_dir, "part").withColumn("doc_id", F.col("p_partkey")))


def _orders(spark, sf_dir):
    return SearchIndex(table(spark, sf_dir, "orders").withColumn("doc_id", F.col("o_orderkey")))


@query("exact_match", "SELECT p_partkey, p_name FROM part WHERE p_brand = 'Brand#7' AND p_type = 'SMALL'")
def exact_match(spark, sf_dir):
    found = Search(_parts(spark, sf_dir)).exact_match("p_brand", "Brand#7").exact_match("p_type", "SMALL")
    return found.matching().select("p_partkey", "p_name")


@query(
    "exact_match_array",
    "SELECT p_partkey FROM part WHERE list_contains(string_split(p_name, ' '), 'red')",
)
def exact_match_array(spark, sf_dir):
    docs = table(spark, sf_dir, "part").select(
        "p_partkey", F.col("p_partkey").alias("doc_id"), F.split("p_name", " ").alias("words")
    )
    return Search(SearchIndex(docs)).exact_match("words", "red").matching().select("p_partkey")


@query("exclude", "SELECT p_partkey FROM part WHERE p_type <> 'PROMO' OR p_type IS NULL")
def exclude(spark, sf_dir):
    return Search(_parts(spark, sf_dir)).exclude("p_type", "PROMO").matching().select("p_partkey")


@query(
    "exclude_missing",
    """SELECT d.doc_id FROM documents d LEFT JOIN labels l USING (doc_id) WHERE coalesce(l.quality <> 1, TRUE)""",
)
def exclude_missing(spark, sf_dir):
    """A document without the value passes an exclusion."""
    docs = documents(spark, sf_dir, hidden=True)
    return Search(SearchIndex(docs)).include_hidden().exclude("quality", 1).matching().select("doc_id")


@query(
    "ranges",
    """SELECT o_orderkey, o_totalprice FROM orders
    WHERE o_totalprice > 50000 AND o_totalprice <= 250000
      AND o_orderdate >= TIMESTAMP '1997-01-01 00:00:00' AND o_orderdate < TIMESTAMP '1998-01-01 00:00:00'""",
)
def ranges(spark, sf_dir):
    found = (
        Search(_orders(spark, sf_dir))
        .greater_than("o_totalprice", 50000)
        .less_than_or_equal("o_totalprice", 250000)
        .greater_than_or_equal("o_orderdate", datetime(1997, 1, 1))
        .less_than("o_orderdate", "1998-01-01T00:00:00+00:00")
    )
    return found.matching().select("o_orderkey", "o_totalprice")


@query("prefix", "SELECT p_partkey, p_name FROM part WHERE starts_with(p_name, 'hot')")
def prefix(spark, sf_dir):
    return Search(_parts(spark, sf_dir)).prefix("p_name", "hot").matching().select("p_partkey", "p_name")


@query(
    "filter_multiple",
    "SELECT p_partkey FROM part WHERE p_brand IN ('Brand#1', 'Brand#12') AND p_type = 'LARGE'",
)
def filter_multiple(spark, sf_dir):
    wanted = {"p_brand": ["Brand#1", "Brand#12"], "p_type": "LARGE", "p_size": None}
    return Search(_parts(spark, sf_dir)).query_filter_multiple(wanted).matching().select("p_partkey")


@query(
    "bool_or",
    """SELECT p_partkey FROM part WHERE (p_size >= 45 OR p_type = 'ECONOMY' OR starts_with(p_name, 'old'))
      AND NOT p_brand = 'Brand#3'""",
)
def bool_or(spark, sf_dir):
    group = {
        "should": [
            {"range": {"p_size": {"gte": 45}}}, {"term": {"p_type": "ECONOMY"}}, {"prefix": {"p_name": "old"}}
        ],
        "must_not": {"term": {"p_brand": "Brand#3"}},
    }
    return Search(_parts(spark, sf_dir)).query_filter("bool", group).matching().select("p_partkey")


@query(
    "should_groups",
    """SELECT p_partkey FROM part WHERE p_size < 25 AND NOT p_type = 'PROMO'""",
)
def should_groups(spark, sf_dir):
    """``should`` next to ``must`` does not filter by itself."""
    found = (
        Search(_parts(spark, sf_dir))
        .less_than("p_size", 25)
        .query_filter("term", {"p_brand": "Brand#2"}, "should")
        .query_filter("term", {"p_type": "PROMO"}, "must_not")
    )
    return found.matching().select("p_partkey")


@query(
    "min_should",
    """SELECT p_partkey FROM part WHERE CAST(p_size > 20 AS INT) + CAST(p_type = 'SMALL' AS INT)
      + CAST(starts_with(p_name, 'blue') AS INT) + CAST(p_retailprice > 950 AS INT) >= 2""",
)
def min_should(spark, sf_dir):
    found = (
        Search(_parts(spark, sf_dir))
        .greater_than("p_size", 20, "should")
        .query_filter("term", {"p_type": "SMALL"}, "should")
        .prefix("p_name", "blue", "should")
        .greater_than("p_retailprice", 950, "should")
        .minimum_should_match(2)
    )
    return found.matching().select("p_partkey")


@query(
    "hidden_default",
    """SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)""",
)
def hidden_default(spark, sf_dir):
    return Search(SearchIndex(documents(spark, sf_dir, hidden=True))).matching().select("doc_id")


# Points out of the key: spread over the globe by integer arithmetic.
_LAT, _LON = "(s_suppkey * 37 % 170) - 85", "(s_suppkey * 101 % 360) - 180"
_HAVERSINE = f"""
2 * 6371008.8 * asin(sqrt(least(1.0,
  pow(sin((radians({_LAT}) - radians(51.512711)) / 2), 2)
  + cos(radians(51.512711)) * cos(radians({_LAT})) * pow(sin((radians({_LON}) - radians(7.453084)) / 2), 2))))"""


def _suppliers(spark, sf_dir):
    point = F.struct(
        (F.col("s_suppkey") * 37 % 170 - 85).cast("double").alias("lat"),
        (F.col("s_suppkey") * 101 % 360 - 180).cast("double").alias("lon"),
    )
    return SearchIndex(
        table(spark, sf_dir, "supplier").select(
            "s_suppkey", "s_name", F.col("s_suppkey").alias("doc_id"), point.alias("location")
        )
    )


@query(
    "geo_within",
    f"SELECT s_suppkey, CAST(round({_HAVERSINE}, 3) AS DOUBLE) AS metres FROM supplier WHERE {_HAVERSINE} <= 4500000",
)
def geo_within(spark, sf_dir):
    here = {"lat": 51.512711, "lon": 7.453084}
    found = Search(_suppliers(spark, sf_dir)).geo_distance("location", here, "4500km").matching()
    away = distance_m(F.col("location.lat"), F.col("location.lon"), here)
    return found.select("s_suppkey", F.round(away, 3).alias("metres"))


@query(
    "geo_sort",
    f"""SELECT s_suppkey, CAST(round({_HAVERSINE} / 1000, 6) AS DOUBLE) AS km FROM supplier
    ORDER BY {_HAVERSINE}, s_suppkey LIMIT 15""",
)
def geo_sort(spark, sf_dir):
    nearest = {"_geo_distance": {"location": "51.512711,7.453084", "order": "asc", "unit": "km"}}
    hits = Search(_suppliers(spark, sf_dir)).sort(nearest).limit(15).select("s_suppkey").hits()
    return hits.select("s_suppkey", F.round("sort_values.s0", 6).alias("km"))


_STORED_LAT = f"CASE WHEN s_suppkey % 4 = 3 THEN (floor(({_LAT} + 90) / 180.0 * 1073741824) + 0.5) / 1073741824 * 180 - 90 ELSE {_LAT} END"
_STORED_LON = f"CASE WHEN s_suppkey % 4 = 3 THEN (floor(({_LON} + 180) / 360.0 * 1073741824) + 0.5) / 1073741824 * 360 - 180 ELSE {_LON} END"


@query(
    "geo_stored_forms",
    f"""WITH stored AS (SELECT s_suppkey, {_STORED_LAT} AS lat, {_STORED_LON} AS lon FROM supplier),
    away AS (SELECT s_suppkey, 2 * 6371008.8 * asin(sqrt(least(1.0, pow(sin((radians(lat) - radians(-33.5)) / 2), 2)
      + cos(radians(-33.5)) * cos(radians(lat)) * pow(sin((radians(lon) - radians(151.25)) / 2), 2)))) AS metres FROM stored)
    SELECT s_suppkey, CAST(round(metres, 2) AS DOUBLE) AS metres FROM away WHERE metres <= 6000000""",
)
def geo_stored_forms(spark, sf_dir):
    """Points stored as mappings, lists, pairs and geohashes, kept in the order of their cells."""
    lat, lon = F.col("location.lat"), F.col("location.lon")
    form = F.col("s_suppkey") % 4
    stored = (
        F.when(form == 0, F.to_json(F.struct(lat.alias("lat"), lon.alias("lon"))))
        .when(form == 1, F.to_json(F.array(lon, lat)))
        .when(form == 2, F.concat_ws(", ", lat.cast("string"), lon.cast("string")))
        .otherwise(cell_column(lat, lon))
    )
    docs = _suppliers(spark, sf_dir).docs.withColumn("location", point_column(stored))
    docs = docs.withColumn("location", with_cell(F.col("location")))
    docs = materialise(docs.repartitionByRange("location.cell").sortWithinPartitions("location.cell"), "located")
    here = "-33.5,151.25"
    found = Search(SearchIndex(docs)).geo_distance("location", here, "6000km").matching()
    return found.select("s_suppkey", F.round(distance_m(lat, lon, here), 2).alias("metres"))


@query(
    "date_mapping",
    """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S+00:00') AS wire,
      strftime(date_trunc('month', o_orderdate), '%Y-%m-%dT%H:%M:%S+00:00') AS month FROM orders""",
)
def date_mapping(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        dates.to_wire(F.col("o_orderdate").cast("timestamp")).alias("wire"),
        dates.to_wire(F.date_trunc("month", "o_orderdate")).alias("month"),
    )


@query(
    "relative_range",
    """SELECT o_orderkey FROM orders
    WHERE o_orderdate > TIMESTAMP '1998-06-15 12:00:00' - INTERVAL 6 MONTH
      AND o_orderdate <= date_trunc('day', TIMESTAMP '1998-06-15 12:00:00' + INTERVAL 10 DAY)""",
)
def relative_range(spark, sf_dir):
    """Relative dates around a fixed now."""
    now = datetime(1998, 6, 15, 12)
    found = (
        Search(_orders(spark, sf_dir))
        .greater_than("o_orderdate", dates.relative("now-6M", now))
        .less_than_or_equal("o_orderdate", dates.relative("now+10d/d", now))
    )
    return found.matching().select("o_orderkey")


@query(
    "custom_where",
    "SELECT o_orderkey FROM orders WHERE o_totalprice / 1000 > 400 AND o_orderstatus = 'F' AND o_custkey > 100",
)
def custom_where(spark, sf_dir):
    found = Search(_orders(spark, sf_dir)).where(F.col("o_totalprice") / 1000 > 400).exact_match("o_orderstatus", "F")
    return found.transform(lambda docs: docs.where("o_custkey > 100")).matching().select("o_orderkey")


@query(
    "count_all",
    """SELECT count(*) AS n FROM orders WHERE o_orderstatus = 'O' AND o_totalprice >= 100000""",
)
def count_all(spark, sf_dir):
    found = (
        Search(_orders(spark, sf_dir)).exact_match("o_orderstatus", "O").greater_than_or_equal("o_totalprice", 100000)
    )
    return found.limit(1).matching(functions=False).agg(F.count("*").alias("n"))


@query(
    "page_sorted",
    """SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderpriority = '1-URGENT'
    ORDER BY o_totalprice DESC, o_orderkey LIMIT 10""",
)
def page_sorted(spark, sf_dir):
    found = Search(_orders(spark, sf_dir)).exact_match("o_orderpriority", "1-URGENT").sort_desc("o_totalprice")
    return found.select("o_orderkey", "o_totalprice").hits().select("o_orderkey", "o_totalprice")


@query(
    "page_offset",
    """SELECT o_orderkey FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 25 OFFSET 40""",
)
def page_offset(spark, sf_dir):
    found = Search(_orders(spark, sf_dir)).sort_asc("o_orderdate").from_(40).limit(25)
    return found.select("o_orderkey").hits().select("o_orderkey")


@query(
    "multi_sort",
    """SELECT p_partkey, p_brand AS s0, p_size AS s1 FROM part
    ORDER BY p_brand ASC, p_size DESC, p_partkey LIMIT 50""",
)
def multi_sort(spark, sf_dir):
    """Two keys, with the sort values of each hit."""
    found = Search(_parts(spark, sf_dir)).sort_asc("p_brand").sort_desc("p_size").limit(50).select("p_partkey")
    return found.hits().select("p_partkey", "sort_values.s0", "sort_values.s1")


@query(
    "sort_missing_last",
    """SELECT d.doc_id, l.quality FROM documents d LEFT JOIN labels l USING (doc_id)
    ORDER BY l.quality ASC NULLS LAST, d.doc_id LIMIT 300""",
)
def sort_missing_last(spark, sf_dir):
    docs = SearchIndex(documents(spark, sf_dir, hidden=True))
    found = Search(docs).include_hidden().sort_asc("quality").limit(300).select("quality")
    return found.hits().select("doc_id", "quality")


@query("first_result", "SELECT p_partkey FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT 1")
def first_result(spark, sf_dir):
    found = Search(_parts(spark, sf_dir)).sort_desc("p_retailprice").limit(1).select("p_partkey")
    return found.hits().select("p_partkey")


@query(
    "keyword_cap",
    "SELECT doc_id FROM documents WHERE length(text) <= 8191 AND text > 'The'",
)
def keyword_cap(spark, sf_dir):
    """With the cap that a field may have, values beyond it are not found."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return docs.where(filters.range_(docs, "text", cap=KEYWORD_LIMIT, gt="The")).select("doc_id")


@query("keyword_whole", "SELECT doc_id FROM documents WHERE text > 'The' AND NOT starts_with(text, 'Then')")
def keyword_whole(spark, sf_dir):
    """Values of any length are found."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = filters.range_(docs, "text", gt="The") & ~filters.prefix(docs, "text", "Then")
    return docs.where(found).select("doc_id")
