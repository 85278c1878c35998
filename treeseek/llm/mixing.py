"""Mixing sources to target weights by thresholds on a hash.

Sources share all words by weight; a target stops at a number of times its
source's size and what is above is shared out again. A source gives each of its
documents a whole number of times, and once more those whose hash lies below a
threshold. The threshold comes from histograms: words are summed by source and
the first digits of the hash, the bucket that the budget ends in is found, and
only that bucket is summed again by the next digits, until it holds one
document. Nothing is sorted, and the documents are filtered where they are
scanned: hash against threshold.

The hash is that of id and text, so reruns agree. Only rows that agree in both
are told apart by their place.

Defined results: a null or empty text has size 0 and is taken 0 words; a null
source is a source of its own, the last; a null id is part of the hash; of equal
repeated rows as many are taken as the budget asks for; a source without words
has target 0 and gives no rows; an empty table gives an empty result; other
columns are carried along untouched.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from treeseek.llm.rows import HOT_ROWS, field, located
from treeseek.operators.skew import hot_keys, join_unique, ordered_chunks
from treeseek.session import materialise, materialise_counted

WEIGHTS = (5, 2, 1)
MOST_TIMES = 3
# Thresholds of so many sources, some 100 bytes each, are broadcast; texts stay where they are then.
FEW_SOURCES = 100_000
_DIGITS = 3  # hexadecimal digits per level: 4,096 buckets


@dataclass
class Mix:
    """``rows``: row, id, size, source_size, target, times, taken; ``sources``: targets and thresholds."""

    rows: DataFrame
    sources: DataFrame
    n_sources: int
    _documents: DataFrame
    _key: Column
    _source: Column
    _hot: DataFrame | None

    def documents(self) -> DataFrame:
        """The documents, each as often as the mix takes it."""
        chosen = self.sources.select("source_key", "base", "cut")
        keyed = self._documents.select("doc", "row", self._source.alias("source_key"), self._key.alias("key"))
        if self.n_sources <= FEW_SOURCES:
            timed = keyed.join(F.broadcast(chosen), "source_key")
        else:
            timed = join_unique(keyed, chosen, ["source_key"], self._hot, ["row"])
        timed = timed.withColumn("times", _times())
        return timed.where("times > 0").select(
            "doc", F.explode(F.sequence(F.lit(1), F.col("times"))).alias("_copy")
        ).select("doc.*")


def _times() -> Column:
    return (F.col("base") + F.when(F.col("key") < F.col("cut"), 1).otherwise(0)).cast("int")


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, most: int = MOST_TIMES) -> DataFrame:
    """From (source, source_key, source_size, n): with ``weight`` and ``target``.

    Sources are ranked by range, so any number of them is spread over tasks.
    The driver sees three sums per round of sharing out.
    """
    ordered = sizes.withColumn("unnamed", F.col("source").isNull())
    chunked = ordered_chunks(ordered, [], ["unnamed", "source"], "sources")
    in_chunk = F.row_number().over(Window.partitionBy("chunk").orderBy("unnamed", "source"))
    per_chunk = chunked.groupBy("chunk").agg(F.count(F.lit(1)).alias("rows"))
    before = F.sum("rows").over(Window.orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1))
    starts = per_chunk.select("chunk", F.coalesce(before, F.lit(0)).alias("before"))
    rank = F.col("before") + F.col("in_chunk") - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (rank % len(weights) + 1).cast("int"))
    weighted = materialise(
        chunked.withColumn("in_chunk", in_chunk).join(starts, "chunk").withColumn("weight", weight)
        .drop("chunk", "in_chunk", "before", "unnamed"),
        "weights",
    )
    total = weighted.agg(F.sum("source_size")).first()[0] or 0
    limit = F.col("source_size") * most
    full, free, level = -1, 0, 0.0
    while True:
        above = F.col("weight") * F.lit(level) > limit
        row = weighted.agg(
            F.sum(F.when(above, 1).otherwise(0)).alias("full"),
            F.sum(F.when(above, limit).otherwise(0)).alias("words"),
            F.sum(F.when(above, 0).otherwise(F.col("weight"))).alias("free"),
        ).first()
        if row["full"] is None or row["full"] == full or not row["free"]:
            break
        full, free = row["full"], row["free"]
        level = (total - row["words"]) / free
    share = F.col("weight") * F.lit(level)
    return weighted.withColumn("target", F.when(share > limit, limit.cast("double")).otherwise(share))


def thresholds(documents: DataFrame, budgets: DataFrame) -> DataFrame:
    """From (source_key, key, size) and (source_key, budget): source_key, ``cut``.

    The documents whose key is below the cut have in all the number of words
    that comes nearest to the budget.
    """
    open_ = budgets.where("budget > 0").select("source_key", "budget", F.lit("").alias("prefix"))
    closed = budgets.where("not budget > 0 or budget is null").select("source_key", F.lit("").alias("cut"))
    found = [closed]
    level = 0
    while True:
        at = level * _DIGITS
        within = documents.withColumn("prefix", F.substring("key", 1, at))
        sums = (
            within.join(open_.select("source_key", "prefix"), ["source_key", "prefix"], "left_semi")
            .groupBy("source_key", "prefix", F.substring("key", at + 1, _DIGITS).alias("digits"))
            .agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("n"))
        )
        # At most 4,096 rows per source.
        earlier = Window.partitionBy("source_key").orderBy("digits").rowsBetween(Window.unboundedPreceding, -1)
        placed = sums.withColumn("before", F.coalesce(F.sum("words").over(earlier), F.lit(0))).join(
            open_, ["source_key", "prefix"]
        )
        boundary, n = materialise_counted(
            placed.where("before <= budget and before + words > budget").select(
                "source_key",
                "n",
                F.concat("prefix", "digits").alias("prefix"),
                (F.col("budget") - F.col("before")).alias("budget"),
                (F.col("words") - (F.col("budget") - F.col("before"))).alias("over"),
            ),
            "boundary",
        )
        # "g" comes after all hexadecimal digits.
        one = F.when(F.col("over") < F.col("budget"), F.concat("prefix", F.lit("g"))).otherwise(F.col("prefix"))
        found.append(boundary.where("n = 1").select("source_key", one.alias("cut")))
        # Where a rounded budget reaches the end, all documents are below.
        whole = open_.join(boundary, "source_key", "left_anti")
        found.append(whole.select("source_key", F.concat("prefix", F.lit("g")).alias("cut")))
        open_ = boundary.where("n > 1").select("source_key", "budget", "prefix")
        if not n or open_.isEmpty():
            break
        level += 1
    out = found[0]
    for part in found[1:]:
        out = out.unionByName(part)
    return out


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def mix(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    weights: Sequence[float] = WEIGHTS,
    most: int = MOST_TIMES,
    hot: int = HOT_ROWS,
) -> Mix:
    """How often the mix takes each document."""
    placed = located(docs)
    text = F.coalesce(field(text_column), F.lit(""))
    identity = F.coalesce(field(id_column).cast("string"), F.lit(""))
    key = F.concat(
        F.md5(F.concat(identity, F.lit("|"), text).cast("binary")),
        F.md5(F.concat("row.file", F.lit("|"), F.col("row.position").cast("string")).cast("binary")),
    )
    source = field(source_column).cast("string")
    # A null source differs from all names: names get a mark in front.
    source_key = F.coalesce(F.concat(F.lit("="), source), F.lit(""))
    slim = materialise(
        placed.select(
            "row", field(id_column).alias("id"), source.alias("source"), source_key.alias("source_key"),
            key.alias("key"), words(field(text_column)).alias("size"),
        ),
        "sizes",
    )
    sizes = slim.groupBy("source_key").agg(
        F.first("source").alias("source"), F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n")
    )
    shared = targets(sizes, weights, most).withColumn(
        "base",
        F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("bigint"),
    )
    budgets = shared.select("source_key", (F.col("target") - F.col("base") * F.col("source_size")).alias("budget"))
    cuts = thresholds(slim.select("source_key", "key", "size"), budgets)
    sources, n_sources = materialise_counted(shared.join(cuts, "source_key"), "thresholds")
    large = hot_keys(sources.select("source_key", "n"), ["source_key"], hot)
    rows = (
        join_unique(slim.drop("source"), sources.drop("n", "weight", "source"), ["source_key"], large, ["row"])
        .withColumn("times", _times())
        .select("row", "id", "size", "source_size", "target", "times", (F.col("size") * F.col("times")).alias("taken"))
    )
    return Mix(rows, sources, n_sources, placed, key, source_key, large)
