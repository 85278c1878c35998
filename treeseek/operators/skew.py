"""Keys that hold a large share of the rows.

A hot key is found by counting, and its rows are then spread over several
tasks. The list of hot keys is short by construction: a key is hot only if it
holds more than 1/``SHARE`` of all rows, so there are at most ``SHARE`` of them
and the list can be broadcast at any data size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from treeseek.session import materialise

SHARE = 2000
FLOOR = 100_000
# WindowGroupLimit thins a ranked window before its shuffle up to this many rows.
_THINNED_BY_SPARK = 1000


def hot_keys(counts: DataFrame, keys: Sequence[str], floor: int | None = None) -> DataFrame | None:
    """From (keys, n): the hot keys and into how many pieces to split each; None if there are none."""
    total, largest = counts.agg(F.sum("n"), F.max("n")).first()
    limit = max(FLOOR if floor is None else floor, (total or 0) // SHARE)
    if (largest or 0) <= limit:
        return None
    return counts.where(F.col("n") > limit).select(
        *keys, F.ceil(F.col("n") / limit).cast("int").alias("_pieces")
    )


def join_unique(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    hot: DataFrame | None,
    spread: Sequence[str],
    how: str = "inner",
) -> DataFrame:
    """Join where ``right`` has one row per key and ``left`` may be skewed.

    Rows of ``left`` under a hot key are dealt out by the hash of ``spread``;
    the one row of ``right`` is repeated once per piece.
    """
    keys = list(keys)
    if hot is None:
        return left.join(right, keys, how)
    small = F.broadcast(hot)
    dealt = left.join(small, keys, "left").withColumn(
        "_piece",
        F.when(F.col("_pieces").isNull(), F.lit(0)).otherwise(
            F.pmod(F.xxhash64(*spread), F.col("_pieces")).cast("int")
        ),
    ).drop("_pieces")
    repeated = right.join(small, keys, "left").withColumn(
        "_piece", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_pieces"), F.lit(1)) - 1))
    ).drop("_pieces")
    return dealt.join(repeated, [*keys, "_piece"], how).drop("_piece")


def ordered_chunks(df: DataFrame, keys: Sequence[str], order: Sequence[str], label: str) -> DataFrame:
    """``df`` cut into ranges of (keys, order), with the range number as ``chunk``.

    A group of any size is spread over as many ranges as its share of the rows,
    and ranges follow the order within the group. The result is written, since
    the number of a range is only fixed once the rows lie in files.
    """
    ranged = df.repartitionByRange(*[F.col(c) for c in (*keys, *order)])
    return materialise(ranged.withColumn("chunk", F.spark_partition_id()), label)


def first_n(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, spread: Sequence[str]) -> DataFrame:
    """The first ``n`` rows per group; rows that tie in ``order`` go by ``spread``.

    Up to ``_THINNED_BY_SPARK`` rows a ranked window is thinned before its
    shuffle. Beyond, rows are put in ranges of (keys, order) and counted per
    range: ranges before the one that holds a group's n-th row are in whole,
    those behind it are out, and only that one is ranked.
    """
    order = [*order, *[F.asc(c) for c in spread]]
    if n <= _THINNED_BY_SPARK:
        ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
        return ranked.where(F.col("_rank") <= n).drop("_rank")
    ranged = df.repartitionByRange(*[F.asc(k) for k in keys], *order)
    ranged = materialise(ranged.withColumn("_range", F.spark_partition_id()), "ranges")
    # One row per group and range it lies in.
    earlier = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    counts = ranged.groupBy(*keys, "_range").agg(F.count(F.lit(1)).alias("_n"))
    counts = counts.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).where(F.col("_before") < n)
    named = counts.select(
        *[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)],
        F.col("_range").alias("_at"), "_before", (F.col("_before") + F.col("_n") <= n).alias("_whole"),
    )
    same = F.col("_range") == F.col("_at")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_key{i}"))
    joined = ranged.join(named, same)
    within = Window.partitionBy(*keys, "_range").orderBy(*order)
    last = joined.where(~F.col("_whole")).withColumn("_rank", F.row_number().over(within))
    last = last.where(F.col("_before") + F.col("_rank") <= n)
    return joined.where("_whole").select(*df.columns).union(last.select(*df.columns))
