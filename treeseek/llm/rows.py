"""Rows told apart by where they lie, so that repeated ids, null ids and equal rows stay apart."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from treeseek.session import materialise

# A key that holds more rows than this is dealt out over tasks.
HOT_ROWS = 1000

# What the operators call white space: blank, tab, line feed, vertical tab, form feed, carriage return.
SPACES = " \t\n\x0b\x0c\r"


def column(name: str) -> Column:
    """A top-level column, whatever characters its name has."""
    return F.col("`" + name.replace("`", "``") + "`")


def located(docs: DataFrame) -> DataFrame:
    """``docs`` as a struct ``doc`` and the place of each row, ``row`` = (file, position).

    The columns are packed, so no name of theirs can clash with a name in here.
    A frame that is no plain scan of files is written to the shared folder
    first: only then has a row a place that holds when a task runs again.
    """

    def placed(frame: DataFrame) -> DataFrame:
        meta = frame.metadataColumn("_metadata")
        row = F.struct(meta["file_path"].alias("file"), meta["row_index"].alias("position"))
        return frame.select(F.struct(*[column(c) for c in frame.columns]).alias("doc"), row.alias("row"))

    try:
        return placed(docs)
    except AnalysisException:
        return placed(materialise(docs, "rows"))


def field(name: str) -> Column:
    """A column of the packed ``doc``."""
    return F.col("doc").getField(name)


# Bits of a sieve. As bitmaps of 4 KB it has at most 16 MB, whatever it is made from.
SIEVE_BITS = 1 << 27


def sieve(hashes: DataFrame) -> DataFrame:
    """The bit set of the hashes in column ``h``: a sieve that lets through all of them and few others.

    When very many hashes fill it, it lets through more, and only saves less.
    """
    at = F.pmod(F.col("h"), F.lit(SIEVE_BITS))
    return (
        hashes.select(F.shiftright(at, 15).alias("_bucket"), at.bitwiseAND(F.lit(32767)).alias("_at"))
        .groupBy("_bucket")
        .agg(F.bitmap_construct_agg("_at").alias("_bitmap"))
    )


def sifted(frame: DataFrame, h: Column, bits: DataFrame) -> DataFrame:
    """``frame`` with ``maybe``: whether the hash ``h`` passes the sieve. Broadcasts it, its size being bounded."""
    at = F.pmod(h, F.lit(SIEVE_BITS))
    place = at.bitwiseAND(F.lit(32767))
    byte = F.conv(F.hex(F.substring("_bitmap", F.shiftright(place, 3) + 1, F.lit(1))), 16, 10).cast("int")
    is_set = F.expr("shiftright(_byte, _bit) & 1") == 1
    return (
        frame.withColumn("_bucket", F.shiftright(at, 15))
        .join(F.broadcast(bits), "_bucket", "left")
        .withColumns({"_byte": byte, "_bit": place.bitwiseAND(F.lit(7)).cast("int")})
        .withColumn("maybe", F.coalesce(is_set, F.lit(False)))
        .drop("_bucket", "_bitmap", "_byte", "_bit")
    )


def without(placed: DataFrame, dropped: DataFrame) -> DataFrame:
    """The documents of :func:`located` rows, but for the rows in ``dropped``.

    Only documents that the sieve cannot clear go through a shuffle.
    """
    dropped = materialise(dropped.select("row"), "dropped")
    h = F.xxhash64("row")
    marked = sifted(placed, h, sieve(dropped.select(h.alias("h"))))
    clear = marked.where("not maybe").select("doc.*")
    return clear.unionByName(marked.where("maybe").join(dropped, "row", "left_anti").select("doc.*"))
