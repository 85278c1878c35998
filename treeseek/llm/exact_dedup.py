"""Exact deduplication with streaming state on disk.

Every text, white space removed, has a digest. A stream of (digest, id, length,
place) feeds state that is keyed by digest, lies in RocksDB and never expires.
The state of a digest holds the row that stays so far — its length, its id and
the place of its content — and how many rows came. A stream that goes on later
from the same state folder knows all earlier rows.

A digest that was hit more than once is checked on full bytes: the smallest and
the largest text under it must be the same. Both are aggregated before the
shuffle, so a text with any number of copies moves once per task. Should texts
differ under one digest, those rows are grouped by the text itself.

Everything is DataFrame and streaming SQL; no Python runs on executors.

Defined results: a null text counts as empty; a row with a null id is a row of
its own and loses to any other of the same length; of rows that agree in text,
length and id, the one whose place is last in order stays; an empty table gives
an empty result; other columns are carried along untouched.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from treeseek.llm.rows import HOT_ROWS, SPACES, column, field, located, sieve, sifted, without
from treeseek.operators.skew import hot_keys, join_unique
from treeseek.session import materialise, scratch_path

_STORE = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    # Files of the store take the room they need, not some megabytes each in advance.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}

Digest = Callable[[Column], Column]


def normalised(text: Column) -> Column:
    """The text without white space; null counts as empty."""
    out = F.coalesce(text, F.lit(""))
    for space in SPACES:
        out = F.replace(out, F.lit(space), F.lit(""))
    return out


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


@dataclass
class Deduplicated:
    """``rows``: row, id, digest, keep_id, keep_row, group_size, kept; one for each row of the documents."""

    rows: DataFrame
    _documents: DataFrame

    def kept(self) -> DataFrame:
        """The documents that stay, with their own columns."""
        return without(self._documents, self.rows.where(~F.col("kept")))


def feed(placed: DataFrame, id_column: str, text_column: str, digest: Digest = sha256) -> DataFrame:
    """What the stream is fed with, from a batch or a stream of placed rows."""
    text = field(text_column)
    return placed.select(
        "row",
        field(id_column).alias("id"),
        F.length(F.coalesce(text, F.lit(""))).alias("points"),
        digest(normalised(text)).alias("digest"),
    )


def best(points: str = "points", identifier: str = "id") -> Column:
    """The row that stays: longest, then smallest id, as an order that no id can overflow."""
    return F.max(F.struct(F.col(points), F.bitwise_not(column(identifier).cast("bigint")).alias("order"), F.col("row")))


@contextmanager
def _rocksdb(spark: SparkSession) -> Iterator[None]:
    before = {key: spark.conf.get(key, None) for key in _STORE}
    for key, value in _STORE.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def advance(spark: SparkSession, state: str, schema, files_per_batch: int | None = None) -> DataFrame:
    """Run the stream over what was fed since the last time; returns the state.

    Every micro-batch commits its state to the folder, from where a lost
    executor's share is loaded again.
    """
    with _rocksdb(spark):
        reader = spark.readStream.schema(schema).option("recursiveFileLookup", "true")
        if files_per_batch:
            reader = reader.option("maxFilesPerTrigger", files_per_batch)
        keyed = (
            reader.parquet(os.path.join(state, "feed"))
            .groupBy("digest")
            .agg(best().alias("best"), F.count(F.lit(1)).alias("n"))
        )
        query = (
            keyed.writeStream.format("noop")
            .outputMode("update")
            .option("checkpointLocation", os.path.join(state, "checkpoint"))
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
        # The fields of a value lie in the order of the aggregates.
        stored = spark.read.format("statestore").load(os.path.join(state, "checkpoint"))
        chosen, n = (F.col("value").getField(f.name) for f in stored.schema["value"].dataType.fields)
        hit = stored.select(
            F.col("key.digest").alias("digest"),
            F.bitwise_not(chosen["order"]).alias("keep_id"),
            chosen["row"].alias("keep_row"),
            n.alias("n"),
        ).where(F.col("n") > 1)
        return materialise(hit, "dedup-state")


def deduplicate(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    state: str | None = None,
    corpus: DataFrame | None = None,
    digest: Digest = sha256,
    files_per_batch: int | None = None,
    hot: int = HOT_ROWS,
) -> Deduplicated:
    """Group ``docs`` by equal text and name the row of each group that stays.

    ``state`` is a folder to go on from and to leave the state in; without it a
    new one in the shared folder is taken. With state from earlier calls,
    ``corpus`` must hold all documents so far, for the check on bytes: the
    places in the state are places in its files.
    """
    spark = docs.sparkSession
    state = state or scratch_path(spark, "dedup")
    placed = located(docs)
    path = os.path.join(state, "feed", uuid.uuid4().hex)
    fed = feed(placed, id_column, text_column, digest)
    fed.write.parquet(path)
    fed = spark.read.schema(fed.schema).parquet(path)
    groups = advance(spark, state, fed.schema, files_per_batch)
    hot_digests = hot_keys(groups.select("digest", "n"), ["digest"], hot)

    everything = placed if corpus is None else located(corpus)
    texts = everything.select(
        "row", field(id_column).alias("id"), normalised(field(text_column)).alias("text"),
        F.length(F.coalesce(field(text_column), F.lit(""))).alias("points"),
    ).withColumn("digest", digest(F.col("text")))
    # Only texts that a sieve of the digests with hits lets through are shuffled.
    digests = sieve(groups.select(F.xxhash64("digest").alias("h")))
    suspects = sifted(texts, F.xxhash64("digest"), digests).where("maybe").drop("maybe")
    hit = join_unique(suspects, groups.select("digest"), ["digest"], hot_digests, ["row"])
    unequal = materialise(
        hit.groupBy("digest").agg(F.min("text").alias("low"), F.max("text").alias("high"))
        .where(F.col("low") != F.col("high")).select("digest"),
        "dedup-unequal",
    )
    if unequal.isEmpty():
        return Deduplicated(_named(fed, groups, ["digest"], hot_digests), placed)
    split = texts.join(unequal, "digest", "left_semi")
    by_text = split.groupBy("digest", "text").agg(best().alias("best"), F.count(F.lit(1)).alias("n")).select(
        "digest", "text", F.bitwise_not(F.col("best.order")).alias("keep_id"), F.col("best.row").alias("keep_row"), "n"
    )
    apart = _named(split.join(fed.select("row"), "row", "left_semi"), by_text, ["digest", "text"], None)
    rest = _named(fed.join(unequal, "digest", "left_anti"), groups, ["digest"], hot_digests)
    return Deduplicated(rest.unionByName(apart), placed)


def _named(rows: DataFrame, groups: DataFrame, keys: list[str], hot: DataFrame | None) -> DataFrame:
    own = F.col("keep_row").isNull()
    return join_unique(rows, groups, keys, hot, ["row"], "left").select(
        "row",
        "id",
        "digest",
        F.when(own, F.col("id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("keep_row", "row").alias("keep_row"),
        F.coalesce("n", F.lit(1).cast("bigint")).alias("group_size"),
        (own | (F.col("keep_row") == F.col("row"))).alias("kept"),
    )
