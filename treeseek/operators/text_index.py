"""The text index: postings, lengths and corpus statistics."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from treeseek.functions.analysis import AnalyzerSet
from treeseek.session import spread

SCOPE = ("dimension", "workspace")
# The order of stored postings.
ORDER = ("dimension", "field", "term", "doc_id")
# Characters of text whose postings one task sorts: some 2 million rows.
TASK_CHARACTERS = 16_000_000
# Terms that a Python worker inverts at once; a longer text is inverted by itself.
TOKENS_AT_ONCE = 500_000


@dataclass(frozen=True)
class TextIndex:
    """``postings(dimension, workspace, doc_id, field, term, tf, positions, dl)``,
    ``field_stats(dimension, field, n_docs, avg_dl)``, ``term_stats(dimension, field, term, df)``.
    """

    postings: DataFrame
    field_stats: DataFrame
    term_stats: DataFrame
    analyzers: AnalyzerSet = AnalyzerSet()


def tokenise(
    docs: DataFrame, fields: Mapping[str, Column], analyzers: AnalyzerSet, keep: Sequence[str] = ("doc_id",)
) -> DataFrame:
    """Rows (keys, field, tokens), one per document and non-empty field."""
    per_field = F.array(
        *[
            F.struct(F.lit(name).alias("field"), analyzers.tokens(text, F.col("dimension"), name).alias("tokens"))
            for name, text in fields.items()
        ]
    )
    return docs.select(*SCOPE, *keep, F.inline(F.filter(per_field, lambda f: F.size(f["tokens"]) > 0)))


def invert(tokenised: DataFrame, keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Postings of each row, worked out where the row is: no shuffle.

    Rows go by as Arrow batches: terms and rows get numbers in the order of
    :data:`ORDER`, one stable sort puts (term, row) together with positions in
    order, and each run is a posting. Equal rows stay apart. What comes out of a
    batch is in order, so that a sort of a task's postings only merges. The
    functions are local ones, which reach executors that do not have this package.
    """
    names = (*SCOPE, *keep, "field")
    rows = tokenised.select(*names, "tokens")
    own = StructType.fromDDL("term string, tf int, positions array<int>, dl int")
    found = StructType([*(rows.schema[n] for n in names), *own])
    at_once, places = TOKENS_AT_ONCE, [c for c in ORDER if c in names]

    def lengths_of(batch: pa.RecordBatch) -> np.ndarray:
        lengths = pc.fill_null(pc.list_value_length(batch.column("tokens")), 0)
        return lengths.to_numpy(zero_copy_only=False).astype(np.int64)

    def in_order(values: pa.RecordBatch | pa.Array, keys: Sequence[str]) -> np.ndarray:
        """The numbers of the values in ascending order, nulls first."""
        by = [(k, "ascending") for k in keys]
        order = pc.sort_indices(values, sort_keys=by, null_placement="at_start").to_numpy()
        numbers = np.empty(len(order), dtype=np.int64)
        numbers[order] = np.arange(len(order))
        return numbers

    def postings(batch: pa.RecordBatch) -> pa.RecordBatch:
        lengths = lengths_of(batch)
        coded = batch.column("tokens").flatten().dictionary_encode()
        row = np.repeat(np.arange(len(lengths)), lengths)
        position = np.arange(len(row)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        # Dimension and field come before the term, the document behind it.
        part = np.zeros(len(lengths), dtype=np.int64)
        for name in ("dimension", "field"):
            values = batch.column(name).dictionary_encode(null_encoding="encode")
            part = part * max(1, len(values.dictionary)) + in_order(values.dictionary, [""])[values.indices.to_numpy()]
        term = in_order(coded.dictionary, [""])[coded.indices.to_numpy()]
        key = (part[row] * max(1, len(coded.dictionary)) + term) * len(lengths) + in_order(batch, places)[row]
        order = np.argsort(key, kind="stable")
        starts = np.flatnonzero(np.diff(key[order], prepend=-1))
        ends = np.append(starts, len(key))
        at = row[order[starts]]
        columns = [batch.column(n).take(pa.array(at)) for n in names]
        columns += [
            coded.dictionary.take(coded.indices.take(pa.array(order[starts]))),
            pa.array(np.diff(ends), pa.int32()),
            pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(position[order], pa.int32())),
            pa.array(lengths[at], pa.int32()),
        ]
        return pa.RecordBatch.from_arrays(columns, names=found.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends = np.cumsum(lengths_of(batch))
            first = 0
            while first < batch.num_rows:
                limit = (ends[first - 1] if first else 0) + at_once
                last = max(first + 1, int(np.searchsorted(ends, limit, side="right")))
                yield postings(batch.slice(first, last - first))
                first = last

    return rows.mapInArrow(run, found)


def invert_parts(located_parts: DataFrame) -> DataFrame:
    """Postings of pages from their parts, with positions in the whole bucket.

    The parts of a page that lie in one range are inverted as one text. Postings
    meet per (page, field, term) only for pages that lie in several ranges.
    """
    keys = (*SCOPE, "root_id", "field")
    ordered = F.sort_array(F.collect_list(F.struct("offset", "tokens")))
    ranges = (
        located_parts.withColumnRenamed("bucket", "field")
        .groupBy(*keys, "chunk")
        .agg(
            F.flatten(F.transform(ordered, lambda part: part["tokens"])).alias("tokens"),
            F.min("offset").alias("offset"),
            F.max("dl").cast("int").alias("page_dl"),
            F.max("n_ranges").alias("n_ranges"),
        )
    )

    def postings(some: DataFrame) -> DataFrame:
        shifted = F.transform("positions", lambda p: p + F.col("offset"))
        return invert(some, keep=("root_id", "offset", "page_dl")).select(
            *keys, "term", "tf", F.when(F.col("offset") == 0, F.col("positions")).otherwise(shifted).alias("positions"),
            F.col("page_dl").alias("dl"),
        )

    met = postings(ranges.where(F.col("n_ranges") > 1)).groupBy(*keys, "term").agg(
        F.sum("tf").cast("int").alias("tf"),
        F.sort_array(F.flatten(F.collect_list("positions"))).alias("positions"),
        F.max("dl").alias("dl"),
    )
    return postings(ranges.where(F.col("n_ranges") == 1)).unionByName(met)


def field_stats(postings: DataFrame) -> DataFrame:
    """Documents with the field and their mean length.

    Every document has exactly one posting at position 0 of a field, so its
    length is counted there, without bringing its postings together.
    """
    first = postings.where(F.get("positions", F.lit(0)) == 0)
    return first.groupBy("dimension", "field").agg(F.count("*").alias("n_docs"), F.avg("dl").alias("avg_dl"))


def term_stats(postings: DataFrame) -> DataFrame:
    """In how many documents each term occurs."""
    return postings.groupBy("dimension", "field", "term").agg(F.count("*").alias("df"))


def build(docs: DataFrame, fields: Mapping[str, Column], analyzers: AnalyzerSet | None = None) -> TextIndex:
    """A lazy index over documents that hold their text themselves.

    Its statistics come from the terms of each row: whoever asks for them alone does not pay for postings.
    """
    analyzers = analyzers or AnalyzerSet()
    tokenised = tokenise(docs, fields, analyzers)
    lengths = tokenised.groupBy("dimension", "field").agg(
        F.count("*").alias("n_docs"), F.avg(F.size("tokens")).alias("avg_dl")
    )
    distinct = tokenised.select("dimension", "field", F.explode(F.array_distinct("tokens")).alias("term"))
    return TextIndex(invert(tokenised), lengths, term_stats(distinct), analyzers)


def dealt(docs: DataFrame, text: Column) -> DataFrame:
    """``docs`` over as many tasks as keep the postings of each within its memory."""
    docs = spread(docs)
    (characters,) = docs.agg(F.sum(F.length(text))).first()
    tasks = -(-(characters or 0) // TASK_CHARACTERS)
    return docs.repartition(tasks) if tasks > docs.rdd.getNumPartitions() else docs


def lay_out(postings: DataFrame) -> DataFrame:
    """Postings in ranges of (dimension, field, term), so that a term lookup reads few files.

    Ranges also split a very common term over several files.
    """
    return postings.repartitionByRange(*ORDER).sortWithinPartitions(*ORDER)


def save(index: TextIndex, path: str) -> TextIndex:
    """Write the index once and read it back; statistics come from the stored postings.

    Each task puts its own postings in the order of :func:`lay_out`, without a
    shuffle: every file holds all terms, and a lookup reads the few Parquet
    pages of its terms, by the files' page indexes.
    """
    spark = index.postings.sparkSession
    ordered = index.postings.sortWithinPartitions(*ORDER)
    ordered.write.mode("errorifexists").partitionBy("dimension").parquet(f"{path}/postings")
    stored = spark.read.parquet(f"{path}/postings")
    field_stats(stored).write.mode("errorifexists").parquet(f"{path}/field_stats")
    term_stats(stored).repartitionByRange("field", "term").sortWithinPartitions("field", "term").write.mode(
        "errorifexists"
    ).parquet(f"{path}/term_stats")
    return load(spark, path, index.analyzers)


def load(spark: SparkSession, path: str, analyzers: AnalyzerSet | None = None) -> TextIndex:
    return TextIndex(
        spark.read.parquet(f"{path}/postings"),
        spark.read.parquet(f"{path}/field_stats"),
        spark.read.parquet(f"{path}/term_stats"),
        analyzers or AnalyzerSet(),
    )


def stats_change(before: DataFrame, after: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What a batch does to the statistics: (terms, fields), as sums to add.

    ``before`` and ``after`` are the postings of the touched documents only.
    """
    signed = before.withColumn("sign", F.lit(-1)).unionByName(after.withColumn("sign", F.lit(1)))
    terms = signed.groupBy("dimension", "field", "term").agg(F.sum("sign").alias("df")).where(F.col("df") != 0)
    lengths = signed.select("sign", "dimension", "workspace", "doc_id", "field", "dl").distinct()
    fields = lengths.groupBy("dimension", "field").agg(
        F.sum("sign").alias("n_docs"), F.sum(F.col("sign") * F.col("dl")).alias("total_dl")
    )
    return terms, fields


def restrict(index: TextIndex, dimensions: Iterable[str]) -> TextIndex:
    """The index of some dimensions only; a partition filter on the postings."""
    wanted = F.col("dimension").isin(list(dimensions))
    return TextIndex(
        index.postings.where(wanted),
        index.field_stats.where(wanted),
        index.term_stats.where(wanted),
        index.analyzers,
    )
