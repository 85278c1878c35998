"""Quality rules: rules on a document's own text, and lines that many documents of a host share.

A document fails on its own if it has too few words or repeats itself. Lines are
then compared across documents: each line, lower-cased, white space reduced and
digits unified, is hashed, and the documents of a host that have it are counted
— copies of a whole document once, so that a document is not boilerplate merely
because it was copied. Lines above the limit are removed; a document that is left with too few
words by it is rejected. ``accepted`` returns the texts without those lines.

Copies that differ in a line or so share all their other lines, which are then
frequent, and would all go. So of the documents that had most of their words in
the same frequent lines, or are depleted by them, two lines at least, the first
one is spared: it is kept whole.

Only hashes and counts are shuffled: a document sends each of its lines once,
summed per task, and what comes back are the frequent lines. They are joined as
Spark sees fit for their number, a line that is in very many documents being
dealt out.

Defined results: null and empty texts have no words and fail; a null host is a
host of its own; a null id changes nothing; repeated rows are judged alike; an
empty table gives an empty result; other columns are carried along untouched.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from treeseek.llm.rows import HOT_ROWS, field, located, sieve, sifted
from treeseek.operators.skew import hot_keys, join_unique
from treeseek.session import materialise, materialise_texts, spread

MIN_WORDS = 20
MAX_REPEATED_PERCENT = 30
WINDOW_WORDS = 8
# A line in more different documents of a host than this is removed.
LINE_DOCUMENTS = 20
# Documents that had more than this share of their words in the same frequent lines count as copies.
DEPLETED_SHARE = 0.5

# Texts whose lines a Python worker holds at once, whatever the size of the Arrow batches.
ROWS_AT_ONCE = 500

_SYMBOLS = re.compile(rb"[#*$%&|<>]")
_DIGITS = re.compile(rb"[0-9]+")
_STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_SCHEMA = (
    "row struct<file string, position bigint>, id bigint, host string, n_words bigint, word_chars bigint, "
    "n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, content bigint, "
    "lines array<struct<line bigint, words int>>"
)


def line_key(tokens: list[bytes]) -> int:
    """The hash of a line, given its words."""
    return xxhash.xxh64_intdigest(_DIGITS.sub(b"0", b" ".join(tokens).lower())) - (1 << 63)


def without_lines(text: str, gone: set[int]) -> str:
    """``text`` without the lines whose hashes are in ``gone``."""
    left = [x for x in text.encode().split(b"\n") if not (tokens := x.split()) or line_key(tokens) not in gone]
    return b"\n".join(left).decode()


@dataclass(frozen=True)
class Limits:
    min_words: int = MIN_WORDS
    max_repeated_percent: int = MAX_REPEATED_PERCENT
    line_documents: int = LINE_DOCUMENTS
    depleted_share: float = DEPLETED_SHARE


def repeated_words(words: list[bytes], width: int = WINDOW_WORDS) -> int:
    """Words that lie in a window of ``width`` words (a power of two) which occurs at least twice."""
    if len(words) <= width:
        return 0
    numbers: dict[bytes, int] = {}
    code = np.array([numbers.setdefault(w, len(numbers)) for w in words], dtype=np.int64)
    # Codes of windows of twice the width come from pairs of codes, so they are exact.
    span = 1
    while span < width:
        pairs = (code[:-span] << 32) | code[span:]
        code = np.unique(pairs, return_inverse=True)[1].astype(np.int64)
        span *= 2
    often = np.bincount(code)[code] > 1
    if not often.any():
        return 0
    edges = np.zeros(len(words) + 1, dtype=np.int64)
    starts = np.flatnonzero(often)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + width, -1)
    return int((np.cumsum(edges[:-1]) > 0).sum())


def examine(text: str | None) -> tuple[dict[str, int], dict[int, int]]:
    """The statistics of a text, and the hash and number of words of each of its different lines.

    A frequent line counts as often as the document has it.
    """
    raw = (text or "").encode()
    words = raw.split()
    seen: set[bytes] = set()
    duplicates = 0
    lines: dict[int, int] = {}
    for line in raw.split(b"\n"):
        tokens = line.split()
        if not tokens:
            continue
        if line in seen:
            duplicates += 1
        seen.add(line)
        key = line_key(tokens)
        lines[key] = lines.get(key, 0) + len(tokens)
    stats = {
        "n_words": len(words),
        "word_chars": len(b"".join(words).decode()),
        "n_symbols": len(_SYMBOLS.findall(raw)),
        "n_dup_lines": duplicates,
        "n_repeat_words": repeated_words(words),
    }
    return stats, lines


def _small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS_AT_ONCE):
            yield batch.slice(start, ROWS_AT_ONCE)


def _examined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    lines_type = pa.list_(pa.struct([("line", pa.int64()), ("words", pa.int32())]))
    for batch in _small(batches):
        stats: dict[str, list[int]] = {name: [] for name in _STATS}
        content, lines = [], []
        for value in batch.column("text"):
            text = value.as_py()
            own, found = examine(text)
            for name in _STATS:
                stats[name].append(own[name])
            content.append(xxhash.xxh64_intdigest(b" ".join((text or "").encode().split())) - (1 << 63))
            lines.append([{"line": k, "words": n} for k, n in found.items()])
        arrays = [batch.column(c) for c in ("row", "id", "host")]
        arrays += [pa.array(stats[name], pa.int64()) for name in _STATS]
        arrays += [pa.array(content, pa.int64()), pa.array(lines, lines_type)]
        yield pa.RecordBatch.from_arrays(arrays, names=["row", "id", "host", *_STATS, "content", "lines"])


def judge(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    host_column: str = "source",
    limits: Limits = Limits(),
    hot: int = HOT_ROWS,
) -> DataFrame:
    """row, id, the statistics, base_failed, removed_words and kept for each row of ``docs``."""
    return _judged(located(docs), id_column, text_column, host_column, limits, hot).drop("spared", "gone")


def _judged(
    placed: DataFrame, id_column: str, text_column: str, host_column: str, limits: Limits, hot: int = HOT_ROWS
) -> DataFrame:
    texts = placed.select(
        "row",
        field(id_column).cast("bigint").alias("id"),
        field(host_column).cast("string").alias("host"),
        field(text_column).alias("text"),
    )
    examined = materialise_texts(spread(texts).mapInArrow(_examined, _SCHEMA), "examined")
    # A null host differs from all names: names get a mark in front.
    host = F.coalesce(F.concat(F.lit("="), "host"), F.lit(""))
    lines = examined.withColumn("line", F.explode("lines")).select(
        "row", "content", F.xxhash64(host, "line.line").alias("key"), F.col("line.words").alias("words"),
        F.col("line.line").alias("line"),
    )
    # Documents with the same words count once: the first step is one row per line and content.
    counted = (
        lines.groupBy("key", "content").agg(F.count(F.lit(1)).alias("rows"))
        .groupBy("key").agg(F.count(F.lit(1)).alias("documents"), F.sum("rows").alias("n"))
        .where(F.col("documents") > limits.line_documents)
    )
    frequent = materialise(counted, "frequent-lines")
    large = hot_keys(frequent.select("key", "n"), ["key"], hot)
    removed = (
        join_unique(lines, frequent.select("key"), ["key"], large, ["row"])
        .groupBy("row")
        .agg(F.sum("words").alias("removed_words"), F.collect_list("line").alias("gone"), F.bit_xor("key").alias("same"))
    )
    base_failed = (F.col("n_words") < limits.min_words) | (
        F.col("n_repeat_words") * 100 > F.col("n_words") * limits.max_repeated_percent
    )
    mostly = F.col("removed_words") > F.col("n_words") * limits.depleted_share
    depleted = (F.col("removed_words") > 0) & (F.col("n_words") - F.col("removed_words") < limits.min_words)
    found = (
        examined.drop("lines", "content")
        .join(removed, "row", "left")
        .withColumn("removed_words", F.coalesce("removed_words", F.lit(0).cast("bigint")))
        .withColumn("base_failed", base_failed)
    )
    found = materialise(found, "removed-lines")
    # The hash of a line's key has the host in it, and so has what they are combined to.
    order = F.struct(F.col("id").isNull(), F.col("id"), F.col("row"))
    copies = found.where(~F.col("base_failed") & (mostly | depleted) & (F.size("gone") > 1))
    spared = copies.groupBy("same").agg(F.min(order).alias("first")).select("first.row", F.lit(True).alias("spared"))
    return (
        found.join(spared, "row", "left")
        .withColumn("spared", F.coalesce("spared", F.lit(False)))
        .withColumn("kept", ~F.col("base_failed") & (~depleted | F.col("spared")))
        .drop("host", "same")
    )


def accepted(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    host_column: str = "source",
    limits: Limits = Limits(),
    length_column: str = "n_chars",
) -> DataFrame:
    """``docs`` without the rejected ones, and without the frequent lines of the others but those spared.

    ``length_column``, if there is one, then has the characters that are left.
    """
    placed = located(docs)
    found = _judged(placed, id_column, text_column, host_column, limits)
    changed = found.where(~F.col("kept") | ((F.col("removed_words") > 0) & ~F.col("spared")))
    changed = materialise(changed.select("row", "kept", "gone"), "changed")
    h = F.xxhash64("row")
    marked = sifted(placed, h, sieve(changed.select(h.alias("h"))))
    clear = marked.where("not maybe").select("doc.*")
    maybe = marked.where("maybe").join(changed, "row", "left").where(F.coalesce("kept", F.lit(True)))
    maybe = maybe.select("doc", field(text_column).alias("text"), "gone")

    def stripped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _small(batches):
            texts = []
            for text, gone in zip(batch.column("text").to_pylist(), batch.column("gone").to_pylist()):
                texts.append(without_lines(text, set(gone)) if gone else None)
            columns = [batch.column("doc"), pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc", "left"])

    cleaned = maybe.mapInArrow(stripped, maybe.select("doc", F.col("text").alias("left")).schema)
    new = {text_column: F.col("left"), length_column: F.length("left")}
    kinds = dict(docs.dtypes)
    columns = [
        F.coalesce(new[c].cast(kinds[c]), field(c)).alias(c) if c in new else field(c).alias(c) for c in docs.columns
    ]
    return clear.unionByName(cleaned.select(*columns))
