"""Substring deduplication by sliding spans of sentences.

Every run of ``SPAN`` consecutive sentences, or more if short, is hashed (128 bits). Of spans that
occur more than once in the corpus, the first occurrence — smallest document id,
then place — stays, and sentences that any other occurrence covers are removed.
A sentence ends at a full stop, exclamation or question mark with white space
behind it, or at a line's end, and goes as a whole or not at all. Only one of
more than ``LONGEST`` words is divided, at words that the text itself chooses: of
any ``PART`` words in a row, the one with the smallest hash. What stands before
a passage does not move these cuts, but for the first and last words of it, so
that a passage without full stops has the same parts in every document. A
passage that begins and ends within sentences loses the sentences between; those
of which it has a part only stay. Two sentences make a span, since one of 51
words may have no third as a whole. Case and white space do not matter; a span
of fewer than ``MIN_WORDS`` words takes in the sentences behind it.

Counts of hashes are all that the whole corpus shuffles. The repeated ones fill
a sieve of bounded size; only what it lets through is compared by place, a
passage that very many documents share being dealt out over tasks. Texts are
shuffled only for documents that lose sentences.

Defined results: a null text has no sentences and stays null; documents with
fewer sentences than a span stay whole; a null id comes after all others; equal
rows are told apart by their place; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from treeseek.llm.rows import HOT_ROWS, field, located, sieve, sifted
from treeseek.operators.skew import hot_keys, join_unique
from treeseek.session import materialise, spread

SPAN = 2
LONGEST = 24
PART = 16
MIN_WORDS = 12

# Spans that a task holds before it passes them on; one text may have more.
_SPANS_AT_ONCE = 100_000

_END = re.compile(r"[.!?]+[ \t\n\x0b\x0c\r]+|\n+")
_WORD = re.compile(r"[^ \t\n\x0b\x0c\r]+")


def cuts(words: list[bytes], part: int) -> list[int]:
    """The numbers of the words before which a long sentence is cut: no ``part`` words in a row are without one."""
    draws = [_draw(w) for w in words]
    found: list[int] = []
    last = -1
    for end in range(part, len(words)):
        first = end - part + 1
        if last < first:
            last = first
            for i in range(first + 1, end + 1):
                if draws[i] <= draws[last]:
                    last = i
        elif draws[end] <= draws[last]:
            last = end
        else:
            continue
        found.append(last)
    return found


@lru_cache(maxsize=100_000)
def _draw(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word)


def sentences(text: str, longest: int = LONGEST, part: int = PART) -> list[tuple[int, int, list[bytes]]]:
    """Start, end and lower-cased words of each sentence; together they are the whole text."""
    out: list[tuple[int, int, list[bytes]]] = []
    low = _lower(text)
    ends = [m.end() for m in _END.finditer(low)]
    if not ends or ends[-1] < len(low):
        ends.append(len(low))
    start = 0
    for end in ends:
        words = low[start:end].encode().split()
        if not words:
            if out:
                out[-1] = (out[-1][0], end, out[-1][2])
                start = end
            continue
        if len(words) <= longest:
            out.append((start, end, words))
        else:
            places = [m.start() for m in _WORD.finditer(low, start, end)]
            at = [0, *cuts(words, part), len(words)]
            edges = [start, *[places[i] for i in at[1:-1]], end]
            out += [(edges[k], edges[k + 1], words[at[k] : at[k + 1]]) for k in range(len(at) - 1)]
        start = end
    return out


def _lower(text: str) -> str:
    """Lower-cased, character by character where a letter would become two."""
    low = text.lower()
    if len(low) == len(text):
        return low
    return "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def span_hashes(
    parts: list[tuple[int, int, list[bytes]]], span: int, least: int
) -> tuple[list[int], list[bytes]]:
    """The sentences at which a span starts, and its hash of 16 bytes; none where too few words follow."""
    texts = [b" ".join(words) for _, _, words in parts]
    ends = span_ends([len(words) for _, _, words in parts], span, least)
    starts = [i for i, end in enumerate(ends) if end is not None]
    return starts, [xxhash.xxh3_128_digest(b" ".join(texts[i : ends[i]])) for i in starts]


def span_ends(counts: list[int], span: int, least: int) -> list[int | None]:
    """Where the span that starts at each sentence ends: after ``span`` sentences, or as many more as ``least`` words take."""
    out: list[int | None] = []
    end = words = 0
    for i in range(len(counts) - span + 1):
        while end < len(counts) and (end < i + span or words < least):
            words += counts[end]
            end += 1
        out.append(end if words >= least else None)
        words -= counts[i]
    return out


def repeated(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", span: int = SPAN, least: int = MIN_WORDS,
    hot: int = HOT_ROWS,
) -> DataFrame:
    """row and ``starts``, the sentences at which a non-first repeated span starts, for rows that have one."""
    return _repeated(located(docs), id_column, text_column, span, least, hot)


def _repeated(
    placed: DataFrame, id_column: str, text_column: str, span: int, least: int, hot: int = HOT_ROWS
) -> DataFrame:
    texts = placed.select("row", field(id_column).cast("bigint").alias("id"), field(text_column).alias("text"))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.struct([("at", pa.int32()), ("h", pa.int64()), ("g", pa.int64())])

        def packed(part: pa.RecordBatch, sizes: list[int], at: list[int], hashes: list[bytes]) -> pa.RecordBatch:
            halves = np.frombuffer(b"".join(hashes), "<i8").reshape(-1, 2)
            columns = [pa.array(at, pa.int32()), pa.array(halves[:, 0].copy()), pa.array(halves[:, 1].copy())]
            offsets = pa.array(np.cumsum([0, *sizes]), pa.int32())
            spans = pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(columns, fields=list(kind)))
            return pa.RecordBatch.from_arrays([part.column("row"), part.column("id"), spans], names=["row", "id", "spans"])

        for batch in batches:
            first, sizes, at, hashes = 0, [], [], []
            for text in batch.column("text"):
                starts, found = span_hashes(sentences(text.as_py() or ""), span, least)
                sizes.append(len(starts))
                at += starts
                hashes += found
                if len(at) >= _SPANS_AT_ONCE:
                    yield packed(batch.slice(first, len(sizes)), sizes, at, hashes)
                    first, sizes, at, hashes = first + len(sizes), [], [], []
            if sizes:
                yield packed(batch.slice(first, len(sizes)), sizes, at, hashes)

    schema = "row struct<file string, position bigint>, id bigint, spans array<struct<at int, h bigint, g bigint>>"
    found = spread(texts).mapInArrow(hashed, schema).withColumn("number", F.monotonically_increasing_id())
    found = materialise(found, "spans")
    spans = found.select("id", "number", F.inline("spans"))
    often = spans.groupBy("h", "g").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    bits = materialise(sieve(often.select(F.xxhash64("h", "g").alias("h"))), "repeated-spans")
    # All occurrences of a repeated span pass the sieve.
    passed = sifted(spans, F.xxhash64("h", "g"), bits).where("maybe").drop("maybe")
    place = F.struct(F.col("id").isNull().alias("unnamed"), "id", "number", "at")
    firsts = materialise(
        passed.groupBy("h", "g").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1"),
        "first-spans",
    )
    large = hot_keys(firsts.select("h", "g", "n"), ["h", "g"], hot)
    later = join_unique(passed, firsts.drop("n"), ["h", "g"], large, ["number", "at"]).where(
        (F.col("first.number") != F.col("number")) | (F.col("first.at") != F.col("at"))
    )
    starts = later.groupBy("number").agg(F.collect_set("at").alias("starts"))
    return found.select("number", "row").join(starts, "number").drop("number")


_OUT = (
    "id bigint, n_sentences bigint, n_removed bigint, removed array<struct<start: bigint, end: bigint>>, text string"
)


def remove_repeated(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", span: int = SPAN, least: int = MIN_WORDS
) -> DataFrame:
    """id, n_sentences, n_removed, removed (ranges of characters) and the text that is left, for each row."""
    placed = located(docs)
    starts = materialise(_repeated(placed, id_column, text_column, span, least), "removals")
    texts = placed.select("row", field(id_column).cast("bigint").alias("id"), field(text_column).alias("text"))
    marked = sifted(texts, F.xxhash64("row"), sieve(starts.select(F.xxhash64("row").alias("h"))))
    none = F.lit(None).cast("array<int>").alias("starts")
    whole = marked.where("not maybe").select("id", "text", none)
    cut = marked.where("maybe").join(starts, "row", "left").select("id", "text", "starts")

    def removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            counts, gone, ranges, left = [], [], [], []
            for text, starts in zip(batch.column("text"), batch.column("starts")):
                text = text.as_py()
                parts = sentences(text or "")
                ends = span_ends([len(words) for _, _, words in parts], span, least) if starts.is_valid else []
                covered = {i for s in starts.as_py() or () for i in range(s, ends[s])}
                counts.append(len(parts))
                gone.append(len(covered))
                ranges.append([{"start": parts[i][0], "end": parts[i][1]} for i in sorted(covered)])
                if covered:
                    text = "".join(text[a:b] for i, (a, b, _) in enumerate(parts) if i not in covered)
                left.append(text)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"), pa.array(counts, pa.int64()), pa.array(gone, pa.int64()),
                    pa.array(ranges, kind), pa.array(left, pa.string()),
                ],
                names=["id", "n_sentences", "n_removed", "removed", "text"],
            )

    return whole.unionByName(cut).mapInArrow(removed, _OUT)
