"""Packing of tokenised documents into few sequences by linear grouping.

Documents of over ``WINDOW`` tokens are cut into full windows, each a sequence
of its own, and a rest. Pieces of over ``SMALL`` tokens are large. In the order
of their lengths they form groups of equal cardinality, and every length counts
as that of the longest in its group, which leaves few sizes. Which configurations
of sizes fill how many sequences is a linear programme over the counts of the
groups, solved by generating columns (a knapsack per step). Its whole parts are
taken; actual pieces then take the places of their sizes, and the few that are
left, with the small pieces, go best-fit, longest first, into the room that is
left, or open new sequences.

The programme reads the histogram of lengths, ``WINDOW`` numbers for a corpus of
any size. Which place a piece takes follows from its rank among the pieces of its
length: counts per task and length are summed up over tasks, nothing is sorted
as a whole. Sequences and loose pieces are dealt into blocks of about
``BLOCK_TOKENS`` tokens for the last step, one block at a time.

Defined results: a null or empty text has the end token only; a row with a null
id is packed like any other; repeated rows are packed each for itself; an empty
table gives an empty result; columns other than id and text are not read; ids
of any type are taken as they are.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from treeseek.llm.packing import WordTokens
from treeseek.llm.rows import column
from treeseek.session import materialise, spread

WINDOW = 2048
END_TOKEN = 0
SMALL = WINDOW // 3
GROUPS = 256
BLOCK_TOKENS = 4_000_000

_TOLERANCE = 1e-9


def best_pattern(sizes: np.ndarray, values: np.ndarray, window: int) -> tuple[np.ndarray, float]:
    """How many of each size to put into a window for the highest sum of values."""
    best = np.zeros(window + 1)
    taken = np.zeros((len(sizes), window + 1), np.int16)
    for i, (size, value) in enumerate(zip(sizes.tolist(), values.tolist())):
        if value <= _TOLERANCE:
            continue
        before = best.copy()
        for times in range(1, window // size + 1):
            offer = before[: window + 1 - times * size] + times * value
            better = offer > best[times * size :] + _TOLERANCE
            best[times * size :][better] = offer[better]
            taken[i, times * size :][better] = times
    pattern, room = np.zeros(len(sizes), np.int64), window
    for i in range(len(sizes) - 1, -1, -1):
        pattern[i] = taken[i, room]
        room -= pattern[i] * sizes[i]
    return pattern, float(best[window])


def configurations(sizes: np.ndarray, demand: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Patterns (one a column) and how often to take each, as fractions, for the fewest windows in all."""
    patterns = np.diag(window // sizes).astype(float)
    inverse = np.diag(1.0 / np.diag(patterns))
    times = inverse @ demand
    for step in range(1, 60 * len(sizes)):
        pattern, value = best_pattern(sizes, inverse.sum(axis=0), window)
        if value <= 1 + 1e-7:
            break
        change = inverse @ pattern
        grows = change > _TOLERANCE
        ratio = np.where(grows, times / np.where(grows, change, 1), np.inf)
        out = int(np.argmin(ratio))
        patterns[:, out] = pattern
        if step % 50:
            row = inverse[out] / change[out]
            inverse -= np.outer(change, row)
            inverse[out] = row
        else:
            inverse = np.linalg.inv(patterns)
        times = np.maximum(inverse @ demand, 0)
    return patterns.astype(np.int64), times


@dataclass
class Plan:
    """Where large pieces go, by length and rank among those of that length."""

    longer: np.ndarray  # how many large pieces are longer, by length
    cardinality: int
    ends: list[np.ndarray]  # of each group, where the places of each configuration end
    each: list[np.ndarray]  # and how many places a sequence of it has
    first: list[np.ndarray]  # and the number of its first sequence
    sequences: int
    small: int
    window: int

    def places(self, lengths: np.ndarray, ranks: np.ndarray) -> np.ndarray:
        """The sequence of each piece; -1 for those without a place."""
        out = np.full(len(lengths), -1, np.int64)
        large = np.flatnonzero((lengths > self.small) & (lengths < self.window))
        if not len(large):
            return out
        position = self.longer[lengths[large]] + ranks[large]
        group, rank = position // self.cardinality, position % self.cardinality
        for g in np.unique(group).tolist():
            ends = self.ends[g]
            if not len(ends):
                continue
            mine = group == g
            at = np.searchsorted(ends, rank[mine], side="right")
            has = at < len(ends)
            at = np.minimum(at, len(ends) - 1)
            within = rank[mine] - np.append(0, ends[:-1])[at]
            out[large[mine]] = np.where(has, self.first[g][at] + within // self.each[g][at], -1)
        return out


def plan(histogram: np.ndarray, window: int = WINDOW, small: int = SMALL, groups: int = GROUPS) -> Plan:
    """From the number of pieces of each length (0 to ``window``)."""
    counts = np.array(histogram, dtype=np.int64)
    counts[: small + 1] = 0
    counts[window] = 0
    total = int(counts.sum())
    longer = total - np.cumsum(counts)
    cardinality = max(1, -(-total // groups))
    n = -(-total // cardinality)
    starts = np.arange(n) * cardinality
    # The longest of a group is the one at its first position.
    sizes = np.array([int(np.flatnonzero((longer <= s) & (s < longer + counts))[0]) for s in starts], dtype=np.int64)
    demand = np.minimum(cardinality, total - starts)
    ends: list[np.ndarray] = [np.zeros(0, np.int64)] * n
    each, first, sequences = list(ends), list(ends), 0
    if n:
        patterns, times = configurations(sizes, demand.astype(float), window)
        whole = np.floor(times + 1e-6).astype(np.int64)
        starts_at = np.cumsum(whole) - whole
        sequences = int(whole.sum())
        for g in range(n):
            used = np.flatnonzero((patterns[g] > 0) & (whole > 0))
            each[g] = patterns[g, used]
            ends[g] = np.cumsum(each[g] * whole[used])
            first[g] = starts_at[used]
    return Plan(longer, cardinality, ends, each, first, sequences, small, window)


def _pieces(texts: DataFrame, tokenizer: str, window: int, end: int) -> DataFrame:
    """id, start, length, ids_crc32, and of each piece the task and its rank in it among those of its length."""
    tail = struct.pack("<I", end)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordTokens(tokenizer)
        seen = [0] * (window + 1)
        task = TaskContext.get().partitionId()
        for batch in batches:
            source, start, length, crc, rank = [], [], [], [], []
            for i, body in enumerate(encoder.encode_batch(batch.column("text").to_pylist())):
                encoded = body + tail
                for at in range(0, len(encoded), 4 * window):
                    part = encoded[at : at + 4 * window]
                    size = len(part) // 4
                    source.append(i)
                    start.append(at // 4)
                    length.append(size)
                    crc.append(zlib.crc32(part))
                    rank.append(seen[size])
                    seen[size] += 1
            arrays = [pa.array(v, pa.int64()) for v in (start, length, crc, [task] * len(start), rank)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(pa.array(source, pa.int64())), *arrays],
                names=["id", "start", "length", "ids_crc32", "task", "rank"],
            )

    schema = texts.select("id", *[F.lit(0).cast("bigint").alias(c) for c in _PLACE]).schema
    return texts.mapInArrow(run, schema)


_PLACE = ("start", "length", "ids_crc32", "task", "rank")


def fill(lengths: list[int], sequences: list[int | None], window: int) -> tuple[list[int], list[int]]:
    """Sequence and offset of each piece; those with a sequence stay there.

    The others go, longest first, where they leave the least room, or open a
    sequence, numbered from -1 downwards.
    """
    placed: list[int] = [0] * len(lengths)
    offsets = [0] * len(lengths)
    used: dict[int, int] = {}
    loose = []
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        sequence = sequences[i]
        if sequence is None:
            loose.append(i)
            continue
        placed[i], offsets[i] = sequence, used.get(sequence, 0)
        used[sequence] = offsets[i] + lengths[i]
    # The open sequences by the room they have; a bit says which rooms there are.
    by_room: list[list[int]] = [[] for _ in range(window + 1)]
    rooms = 0
    for sequence, filled in used.items():
        by_room[window - filled].append(sequence)
        rooms |= 1 << (window - filled)
    opened = 0
    for i in loose:
        fitting = rooms >> lengths[i]
        if fitting:
            room = lengths[i] + (fitting & -fitting).bit_length() - 1
            sequence = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
        else:
            opened += 1
            room, sequence = window, -opened
        placed[i], offsets[i] = sequence, window - room
        left = room - lengths[i]
        if left:
            by_room[left].append(sequence)
            rooms |= 1 << left
    return placed, offsets


def pack(
    docs: DataFrame, tokenizer: str, id_column: str = "doc_id", text_column: str = "text", window: int = WINDOW,
    end: int = END_TOKEN, small: int = SMALL, groups: int = GROUPS, block_tokens: int = BLOCK_TOKENS,
) -> DataFrame:
    """id, piece, start, length, ids_crc32, sequence_id, offset for each piece of ``docs``."""
    spark = docs.sparkSession
    texts = docs.select(column(id_column).alias("id"), column(text_column).alias("text"))
    cut = materialise(
        _pieces(spread(texts), tokenizer, window, end).withColumn("number", F.monotonically_increasing_id()), "pieces"
    )
    # At most ``window`` rows.
    histogram = np.zeros(window + 1, np.int64)
    for row in cut.groupBy("length").count().collect():
        histogram[row["length"]] = row["count"]
    made = plan(histogram, window, small, groups)
    tokens = int((histogram * np.arange(window + 1)).sum())
    blocks = max(1, -(-tokens // block_tokens))

    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    base = cut.groupBy("task", "length").agg(F.count(F.lit(1)).alias("n"))
    base = base.select("task", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    ranked = cut.where(F.col("length") < window).join(base, ["task", "length"]).select(
        "id", "start", "length", "ids_crc32", "number", (F.col("base") + F.col("rank")).alias("rank")
    )
    kind = ranked.schema

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, ranks, numbers = (batch.column(c).to_numpy() for c in ("length", "rank", "number"))
            sequence = made.places(lengths, ranks)
            placed = sequence >= 0
            # Loose pieces of a length are dealt out in turn.
            block = np.where(placed, sequence % blocks, (ranks * 7919 + lengths) % blocks)
            kept = [batch.column(c) for c in kind.names[:-1]]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(sequence, mask=~placed), pa.array(block)], names=[*kind.names[:-1], "sequence", "block"]
            )

    slots = ranked.select(
        *kind.names[:-1], F.lit(None).cast("bigint").alias("sequence"), F.lit(0).cast("bigint").alias("block")
    ).schema
    at = cut.select(
        "id", "start", "length", "ids_crc32", F.lit(0).cast("bigint").alias("sequence_id"),
        F.lit(0).cast("bigint").alias("offset"),
    ).schema
    first_new = made.sequences

    def filled(block: pa.Table) -> pa.Table:
        block = block.sort_by("number")
        sequences, offsets = fill(block.column("length").to_pylist(), block.column("sequence").to_pylist(), window)
        number = block.column("block")[0].as_py()
        # New ones of all blocks take turns in the numbers behind the planned ones.
        ids = [s if s >= 0 else first_new + (-s - 1) * blocks + number for s in sequences]
        out = block.select(["id", "start", "length", "ids_crc32"])
        return out.append_column("sequence_id", pa.array(ids, pa.int64())).append_column(
            "offset", pa.array(offsets, pa.int64())
        )

    tasks = max(1, min(blocks, max(spark.sparkContext.defaultParallelism, blocks // 8)))
    packed = ranked.mapInArrow(dealt, slots).repartition(tasks, "block").groupBy("block").applyInArrow(filled, at)
    whole = cut.where(F.col("length") == window).select(
        "id", "start", "length", "ids_crc32", (-1 - F.col("number")).alias("sequence_id"),
        F.lit(0).cast("bigint").alias("offset"),
    )
    piece = (F.col("start") / window).cast("int").alias("piece")
    return packed.unionByName(whole).select("id", piece, "start", "length", "ids_crc32", "sequence_id", "offset")
