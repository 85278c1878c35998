"""Phrase collocations by FM-indexes over word ids.

The words of each language are dealt into shards of bounded size; a shard's text
is its word ids, with 0 between pieces. A shard has a bidirectional FM-index:
the Burrows-Wheeler transforms of its text and of the reversed text, sorted by
as many words as the phrases have. A phrase is an interval in both; extending it
by a word on one side steps into that side's transform and keeps the interval of
the other side in step.

Phrases grow by one word a round. Every shard extends, to the right, what is
frequent in the whole corpus; an extension counts if the phrase without its
first word, one step back in the index, is frequent as well. Counts are then
summed across shards, and what is frequent goes back to the shards that have it.
The sums of the extensions of a phrase tell whether a longer one covers it. A
shard writes the text for the next round without the words that no frequent
phrase covers, so later rounds are small.

A phrase of ``k`` words is known by the numbers of its first and its last
``k - 1`` words, and takes the counts of all its beginnings and ends over from
them. Nothing but statistics of shards and phrases is shuffled; a phrase that
lies in very many shards is dealt out over tasks.

Defined results: null and empty texts have no words; a null language is `und`;
equal texts, repeated rows and null ids count each for itself; a text of any
length lies in one shard; an empty table gives an empty result; columns other
than text and language are not read. Ties in the order of phrases go by count,
then by the phrase itself.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from treeseek.llm.rows import HOT_ROWS, column, sieve, sifted
from treeseek.operators.skew import first_n, hot_keys, join_unique
from treeseek.session import materialise, materialise_texts, spread

LEAST = 100
LONGEST = 5
FIRST = 2000
# A phrase goes if a longer one has at least this share of its occurrences, in percent.
COVERED = 100
# Words of a shard; its index takes some 100 bytes a word in one task while it is sorted.
SHARD_WORDS = 1_500_000
# A task has open shards of all its languages, of so many full ones' words together, 4 bytes a word.
_OPEN = 8

# Phrases of a shard that lie in one row of its tables.
_ROW = 5_000
# Rows of an index that are extended together.
_AT_ONCE = 200_000
# Splits of the input that one task cuts into shards, if there are enough for all cores.
_SPLITS = 4

_BREAK = b"."
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_TO_BREAK = bytes(_BREAK[0] if c in b".,;:!?\n\x0b\x0c\r" else c for c in range(256))
_MAP = bytes(_TO_BREAK[_LOWER[c]] for c in range(256))


def tokens(text: str | None) -> list[bytes]:
    """The words of a text, lower-cased, with a full stop where a piece ends."""
    data = (text or "").encode().translate(_MAP).replace(_BREAK, b" . ").replace(b"\t", b" ")
    return [w for w in data.split(b" ") if w]


@dataclass
class Intervals:
    """Phrases of one length: where their rows start in the forward and in the backward order, and how many there are."""

    forward: np.ndarray
    backward: np.ndarray
    count: np.ndarray


def _dense(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of ``keys``, and for each the number of different smaller ones; 32 bits, as a shard is bounded."""
    order = np.argsort(keys, kind="stable").astype(np.int32)
    in_order = keys[order]
    new = np.append(0, in_order[1:] != in_order[:-1]).astype(np.int32)
    del in_order
    rank = np.empty(len(keys), np.int32)
    rank[order] = np.cumsum(new, dtype=np.int32)
    return order, rank


class _Order:
    """One direction: the rows of a cyclic text sorted by their first ``depth`` symbols, ties by place."""

    def __init__(self, symbols: np.ndarray, depth: int):
        self.symbols = symbols
        n = len(symbols)
        _, single = _dense(symbols)
        rank, done, order = single, 1, None
        while order is None or done < depth:
            step = min(done, depth - done)
            if step < done:
                step = min(step, 1)
            keys = rank
            if step:
                keys = rank.astype(np.int64) * n + np.roll(rank if step == done else single, -done)
            order, rank = _dense(keys)
            done += step
        del rank, single, keys
        self.rows = order
        self.row_of = np.empty(n, np.int32)
        self.row_of[order] = np.arange(n, dtype=np.int32)

    @cached_property
    def transform(self) -> np.ndarray:
        return self.symbols[self.rows - 1]

    @cached_property
    def earlier(self) -> np.ndarray:
        """The row that starts one symbol earlier, in the order of the transform."""
        back = np.argsort(self.transform, kind="stable")
        earlier = np.empty(len(back), np.int32)
        earlier[back] = np.arange(len(back), dtype=np.int32)
        return earlier

    def without_first(self, rows: np.ndarray) -> np.ndarray:
        """The rows that start one symbol later in the text."""
        return self.row_of[(self.rows[rows] + 1) % len(self.rows)]

    def start(self, places: np.ndarray, length: int) -> np.ndarray:
        """The first row of the interval of the phrase of ``length`` symbols at each place of the text."""
        new = np.zeros(len(self.symbols), bool)
        new[:1] = True
        for j in range(length):
            symbol = self.symbols[(self.rows + j) % len(self.symbols)]
            new[1:] |= symbol[1:] != symbol[:-1]
        starts = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
        return starts[self.row_of[places]]


def _ranges(starts: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All rows of intervals, and the number of the interval of each."""
    owner = np.repeat(np.arange(len(starts)), counts)
    within = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    return starts[owner] + within, owner


class BidirectionalIndex:
    """FM-index of ``symbols`` and of their reverse, for phrases of up to ``depth`` symbols.

    ``symbols`` starts and ends with 0, and no phrase holds a 0.
    """

    def __init__(self, symbols: np.ndarray, depth: int):
        self.symbols = symbols
        self.depth = depth
        self.forward = _Order(symbols, depth)
        self.backward = _Order(symbols[::-1], depth)

    def find(self, places: np.ndarray, counts: np.ndarray, length: int) -> Intervals:
        """The intervals of phrases by one place of each."""
        ends = len(self.symbols) - places - length
        return Intervals(self.forward.start(places, length), self.backward.start(ends, length), counts)

    def words(self) -> Intervals:
        """The intervals of single symbols, in their order."""
        found, counts = np.unique(self.symbols, return_counts=True)
        starts = np.cumsum(counts) - counts
        real = found > 0
        return Intervals(starts[real], starts[real], counts[real])

    def places(self, phrases: Intervals) -> np.ndarray:
        """One place of the text for each phrase."""
        return self.forward.rows[phrases.forward]

    def extend_left(self, phrases: Intervals) -> tuple[Intervals, np.ndarray, np.ndarray]:
        """All phrases with one word more in front; which of ``phrases`` each comes from; the word."""
        own, other, count, parent, word = _extended(self.forward, phrases.forward, phrases.backward, phrases.count)
        return Intervals(own, other, count), parent, word

    def extend_right(self, phrases: Intervals) -> tuple[Intervals, np.ndarray, np.ndarray]:
        """The same with one word more behind."""
        own, other, count, parent, word = _extended(self.backward, phrases.backward, phrases.forward, phrases.count)
        return Intervals(other, own, count), parent, word

    def without_first(self, phrases: Intervals) -> np.ndarray:
        """For each phrase a row in the forward interval of the phrase without its first word."""
        return self.forward.without_first(phrases.forward)


def _slices(counts: np.ndarray) -> Iterator[slice]:
    """Runs of phrases with about ``_AT_ONCE`` rows together, so that the memory of a step is bounded."""
    upto = np.cumsum(counts)
    start = 0
    while start < len(counts):
        done = upto[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(upto, done + _AT_ONCE, side="right")))
        yield slice(start, end)
        start = end


def _extended(side: _Order, starts: np.ndarray, others: np.ndarray, counts: np.ndarray):
    """Of all extensions: rows in ``side``, rows in the other order, counts, the phrase extended, the word."""
    found = [(np.zeros(0, np.int64),) * 5]
    for part in _slices(counts):
        own, other, size, parent, word = _extended_part(side, starts[part], others[part], counts[part])
        found.append((own, other, size, parent + part.start, word))
    return tuple(np.concatenate(x) for x in zip(*found))


def _extended_part(side: _Order, starts: np.ndarray, others: np.ndarray, counts: np.ndarray):
    rows, owner = _ranges(starts, counts)
    symbol = side.transform[rows].astype(np.int64)
    key = owner * (int(symbol.max(initial=0)) + 1) + symbol
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
    size = np.diff(np.append(first, len(key)))
    lead = order[first]
    parent, word = owner[lead], symbol[lead]
    # Rows of the other order that continue with smaller symbols come first.
    smaller = first - (np.cumsum(counts) - counts)[parent] if len(first) else first
    real = word > 0
    return side.earlier[rows[lead]][real], (others[parent] + smaller)[real], size[real], parent[real], word[real]


def _packed(symbols: np.ndarray) -> bytes:
    # The low bytes of all numbers first, the high ones, which are mostly 0, last.
    return zlib.compress(symbols.astype("<i4").view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def _unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<i4").ravel()


class _Shard:
    def __init__(self, lang: str):
        self.lang = lang
        self.ids: defaultdict[bytes, int] = defaultdict()
        self.ids.default_factory = self.ids.__len__
        self.ids[_BREAK] = 0
        self.parts: list[np.ndarray] = []
        self.size = 0

    def add(self, words: list[bytes]) -> None:
        known = self.ids
        part = np.array([known[w] for w in words] + [0], dtype=np.int32)
        self.parts.append(part)
        self.size += len(part)

    def closed(self) -> tuple[np.ndarray, dict[str, object]]:
        """Its text, and of each word: words, at (one place), n (how often)."""
        text = np.concatenate([np.zeros(1, np.int32), *self.parts])
        # Only the break has number 0; the others count from 1 as they come.
        count = np.bincount(text)
        first = np.empty(len(count), np.int32)
        first[text[::-1]] = np.arange(len(text) - 1, -1, -1, dtype=np.int32)
        words = [w.decode() for w in self.ids if w != _BREAK]
        return text, {"words": words, "at": first[1:], "n": count[1:].astype(np.int32)}


_WORDS = pa.schema(
    {
        "shard": pa.int64(), "lang": pa.string(), "is_text": pa.bool_(), "text": pa.binary(),
        "words": pa.list_(pa.string()), "at": pa.list_(pa.int32()), "n": pa.list_(pa.int32()),
    }
)
_PHRASES = pa.schema(
    {
        "shard": pa.int64(), "lang": pa.string(), "is_text": pa.bool_(), "text": pa.binary(),
        "at": pa.list_(pa.int32()), "n": pa.list_(pa.int32()), "head": pa.list_(pa.int64()),
        "tail": pa.list_(pa.int64()),
    }
)
_WORDS_DDL = (
    "shard bigint, lang string, is_text boolean, text binary, words array<string>, at array<int>, n array<int>"
)
_PHRASES_DDL = (
    "shard bigint, lang string, is_text boolean, text binary, at array<int>, n array<int>, "
    "head array<bigint>, tail array<bigint>"
)


def _rows(schema: pa.Schema, shard: int, lang: str, text: np.ndarray, lists: dict[str, object]) -> Iterator[pa.RecordBatch]:
    """A shard's text in one row, and its phrases in rows of bounded length."""
    rows = [{"text": _packed(text)}]
    rows += [{k: v[i : i + _ROW] for k, v in lists.items()} for i in range(0, len(lists["n"]), _ROW)]
    for row in rows:
        row |= {"shard": shard, "lang": lang, "is_text": "text" in row}
        yield pa.RecordBatch.from_arrays([pa.array([row.get(f.name)], f.type) for f in schema], schema=schema)


def _fewer_tasks(texts: DataFrame) -> DataFrame:
    """A scan of many small splits over fewer tasks, without a shuffle: a task leaves one unfilled shard a language.

    The phrases that shards have to be told grow with the number of shards.
    """
    cores = texts.sparkSession.sparkContext.defaultParallelism
    return texts.coalesce(max(2 * cores, texts.rdd.getNumPartitions() // _SPLITS))


def _shards(texts: DataFrame, shard_words: int) -> DataFrame:
    """lang and text cut into shards."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_shards: dict[str, _Shard] = {}
        # Numbers of shards, those of a task apart from all others.
        number = TaskContext.get().partitionId() << 33
        total = 0
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
                words = tokens(text.as_py())
                if not words:
                    continue
                shard = open_shards.setdefault(lang, _Shard(lang))
                shard.add(words)
                total += len(words) + 1
                if shard.size >= shard_words or total >= _OPEN * shard_words:
                    # Many languages share the memory of one task.
                    shard = open_shards.pop(max(open_shards, key=lambda k: open_shards[k].size))
                    total -= shard.size
                    yield from _rows(_WORDS, number, shard.lang, *shard.closed())
                    number += 1
        while open_shards:
            lang, shard = open_shards.popitem()
            yield from _rows(_WORDS, number, lang, *shard.closed())
            number += 1

    return texts.mapInArrow(run, _WORDS_DDL)


def _grown(length: int):
    """From shards with their phrases of ``length`` words to shards with those of one word more."""

    def covered(text: np.ndarray, index: BidirectionalIndex, phrases: Intervals) -> np.ndarray:
        kept = np.zeros(len(text), bool)
        for part in _slices(phrases.count):
            rows, _ = _ranges(phrases.forward[part], phrases.count[part])
            places = index.forward.rows[rows]
            for j in range(length):
                kept[places + j] = True
        return kept

    def run(key, states: pa.Table, frequent: pa.Table) -> pa.Table:
        if not len(frequent):
            return _PHRASES.empty_table()
        text = _unpacked(states.column("text")[0].as_py())
        at, count, ids = (np.array(frequent.column(c), dtype=np.int64) for c in ("at", "n", "id"))
        index = BidirectionalIndex(text, length + 1)
        phrases = index.find(at, count, length)
        # In the order of their rows, so that a row is looked up by bisection.
        order = np.argsort(phrases.forward)
        phrases = Intervals(phrases.forward[order], phrases.backward[order], phrases.count[order])
        ids = ids[order]
        found = []
        for part in _slices(phrases.count):
            some = Intervals(phrases.forward[part], phrases.backward[part], phrases.count[part])
            longer, parent, _ = index.extend_right(some)
            shorter = index.without_first(longer)
            end = np.searchsorted(phrases.forward, shorter, side="right") - 1
            known = (end >= 0) & (shorter < phrases.forward[end] + phrases.count[end])
            longer = Intervals(longer.forward[known], longer.backward[known], longer.count[known])
            values = (index.places(longer), longer.count.astype(np.int32), ids[part][parent[known]], ids[end[known]])
            found.append(values)
        places, counts, head, tail = (np.concatenate(x) for x in zip(*found))
        # A phrase of the next round lies where this round's frequent ones lie.
        kept = covered(text, index, phrases)
        gap = ~kept & np.append(True, kept[:-1])
        moved = np.cumsum(kept | gap, dtype=np.int32) - 1
        text = np.append(np.where(kept, text, 0)[kept | gap], 0)
        lists = {"at": moved[places], "n": counts, "head": head, "tail": tail}
        shard, lang = (states.column(c)[0].as_py() for c in ("shard", "lang"))
        return pa.Table.from_batches(_rows(_PHRASES, shard, lang, text, lists), schema=_PHRASES)

    return run


def _occurring(state: DataFrame, *lists: str) -> DataFrame:
    """The phrases of each shard, one a row."""
    return state.where("not is_text").select("shard", "lang", F.inline(F.arrays_zip("at", "n", *lists)))


def _frequent(found: DataFrame, keys: list[str], least: int) -> DataFrame:
    summed = found.groupBy(*keys).agg(F.sum("n").alias("f"), F.count(F.lit(1)).alias("shards"))
    return materialise(
        summed.where(F.col("f") >= least).withColumn("id", F.monotonically_increasing_id()), "phrase-counts"
    )


def _in_shards(found: DataFrame, frequent: DataFrame, keys: list[str], hot: int) -> DataFrame:
    """home (their shard), at, n and id of the frequent phrases of each shard."""
    h = F.xxhash64(*keys)
    bits = materialise(sieve(frequent.select(h.alias("h"))), "frequent")
    passed = sifted(found, h, bits).where("maybe").select("shard", "at", "n", *keys)
    large = hot_keys(frequent.select(*keys, F.col("shards").alias("n")), keys, hot)
    return join_unique(passed, frequent.select(*keys, "id"), keys, large, ["shard"]).select(
        F.col("shard").alias("home"), "at", "n", "id"
    )


def _joined(phrases: DataFrame, shorter: DataFrame, end: str, hot: int, **values: Column) -> DataFrame:
    """``phrases`` with values of the phrase that is their ``head`` or ``tail``."""
    counts = phrases.groupBy(end).agg(F.count(F.lit(1)).alias("n"))
    right = shorter.select(F.col("id").alias(end), *[v.alias(k) for k, v in values.items()])
    return join_unique(phrases, right, [end], hot_keys(counts, [end], hot), ["id"])


def phrases(
    docs: DataFrame, text_column: str = "text", lang_column: str = "lang", least: int = LEAST, longest: int = LONGEST,
    shard_words: int = SHARD_WORDS, hot: int = HOT_ROWS,
) -> tuple[DataFrame, list[DataFrame]]:
    """Words per language (lang, n), and a table of the frequent phrases of each number of words.

    id, lang, phrase, last (its last word), f, head and tail (ids of the phrase
    without its last and first word), heads and tails (counts of its beginnings
    and ends of one word and more).
    """
    lang = F.coalesce(column(lang_column).cast("string"), F.lit("und")).alias("lang")
    texts = docs.select(lang, column(text_column).alias("text"))
    state = materialise_texts(_shards(_fewer_tasks(spread(texts)), shard_words), "shards")
    shards = state.where("is_text").count()
    tasks = max(docs.sparkSession.sparkContext.defaultParallelism, shards // 2, 1)

    found = _occurring(state, "words").withColumnRenamed("words", "word")
    totals = materialise(
        state.where("not is_text")
        .select("lang", F.aggregate("n", F.lit(0).cast("bigint"), lambda a, b: a + b).alias("n"))
        .groupBy("lang").agg(F.sum("n").alias("n")),
        "words",
    )
    frequent = _frequent(found, ["lang", "word"], least)
    none = F.array().cast("array<bigint>")
    level = frequent.select(
        "id", "lang", F.col("word").alias("phrase"), F.col("word").alias("last"), "f",
        F.lit(None).cast("bigint").alias("head"), F.lit(None).cast("bigint").alias("tail"),
        none.alias("heads"), none.alias("tails"),
    )
    levels = [level]
    keys = ["lang", "word"]
    for length in range(1, longest):
        here = _in_shards(found, frequent, keys, hot)
        bodies = state.where("is_text").select("shard", "lang", "text").repartition(tasks, "shard").groupBy("shard")
        grown = bodies.cogroup(here.repartition(tasks, "home").groupBy("home"))
        grown = grown.applyInArrow(_grown(length), _PHRASES_DDL)
        state = materialise(grown, "shards")
        found, keys = _occurring(state, "head", "tail"), ["head", "tail"]
        frequent = _frequent(found, keys, least)
        longer = _joined(
            frequent.select("id", "f", "head", "tail"), level, "head", hot, lang=F.col("lang"),
            phrase=F.col("phrase"), heads=F.concat("heads", F.array("f")),
        )
        longer = _joined(longer, level, "tail", hot, last=F.col("last"), tails=F.concat("tails", F.array("f")))
        level = materialise(
            longer.withColumn("phrase", F.concat_ws(" ", "phrase", "last")).select(*level.columns), "phrases"
        )
        levels.append(level)
    return totals, levels


def collocations(
    docs: DataFrame, text_column: str = "text", lang_column: str = "lang", least: int = LEAST, longest: int = LONGEST,
    first: int = FIRST, covered: int = COVERED, shard_words: int = SHARD_WORDS, hot: int = HOT_ROWS,
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the ``first`` phrases of each language by score."""
    totals, levels = phrases(docs, text_column, lang_column, least, longest, shard_words, hot)
    kept = []
    for level, longer in zip(levels[1:], [*levels[2:], None]):
        own = level.select("id", "lang", "phrase", F.col("f").alias("a"), "heads", "tails")
        if longer is not None:
            # The counts of the extensions to the right (by head) and to the left (by tail).
            most = (
                longer.select(F.col("head").alias("id"), "f").unionByName(longer.select(F.col("tail").alias("id"), "f"))
                .groupBy("id").agg(F.max("f").alias("most"))
            )
            own = own.join(most, "id", "left").where(f"coalesce(100 * most < {covered} * a, true)").drop("most")
        kept.append(own.drop("id"))
    found = kept[0]
    for frame in kept[1:]:
        found = found.unionByName(frame)
    # Few rows, one a language.
    found = found.join(totals, "lang")
    # The rest behind the first k words has size - k of them. Products fit 38 digits.
    wide = "cast({} as decimal(38, 0))".format
    score = f"({wide(1000)} * {wide('a')} * {wide('n')}) div ({wide('c.l')} * {wide('c.r')})"
    cuts = (
        "transform(sequence(1, size(heads)), "
        "k -> struct(k, element_at(heads, k) as l, element_at(tails, size(tails) + 1 - k) as r))"
    )
    lowest = f"array_min(transform({cuts}, c -> struct({score} as score, c.k as k, c.l as l, c.r as r)))"
    scored = found.withColumn("cut", F.expr(lowest)).select(
        "lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score"
    )
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    best = first_n(scored, ["lang"], order, first, ["phrase"])
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("bigint")
    return best.select("lang", rank.alias("rank"), "phrase", "a", "l", "r", "n", "score")
