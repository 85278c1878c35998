"""Language identification: whole words first, shorter and shorter character n-grams for the rest.

Counts of words per language are taken over all training documents, and counts
of character n-grams over those words. The model keeps the ``WORDS`` most
frequent words of each language and the ``GRAMS`` most frequent n-grams of each
length, ties by hash, so its size is bounded whatever the corpus; it is broadcast.

A word that the model knows scores by its logarithmic frequency in each
language. An unknown word falls back to its n-grams of the greatest length of
which it has a known one, and scores by their mean; an unknown n-gram of that
length counts with the smallest frequency. The languages' sums over all words
of a text decide, and the score is the winner's share after soft-max over means
per word.

Defined results: a null text and one without letters is ``und`` with score 0;
without any training text every text is ``und``; words none of whose characters
is known leave the languages as they are, equal sums going to the first language
in order; null languages and texts are not learned from; repeated rows are
counted as often as they occur; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from treeseek.llm.rows import column
from treeseek.session import materialise, spread

WORDS = 20_000
GRAMS = 5_000
LONGEST = 4
# Words that only one document has in training say little; n-grams speak for them.
MIN_COUNT = 2
UNKNOWN = "und"
# Items that tie where a limit falls are counted in two to this many slices.
_SLICE_BITS = 12
# Texts' unknown words whose scores a task keeps; the memory is bounded by it, results are the same.
_CACHED = 200_000

_WORD = re.compile(r"[^\W\d_]+")


@dataclass(frozen=True)
class Model:
    """Languages in order; for each known word or n-gram, its log frequency in each of them."""

    languages: tuple[str, ...]
    words: dict[str, np.ndarray]
    grams: tuple[dict[str, np.ndarray], ...]  # by length, from 1
    floors: tuple[np.ndarray, ...]  # of an n-gram that is not known, by length

    def word(self, word: str) -> np.ndarray | None:
        known = self.words.get(word)
        if known is not None:
            return known
        padded = f" {word} "
        for length in range(len(self.grams), 0, -1):
            places, scores = self._gram_rows[length - 1]
            text = padded if length > 1 else word
            rows = [places.get(text[i : i + length], 0) for i in range(len(text) - length + 1)]
            if any(rows):
                return scores[rows].sum(axis=0) / len(rows)
        return None

    @cached_property
    def _gram_rows(self) -> list[tuple[dict[str, int], np.ndarray]]:
        """By length: the row of each known n-gram, and the rows; the first one is that of all others."""
        return [
            ({gram: i for i, gram in enumerate(table, 1)}, np.array([floor, *table.values()]))
            for table, floor in zip(self.grams, self.floors)
        ]


def words_of(text: str) -> list[str]:
    """Runs of letters; digits of other kinds that stand in such a run do not make a word by themselves."""
    return [w for w in _WORD.findall(text.lower()) if w.isalpha() or any(c.isalpha() for c in w)]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words of a batch by language: counts are summed up before the shuffle."""
    for batch in batches:
        counts: dict[str, Counter] = {}
        for lang, text in zip(batch.column("lang"), batch.column("text")):
            counts.setdefault(lang.as_py(), Counter()).update(words_of(text.as_py()))
        rows = [(lang, word, n) for lang, words in counts.items() for word, n in words.items()]
        langs, words, numbers = zip(*rows) if rows else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(langs, pa.string()), pa.array(words, pa.string()), pa.array(numbers, pa.int64())],
            names=["lang", "word", "n"],
        )


def word_counts(training: DataFrame) -> DataFrame:
    """From (lang, text): lang, word, n over all of it."""
    texts = training.where("lang is not null and text is not null").select("lang", "text")
    counted = spread(texts).mapInArrow(_counted, "lang string, word string, n bigint")
    return counted.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def _most(counts: DataFrame, keys: list[str], item: str, keep: int) -> DataFrame:
    """The most frequent items per key, ``keep`` at most; of those that tie where the limit falls, the first by hash.

    The limit comes from how many items have each frequency. The items of the
    frequency that straddles it are counted by the first bits of their hash,
    and only those of the slice in which the last place falls are ranked. So
    the items of a language never meet in one task.
    """
    names = [*keys, "n"]
    sizes = counts.groupBy(*names).agg(F.count(F.lit(1)).alias("items"))
    above = F.sum("items").over(Window.partitionBy(*keys).orderBy(F.desc("n"))) - F.col("items")
    classes = sizes.withColumn("room", F.lit(keep) - above).where("room > 0")
    classes = classes.select(*names, "room", (F.col("items") <= F.col("room")).alias("whole"))
    placed = counts.join(classes, names)
    fits = placed.where("whole").select(counts.columns)

    hashed = placed.where("not whole").withColumn("hash", F.xxhash64(item))
    hashed = hashed.withColumn("slice", F.shiftrightunsigned("hash", 64 - _SLICE_BITS))
    slices = hashed.groupBy(*keys, "slice").agg(F.count(F.lit(1)).alias("items"))
    before = F.sum("items").over(Window.partitionBy(*keys).orderBy("slice")) - F.col("items")
    tied = hashed.join(slices.withColumn("before", before), [*keys, "slice"])
    room = F.col("room") - F.col("before")
    early = tied.where(F.col("items") <= room).select(counts.columns)
    rank = F.row_number().over(Window.partitionBy(*keys, "slice").orderBy("hash", item))
    last = tied.where((room > 0) & (F.col("items") > room)).withColumn("rank", rank).where(F.col("rank") <= room)
    return fits.unionByName(early).unionByName(last.select(counts.columns))


def fit(training: DataFrame, words: int = WORDS, grams: int = GRAMS, longest: int = LONGEST) -> Model:
    """Learn from (lang, text). What comes to the driver is the model, whose size the parameters bound."""
    counts = materialise(word_counts(training), "word-counts")
    totals = {r["lang"]: r["n"] for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    languages = tuple(sorted(totals))
    known = _most(counts.where(F.col("n") >= MIN_COUNT), ["lang"], "word", words).collect()

    lengths = F.explode(F.sequence(F.lit(1), F.lit(longest))).alias("length")
    padded = F.when(F.col("length") > 1, F.concat(F.lit(" "), "word", F.lit(" "))).otherwise(F.col("word"))
    starts = F.sequence(F.lit(1), F.length("text") - F.col("length") + 1)
    gram_counts = (
        counts.select("lang", "word", "n", lengths)
        .select("lang", "length", "n", padded.alias("text"))
        .where(F.length("text") >= F.col("length"))
        .select("lang", "length", "n", "text", F.explode(starts).alias("start"))
        .groupBy("lang", "length", F.expr("substring(text, start, length)").alias("gram"))
        .agg(F.sum("n").alias("n"))
    )
    gram_counts = materialise(gram_counts, "gram-counts")
    gram_totals = {
        (r["lang"], r["length"]): r["n"]
        for r in gram_counts.groupBy("lang", "length").agg(F.sum("n").alias("n")).collect()
    }
    top = _most(gram_counts, ["lang", "length"], "gram", grams).collect()

    def table(rows: list[tuple[str, str, int]], total: dict[str, int]) -> tuple[dict[str, np.ndarray], np.ndarray]:
        # One floor for all languages: what is not known must not speak for the one with the smallest corpus.
        floor = np.full(len(languages), math.log(0.5 / max(1, *total.values(), 1)))
        at = {lang: i for i, lang in enumerate(languages)}
        out: dict[str, np.ndarray] = {}
        for lang, item, n in rows:
            out.setdefault(item, floor.copy())[at[lang]] = math.log(n / total[lang])
        return out, floor

    by_length = [
        table(
            [(r["lang"], r["gram"], r["n"]) for r in top if r["length"] == length],
            {lang: gram_totals.get((lang, length), 0) for lang in languages},
        )
        for length in range(1, longest + 1)
    ]
    known_words, _ = table([(r["lang"], r["word"], r["n"]) for r in known], totals)
    return Model(languages, known_words, tuple(t for t, _ in by_length), tuple(f for _, f in by_length))


class _Table:
    """Scores of words as rows of one matrix: the model's words, and behind them unknown ones that texts had.

    Of these, ``_CACHED`` stay between texts; those of a single text all have a row while it is scored.
    """

    def __init__(self, model: Model):
        self._model = model
        self._known = {word: i for i, word in enumerate(model.words)}
        self._met: dict[str, int] = {}
        self._used = len(self._known)
        self.scores = np.empty((max(self._used, 1), len(model.languages)))
        for word, i in self._known.items():
            self.scores[i] = model.words[word]

    def rows(self, counts: Counter) -> tuple[list[int], list[int]]:
        """Rows of the words that have scores, and how often each stands."""
        if len(self._met) >= _CACHED:
            self._met.clear()
            self._used = len(self._known)
        rows, times = [], []
        for word, n in counts.items():
            row = self._known.get(word)
            if row is None:
                row = self._met.get(word)
                if row is None:
                    row = self._add(word)
            if row >= 0:
                rows.append(row)
                times.append(n)
        return rows, times

    def _add(self, word: str) -> int:
        vector = self._model.word(word)
        if vector is None:
            self._met[word] = -1
            return -1
        if self._used == len(self.scores):
            self.scores = np.concatenate([self.scores, np.empty_like(self.scores)])
        row = self._met[word] = self._used
        self.scores[row] = vector
        self._used += 1
        return row


def predict(spark: SparkSession, docs: DataFrame, model: Model, text_column: str = "text") -> DataFrame:
    """``docs`` with its text replaced by ``lang_pred`` and ``score``."""
    rest = [c for c in docs.columns if c != text_column]
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        table = _Table(model)

        def scores(text: str | None) -> tuple[str, float]:
            counts = Counter(words_of(text or ""))
            if not counts or not model.languages:
                return UNKNOWN, 0.0
            rows, times = table.rows(counts)
            if not rows:
                return model.languages[0], 1.0 / len(model.languages)
            mean = np.array(times, dtype=float) @ table.scores[rows] / sum(times)
            best = int(mean.argmax())
            return model.languages[best], float(1.0 / np.exp(mean - mean[best]).sum())

        for batch in batches:
            predicted = [scores(t.as_py()) for t in batch.column(text_column)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in rest]
                + [
                    pa.array([p for p, _ in predicted], pa.string()),
                    pa.array([s for _, s in predicted], pa.float64()),
                ],
                names=[*rest, "lang_pred", "score"],
            )

    empty = [F.lit("").alias("lang_pred"), F.lit(0.0).alias("score")]
    return spread(docs).mapInArrow(run, docs.select(*rest, *empty).schema)


def identify(
    spark: SparkSession,
    docs: DataFrame,
    learns,
    id_column: str = "doc_id",
    text_column: str = "text",
    lang_column: str = "lang",
) -> DataFrame:
    """Learn from the rows of ``docs`` for which the condition ``learns`` holds; id, lang_pred, score of all rows."""
    training = docs.where(learns).select(column(lang_column).alias("lang"), column(text_column).alias("text"))
    texts = docs.select(column(id_column).alias("id"), column(text_column).alias("text"))
    return predict(spark, texts, fit(training))
