"""License scans: phrases in place, and an exact set-similarity join with notices as templates.

A text block is a run of ``BLOCK_WORDS`` words of a document, or of two times as
many as the longest notice has if that is more; blocks overlap by half, so that
a notice lies whole in one, however its lines are wrapped. A block matches a template if it has at least ``CONTAINMENT``
of the template's different words.

The words of all templates are ordered by the number of documents that have
them, rarest first, counted over the whole corpus. A matching block must have
one of the first ``size - needed + 1`` words of the template (prefix filter), as
many template words as are needed (length filter), and enough words left behind
the place where the two orders first meet (positional filter). What passes is
counted exactly. Each pair is met once: at its first common word.

Only words that occur in templates are kept from a text, and only documents that
have a prefix word are read again. Templates are configuration; what is
broadcast has their size.

Everything is DataFrame operations; no Python runs on executors.

Defined results: a null or empty text has no words and no labels; a null id is
carried along; repeated rows are scanned each; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from treeseek.llm.rows import field, located, sieve, sifted
from treeseek.session import materialise

CONTAINMENT = 0.8
BLOCK_WORDS = 128

# Phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Notices that licenses ask for and names they go by, and their labels. Of a name of up to four words,
# every word is needed at the threshold above, so the word that tells it from others cannot be the one that is missing.
TEMPLATES = (
    ("agpl", "GNU Affero General"),
    ("apache", "Apache License 2.0"),
    (
        "apache",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is "
        "distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ),
    ("bsd", "BSD License"),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met",
    ),
    ("cc-by", "Creative Commons Attribution"),
    ("cc-by-nc", "CC BY-NC"),
    ("cc-by-nd", "CC BY-ND"),
    ("cc-by-sa", "CC BY-SA"),
    ("cc0", "CC0 1.0 Universal"),
    (
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation",
    ),
    ("lgpl", "GNU Lesser General"),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files, to deal in the Software without restriction",
    ),
    ("mpl", "Mozilla Public License"),
    ("proprietary", "All rights reserved"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
)

_NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[str, ...]
    needed: int


def templates_of(notices: Sequence[tuple[str, str]], containment: float = CONTAINMENT) -> list[Template]:
    out = []
    for label, text in notices:
        words = tuple(sorted({w for w in re.split(_NO_WORD, text.lower()) if w}))
        # The smallest whole number of words that reaches the threshold.
        needed = next(n for n in range(1, len(words) + 1) if n / len(words) >= containment)
        out.append(Template(label, words, needed))
    return out


def lowered(text: Column) -> Column:
    """A-Z lower-cased. Two signs beyond ASCII would become ASCII letters, so texts with them go another way."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    odd = F.contains(text, F.lit("\u0130")) | F.contains(text, F.lit("\u212a"))
    return F.when(odd, F.translate(text, upper, upper.lower())).otherwise(F.lower(text))


def words_of(text: Column) -> Column:
    parts = F.split(lowered(F.coalesce(text, F.lit(""))), _NO_WORD)
    return F.filter(parts, lambda w: w != "")


def _strings(values: Sequence[str]) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast("array<string>")


def _places(words: str, phrase: str) -> Column:
    """The word numbers at which a phrase starts."""
    parts = phrase.split()
    here = " AND ".join(f"{words}[i + {k}] = '{part}'" for k, part in enumerate(parts))
    known = " AND ".join(f"array_contains(known, '{part}')" for part in parts)
    last = f"size({words}) - {len(parts)}"
    return F.expr(
        f"CASE WHEN {known} AND {last} >= 0 THEN filter(sequence(0, {last}), i -> {here}) "
        "ELSE CAST(array() AS array<int>) END"
    )


def scan(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    notices: Sequence[tuple[str, str]] = TEMPLATES,
    phrases: dict[str, str] = PHRASES,
    containment: float = CONTAINMENT,
) -> DataFrame:
    """id, n_words, n_base, first_word, last_word, base_labels, labels, score for each row of ``docs``.

    ``score`` is 1 where a phrase stands, else the best containment found.
    """
    templates = templates_of(notices, containment)
    block = block_words(notices)
    vocabulary = sorted({w for t in templates for w in t.words} | {w for p in phrases for w in p.split()})
    placed = located(docs)
    texts = placed.select("row", field(id_column).alias("id"), words_of(field(text_column)).alias("words"))
    seen = texts.withColumn("known", F.array_intersect("words", _strings(vocabulary)))
    names = {phrase: f"places_{k}" for k, phrase in enumerate(phrases)}
    seen = seen.withColumns({name: _places("words", phrase) for phrase, name in names.items()})
    places = F.concat(*names.values())
    labels = F.array_sort(
        F.array_distinct(
            F.array_compact(F.array(*[F.when(F.size(n) > 0, F.lit(phrases[p])) for p, n in names.items()]))
        )
    )
    base = materialise(
        seen.select(
            "row",
            "id",
            F.size("words").cast("bigint").alias("n_words"),
            F.size(places).cast("bigint").alias("n_base"),
            F.array_min(places).cast("bigint").alias("first_word"),
            F.array_max(places).cast("bigint").alias("last_word"),
            labels.alias("base"),
            "known",
        ),
        "license-words",
    )
    found = _similar(placed, base, text_column, templates, vocabulary, block)
    all_labels = F.array_sort(F.array_union("base", F.coalesce("found", _strings([]))))
    return base.drop("known").join(found, "row", "left").select(
        "id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join("base", ",").alias("base_labels"),
        F.array_join(all_labels, ",").alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"),
    )


def block_words(notices: Sequence[tuple[str, str]]) -> int:
    """Words of a block: two times the longest notice if that is more than ``BLOCK_WORDS``."""
    longest = max((sum(w != "" for w in re.split(_NO_WORD, text.lower())) for _, text in notices), default=0)
    return max(BLOCK_WORDS, 2 * longest)


def blocks(words: str, block: int = BLOCK_WORDS) -> Column:
    """The starts of the blocks of a document; each word lies in one or two of them."""
    return F.expr(f"sequence(0, greatest(size({words}) - 1, 0), {block // 2})")


def _similar(
    placed: DataFrame,
    base: DataFrame,
    text_column: str,
    templates: list[Template],
    vocabulary: list[str],
    block: int,
) -> DataFrame:
    """row, found (labels), best (containment) for documents with a block that contains a template."""
    spark = placed.sparkSession
    # As many rows as the templates have words.
    documents = {
        r["word"]: r["n"]
        for r in base.select(F.explode("known").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n")).collect()
    }
    order = sorted(vocabulary, key=lambda w: (documents.get(w, 0), w))
    rank = {w: i for i, w in enumerate(order)}
    ordered = [(t, sorted(rank[w] for w in t.words)) for t in templates]
    prefixes = [
        (k, t.label, t.needed, ranks, position, ranks[position])
        for k, (t, ranks) in enumerate(ordered)
        for position in range(len(ranks) - t.needed + 1)
    ]
    first = F.broadcast(
        spark.createDataFrame(
            prefixes, "template int, label string, needed int, ranks array<int>, position int, rank int"
        )
    )
    rare = sorted({order[p[5]] for p in prefixes})
    least = min((t.needed for t in templates), default=1)
    candidates = base.where(F.arrays_overlap("known", _strings(rare)) & (F.size("known") >= least))
    marked = sifted(placed, F.xxhash64("row"), sieve(candidates.select(F.xxhash64("row").alias("h"))))
    texts = marked.where("maybe").select("row", words_of(field(text_column)).alias("words"))
    ranks = F.create_map(*[F.lit(x) for w in order for x in (w, rank[w])])
    windows = texts.select("row", "words", F.explode(blocks("words", block)).alias("start")).select(
        "row",
        F.array_intersect(F.slice("words", F.col("start") + 1, F.lit(block)), _strings(vocabulary)).alias("known"),
    )
    sets = windows.where(F.size("known") >= least).select(
        "row", F.array_sort(F.transform("known", lambda w: F.element_at(ranks, w))).alias("block")
    )
    pairs = (
        sets.select("row", "block", F.posexplode("block").alias("at", "rank"))
        .join(first, "rank")
        .where(F.size("block") >= F.col("needed"))
        .where(
            1 + F.least(F.size("ranks") - F.col("position") - 1, F.size("block") - F.col("at") - 1) >= F.col("needed")
        )
        .withColumn("common", F.array_intersect("block", "ranks"))
        .where((F.array_min("common") == F.col("rank")) & (F.size("common") >= F.col("needed")))
    )
    return pairs.groupBy("row").agg(
        F.collect_set("label").alias("found"), F.max(F.size("common") / F.size("ranks")).alias("best")
    )
