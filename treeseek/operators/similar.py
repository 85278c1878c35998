"""More like this: documents that share the telling terms of given texts."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from treeseek.operators.filters import disjunction
from treeseek.operators.relevance import DOCUMENT, idf
from treeseek.operators.text_index import TextIndex, tokenise

_TERMS = "field string, term string, tf bigint"


def terms_of_strings(
    index: TextIndex, texts: Sequence[str], fields: Sequence[str], dimensions: Sequence[str] | None = None
) -> DataFrame:
    """Term counts of literal texts, as each analyser that the dimensions and fields have sees them.

    A term that several of them find counts as often as the one that finds it most.
    """
    own = index.analyzers.by_dimension
    asked = list(own) + [None] if dimensions is None else list(dimensions)
    rows = []
    for name in fields:
        counts: Counter = Counter()
        for analyzer in {index.analyzers.pick(d, name) for d in asked}:
            counts |= Counter(t for text in texts for t in analyzer.terms(text))
        rows.extend((name, term, tf) for term, tf in sorted(counts.items()))
    return index.postings.sparkSession.createDataFrame(rows, _TERMS)


def terms_of_table(index: TextIndex, texts: DataFrame, fields: Sequence[str], column: str = "text") -> DataFrame:
    """Term counts of a whole table of texts."""
    return (
        texts.select(
            F.explode(F.array(*[F.lit(f) for f in fields])).alias("field"),
            index.analyzers.default.tokens(F.col(column)).alias("tokens"),
        )
        .select("field", F.explode("tokens").alias("term"))
        .groupBy("field", "term")
        .agg(F.count("*").alias("tf"))
    )


def terms_of_documents(index: TextIndex, like: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Term counts of documents, out of their own text.

    A handful of documents is read faster from the documents, by their key,
    than from postings that lie in the order of terms.
    """
    held = [f for f in fields if f in like.schema["fulltext"].dataType.fieldNames()]
    tokenised = tokenise(like, {f: F.col(f"fulltext.{f}") for f in held}, index.analyzers)
    terms = tokenised.select("field", F.explode("tokens").alias("term"))
    return terms.groupBy("field", "term").agg(F.count("*").alias("tf"))


def select_terms(
    index: TextIndex, counts: DataFrame, max_query_terms: int = 25, min_term_freq: int = 2, min_doc_freq: int = 5
) -> DataFrame:
    """The best terms by tf·idf: at most ``max_query_terms`` rows.

    Frequencies are those of the whole index, all its dimensions together.
    """
    corpus = index.field_stats.groupBy("field").agg(F.sum("n_docs").alias("n_docs"))
    known = index.term_stats.groupBy("field", "term").agg(F.sum("df").alias("df"))
    weighed = (
        counts.where(F.col("tf") >= min_term_freq)
        .join(known.where(F.col("df") >= min_doc_freq), ["field", "term"])
        .join(F.broadcast(corpus), "field")
        .withColumn("weight", F.round(F.col("tf") * idf(F.col("n_docs"), F.col("df")), 6))
    )
    return (
        weighed.orderBy(F.desc("weight"), "term", "field").limit(max_query_terms).select("field", "term", "weight")
    )


def more_like_this(
    index: TextIndex,
    counts: DataFrame,
    exclude: DataFrame | None = None,
    max_query_terms: int = 25,
    min_term_freq: int = 2,
    min_doc_freq: int = 5,
    minimum_should_match: float = 0.3,
) -> DataFrame:
    """(dimension, workspace, doc_id, matched) of documents with enough of the selected terms."""
    # At most max_query_terms rows. They are fetched, so that the postings are
    # looked up by literal terms and not read as a whole.
    chosen = select_terms(index, counts, max_query_terms, min_term_freq, min_doc_freq).collect()
    by_field: dict[str, list[str]] = {}
    for row in chosen:
        by_field.setdefault(row.field, []).append(row.term)
    wanted = disjunction((F.col("field") == f) & F.col("term").isin(terms) for f, terms in sorted(by_field.items()))
    found = (
        index.postings.where(wanted)
        .groupBy(*DOCUMENT)
        .agg(F.count("*").alias("matched"))
        .where(F.col("matched") >= required_matches(len(chosen), minimum_should_match))
    )
    if exclude is not None:
        found = found.join(exclude.select(*DOCUMENT), list(DOCUMENT), "left_anti")
    return found


def required_matches(n_terms: int, share: float = 0.3) -> int:
    return math.ceil(round(n_terms * share, 9))
