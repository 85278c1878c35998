"""Term suggestions: words of the index close to a word that is not in it."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from treeseek.errors import QueryError
from treeseek.functions.analysis import Analyzer
from treeseek.operators.filters import disjunction

# Options of a term suggestion.
DEFAULTS = {"size": 5, "max_edits": 2, "prefix_length": 1, "min_word_length": 4, "suggest_mode": "missing"}


def definition(spec: Mapping) -> tuple[str, str, dict]:
    """(text, field, options) of a named suggestion; only term suggestions exist."""
    if "text" not in spec or "term" not in spec:
        raise QueryError("a suggestion needs a text and a term definition")
    options = dict(spec["term"])
    name = options.pop("field", "text").removeprefix("fulltext.")
    unknown = set(options) - set(DEFAULTS)
    if unknown:
        raise QueryError(f"unknown suggestion options: {sorted(unknown)}")
    return spec["text"], name, {**DEFAULTS, **options}


def vocabulary(term_stats: DataFrame, field: str) -> DataFrame:
    """(term, freq) of one field, over all dimensions."""
    return term_stats.where(F.col("field") == field).groupBy("term").agg(F.sum("df").alias("freq"))


def suggest(
    term_stats: DataFrame,
    text: str,
    field: str = "text",
    analyzer: Analyzer | None = None,
    size: int = 5,
    max_edits: int = 2,
    prefix_length: int = 1,
    min_word_length: int = 4,
    suggest_mode: str = "missing",
) -> DataFrame:
    """Rows (token_pos, token, option, score, freq, rank); a token without options keeps one row.

    Tokens meet only words with the same first letters and a length in reach,
    and those conditions go down to the stored vocabulary.
    """
    tokens = (analyzer or Analyzer()).terms(text)
    spark = term_stats.sparkSession
    asked = spark.createDataFrame(
        [(i, t, t[:prefix_length], len(t)) for i, t in enumerate(tokens)],
        "token_pos int, token string, start string, token_length int",
    )
    of_field = term_stats.where(F.col("field") == field)
    known = of_field.where(F.col("term").isin(tokens)).select(F.col("term").alias("token")).distinct()
    open_tokens = asked.where(F.col("token_length") >= min_word_length)
    if suggest_mode == "missing":
        open_tokens = open_tokens.join(known, "token", "left_anti")
    # Two conditions, so that the first one alone can be pushed down to Parquet.
    starts = sorted({t[:prefix_length] for t in tokens})
    starting = disjunction(F.col("term").startswith(s) for s in starts)
    reach = disjunction(
        F.col("term").startswith(t[:prefix_length])
        & F.length("term").between(len(t) - max_edits, len(t) + max_edits)
        for t in tokens
    )
    words = of_field.where(starting).where(reach).groupBy("term").agg(F.sum("df").alias("freq")).withColumn(
        "start", F.substring("term", 1, prefix_length)
    )
    # One row per token of the query text.
    near = words.join(F.broadcast(open_tokens), "start").where(
        F.abs(F.length("term") - F.col("token_length")) <= max_edits
    )
    distance = F.levenshtein("term", "token", max_edits)
    options = (
        near.withColumn("distance", distance)
        .where(F.col("distance").between(1, max_edits))
        .select(
            "token_pos",
            F.col("term").alias("option"),
            F.round(
                1.0 - F.col("distance") / F.least(F.length("term"), F.col("token_length")), 6
            ).alias("score"),
            "freq",
        )
    )
    order = Window.partitionBy("token_pos").orderBy(F.desc("score"), F.desc("freq"), "option")
    best = options.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= size)
    return asked.select("token_pos", "token").join(best, "token_pos", "left")


def did_you_mean(suggestions: DataFrame, threshold: float = 0.7) -> DataFrame:
    """One row: the text with the best option per token, empty below the threshold."""
    best = suggestions.where(F.col("rank").isNull() | (F.col("rank") == 1))
    ordered = F.array_sort(F.collect_list(F.struct("token_pos", F.coalesce("option", "token").alias("word"))))
    return best.agg(
        F.coalesce(F.max("score"), F.lit(0.0)).alias("score"),
        F.array_join(F.transform(ordered, lambda r: r["word"]), " ").alias("words"),
    ).select(
        F.when(F.col("score") >= threshold, F.col("words")).otherwise(F.lit("")).alias("did_you_mean")
    )
