"""Highlighted fragments of text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from treeseek.functions import let
from treeseek.functions.analysis import unfolded
from treeseek.model import HIGHLIGHT_COUNT, HIGHLIGHT_NO_MATCH, HIGHLIGHT_SIZE
from treeseek.operators.relevance import TextQuery

# Patterns for sentence ends and white space.
SENTENCE_END = r"(?<=[.?!])[ \t\r\n]+"
_INNER = r"[\p{L}\p{N}]"


def term_pattern(query: TextQuery) -> str | None:
    """Pattern of the words of the query as whole words, prefixes with their rest."""
    words = []
    for atom in query.scoring_atoms:
        for term in atom.terms:
            # Terms are letters and digits only unless a keyword analyser made them.
            quoted = "".join(c if c.isalnum() else f"\\x{{{ord(c):x}}}" for c in term)
            if atom.folded:
                quoted = unfolded(term)
            words.append(quoted + (f"{_INNER}*" if atom.kind == "prefix" else ""))
    if not words:
        return None
    longest_first = "|".join(sorted(set(words), key=lambda w: (-len(w), w)))
    return rf"(?iu)(?<!{_INNER})(?:{longest_first})(?!{_INNER})"


def fragments(text: Column, size: int) -> Column:
    """Sentences; a long one in pieces of at most ``size`` characters that end between words."""
    size = max(1, size)
    piece = rf"(?s)[^ \t\r\n].{{0,{size - 1}}}(?:[ \t\r\n]+|$)|[^ \t\r\n]{{{size}}}"
    sentences = F.split(text, SENTENCE_END)
    pieces = F.flatten(F.transform(sentences, lambda s: F.regexp_extract_all(s, F.lit(piece), F.lit(0))))
    return F.transform(pieces, lambda p: F.rtrim(p, F.lit(" \t\r\n")))


def highlight(
    text: Column,
    query: TextQuery,
    size: int = HIGHLIGHT_SIZE,
    count: int | None = HIGHLIGHT_COUNT,
    no_match_size: int = HIGHLIGHT_NO_MATCH,
) -> Column:
    """Array of fragments with the hits in ``<em>``; without a hit, the start of the text."""
    pattern = term_pattern(query)
    start = F.when(
        (F.length(text) > 0) & F.lit(no_match_size > 0), F.array(F.substring(text, 1, no_match_size))
    ).otherwise(F.array().cast("array<string>"))
    if pattern is None:
        return start
    hits = F.filter(fragments(text, size), lambda f: f.rlike(pattern))
    if count is not None:
        hits = F.slice(hits, 1, max(1, count))
    marked = F.transform(hits, lambda f: F.regexp_replace(f, pattern, "<em>$0</em>"))
    return let(marked, lambda found: F.when(F.size(found) > 0, found).otherwise(start))


def highlight_columns(fields: Sequence[tuple[str, int, int | None, int]], query: TextQuery) -> Column:
    """Struct of highlights, one per configured field of ``fulltext``."""
    return F.struct(
        *[
            highlight(F.col(f"fulltext.{name}"), query, size, count, no_match).alias(name)
            for name, size, count, no_match in fields
        ]
    )
