"""HTML text: buckets by heading level, plain text, and metadata of HTML assets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from treeseek.functions import let

# Buckets, and the patterns that take HTML apart.
HEADINGS = ("h1", "h2", "h3", "h4", "h5", "h6")
BUCKETS = (*HEADINGS, "text")
INVISIBLE = r"(?is)<!--.*?-->|<script[^>]*>.*?</script>|<style[^>]*>.*?</style>"
TAG = r"(?s)<[^>]*>"
SPACE = r"[ \t\r\n]+"
ENTITIES = (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&"))


def heading_pattern(tag: str) -> str:
    return rf"(?is)<{tag}(?:\s[^>]*)?>(.*?)</{tag}>"


ANY_HEADING = "(?is)" + "|".join(rf"<{t}(?:\s[^>]*)?>.*?</{t}>" for t in HEADINGS)


def visible(html: Column) -> Column:
    return F.regexp_replace(html, INVISIBLE, " ")


def plain(fragment: Column) -> Column:
    """Tags out, named entities in, runs of white space to one blank, trimmed."""
    text = F.regexp_replace(fragment, TAG, " ")
    for entity, letter in ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(letter))
    return F.trim(F.regexp_replace(text, SPACE, " "))


def buckets(html: Column) -> Column:
    """Struct of the seven buckets.

    A heading goes to the bucket of its level, several of one level joined by a
    blank; everything else is text. Script, style and comments never count.
    """

    def split(shown: Column) -> Column:
        fields = [
            plain(F.array_join(F.regexp_extract_all(shown, F.lit(heading_pattern(tag)), F.lit(1)), " ")).alias(tag)
            for tag in HEADINGS
        ]
        rest = plain(F.regexp_replace(shown, ANY_HEADING, " ")).alias("text")
        return F.struct(*fields, rest)

    return let(visible(F.coalesce(html, F.lit(""))), split)


def bucket_rows(html: Column) -> Column:
    """The non-empty buckets as array<struct<bucket,text>>."""

    def rows(split: Column) -> Column:
        return F.array(*[F.struct(F.lit(b).alias("bucket"), split.getField(b).alias("text")) for b in BUCKETS])

    return F.filter(let(buckets(html), rows), lambda r: F.length(r["text"]) > 0)


def into(bucket: str, value: Column) -> Column:
    """One value into one bucket, in the same row form."""
    if bucket not in BUCKETS:
        raise ValueError(f"unknown bucket: {bucket}")
    row = F.struct(F.lit(bucket).alias("bucket"), value.cast("string").alias("text"))
    return F.filter(F.array(row), lambda r: F.length(F.trim(r["text"])) > 0)
