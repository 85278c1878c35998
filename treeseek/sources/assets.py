"""Binary assets and their text."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from treeseek.functions.html import plain, visible
from treeseek.session import TEXTS_AT_ONCE, arrow_rows, mounted

# Fields of an extracted asset.
ASSET_FIELDS = (
    "content", "title", "name", "author", "keywords", "date", "content_type", "content_length", "language",
)


def write(files: DataFrame, path: str) -> int:
    """Each row's ``content`` as a file of its own, with ``name`` behind its number in the task; how many there are.

    For a path on a mounted file system that all executors reach: Hadoop's writer for those starts two processes a
    file to set its mode, which takes many times as long as the file. Each task has a folder, which gets its final
    name when its files are written, so a task that runs twice leaves them once.
    """
    spark = files.sparkSession
    folder = mounted(spark, path)
    if folder is None:
        raise ValueError(f"not on a mounted file system: {path}")
    named = spark._jvm.org.apache.hadoop.fs.Path(path)
    named.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(named)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, pending = 0, f"{folder}/_pending/{uuid.uuid4().hex}"
        for batch in batches:
            for name, content in zip(batch.column("name"), batch.column("content"), strict=True):
                if n == 0:
                    os.makedirs(pending)
                with open(f"{pending}/{n}-{name}", "xb") as out:
                    out.write(content.as_py() or b"")
                n += 1
        if n:
            final = f"{folder}/part-{TaskContext.get().partitionId():05d}-files"
            try:
                os.rename(pending, final)
            except OSError:
                # Another attempt of the task may have ended before.
                if not os.path.isdir(final):
                    raise
        yield pa.RecordBatch.from_pydict({"n": pa.array([n], pa.int64())})

    with arrow_rows(spark, TEXTS_AT_ONCE):
        return files.select("name", "content").mapInArrow(run, "n bigint").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def read(spark: SparkSession, path: str, cap: int | None = None, **options: str) -> DataFrame:
    """Files with their content; with a cap, a file above it keeps its row without content.

    The size is known before the content is read, so oversized files are not loaded.
    """
    files = spark.read.format("binaryFile").options(**options).load(path)
    if cap is None:
        return files
    small = files.where(F.col("length") <= cap)
    large = files.where(F.col("length") > cap).select(
        "path", "modificationTime", "length", F.lit(None).cast("binary").alias("content")
    )
    return small.select("path", "modificationTime", "length", "content").unionByName(large)


def _meta(html: Column, name: str) -> Column:
    pattern = rf'(?is)<meta\s[^>]*name=["\']{name}["\'][^>]*content=["\']([^"\']*)["\']'
    return F.nullif(F.regexp_extract(html, pattern, 1), F.lit(""))


def _first(html: Column, pattern: str) -> Column:
    return F.nullif(plain(F.regexp_extract(html, pattern, 1)), F.lit(""))


def fields(text: Column, name: Column, length: Column, limit: int | None = None) -> Column:
    """The fields of an HTML or plain-text asset.

    ``content`` is whole unless a limit of characters is given.
    """
    is_html = text.rlike(r"(?is)<(?:!doctype|html|head|body)[\s>]")
    without_head = F.regexp_replace(visible(text), r"(?is)<head[^>]*>.*?</head>", " ")
    content = F.when(is_html, plain(without_head)).otherwise(F.trim(text))
    if limit is not None:
        content = F.substring(content, 1, limit)
    language = F.nullif(F.regexp_extract(text, r'(?is)<html[^>]*\slang=["\']([^"\']*)["\']', 1), F.lit(""))
    return F.struct(
        content.alias("content"),
        F.when(is_html, _first(text, r"(?is)<title[^>]*>(.*?)</title>")).alias("title"),
        name.alias("name"),
        F.when(is_html, _meta(text, "author")).alias("author"),
        F.when(is_html, _meta(text, "keywords")).alias("keywords"),
        F.when(is_html, _meta(text, "date")).alias("date"),
        F.when(is_html, F.lit("text/html")).otherwise(F.lit("text/plain")).alias("content_type"),
        length.cast("long").alias("content_length"),
        F.when(is_html, language).alias("language"),
    )


def extract(files: DataFrame, extractor: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """``path`` and ``asset`` struct; ``extractor`` takes over for other formats."""
    if extractor is not None:
        return extractor(files)
    text = F.decode(F.col("content"), "UTF-8")
    name = F.element_at(F.split("path", "/"), -1)
    return files.select("path", fields(F.coalesce(text, F.lit("")), name, F.col("length")).alias("asset"))


def asset_text(asset: Column, name: str = "content") -> Column:
    if name not in ASSET_FIELDS:
        raise ValueError(f"unknown asset field: {name}")
    return asset.getField(name)
