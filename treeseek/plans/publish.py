"""Versions of an index as tables, with views as the stable names.

A version is written aside; making it live only replaces views. What happened
is kept in an append-only catalog table, so that no step reads and overwrites
the same files.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Mapping
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from treeseek.errors import PublishError
from treeseek.functions.analysis import AnalyzerSet
from treeseek.operators import validity
from treeseek.operators.text_index import TextIndex, field_stats, lay_out, stats_change, term_stats
from treeseek.plans.build import Built
from treeseek.plans.search import SearchIndex
from treeseek.sources import error_sinks

_NAME = re.compile(r"[a-z][a-z0-9_]*")
_VERSION = re.compile(r"[a-z0-9]+")
KINDS = ("docs", "parts", "tree", "postings", "field_stats", "term_stats", "errors")
# Kinds that take changes: what they are keyed by, next to workspace and dimension.
CHANGING = {"docs": "node_id", "parts": "part_node_id", "postings": "doc_id", "tree": "node_id"}
_EVENT = "alias string, version string, index_name string, dimension string, event string, at timestamp"


# Columns that rows are looked up by, next to the order the files are in.
_LOOKED_UP = {"docs": ("doc_id", "node_id"), "tree": ("node_id",), "parts": ("part_node_id", "root_id")}
# Statistics change by sums: documents and terms that came or went.
_DELTAS = {
    "field_stats": "dimension string, field string, n_docs bigint, total_dl bigint",
    "term_stats": "dimension string, field string, term string, df bigint",
}
# The batch a change came with; a later batch wins over an earlier one.
_BATCH = "batch"


def _key(kind: str) -> tuple[str, str, str]:
    return ("workspace", "dimension", CHANGING[kind])


def view_suffix(dimension: str) -> str:
    """A dimension as part of a view name; all others have another one, whatever the case of letters counts for."""
    return re.sub(r"[^a-z0-9]", lambda m: f"_{ord(m.group()):x}", dimension)


def index_names_with_postfix(names: DataFrame, postfix: str, column: str = "index_name") -> DataFrame:
    """Names that end in the postfix, whatever the prefix holds."""
    return names.where(F.col(column).endswith("-" + postfix))


def stale(names: DataFrame, live: DataFrame, column: str = "index_name") -> DataFrame:
    """All names that are not live."""
    return names.join(live.select(column), column, "left_anti")


class IndexStore:
    def __init__(
        self,
        spark: SparkSession,
        alias: str,
        database: str = "default",
        settings: Mapping[str, Mapping] | None = None,
        analyzers: AnalyzerSet | None = None,
        error_sink: tuple[str, Mapping[str, str]] | None = None,
    ):
        """``error_sink``: a data source and its options that errors are added to, next to the table of the version."""
        if not _NAME.fullmatch(alias):
            raise PublishError(f"not an index name: {alias!r}")
        self.spark, self.alias, self.database = spark, alias, database
        self.settings = dict(settings or {})
        self.error_sink = error_sink
        self.error_count = 0
        self.analyzers = analyzers or AnalyzerSet.from_settings(self.settings)

    # Names

    def _table(self, version: str, kind: str) -> str:
        return f"{self.database}.{self.alias}_{version}_{kind}"

    def _catalog(self) -> str:
        return f"{self.database}.{self.alias}_catalog"

    def _has(self, name: str) -> bool:
        return self.spark.catalog.tableExists(name)

    def settings_for(self, dimension: str) -> Mapping:
        """Settings of a dimension; they replace the default ones and are not merged with them."""
        return self.settings.get(dimension, self.settings.get("default", {}))

    # Catalog

    def _record(self, rows: DataFrame) -> None:
        rows.coalesce(1).write.mode("append").format("parquet").saveAsTable(self._catalog())

    def _event(self, version: str, dimensions: DataFrame, event: str) -> DataFrame:
        return dimensions.select(
            F.lit(self.alias).alias("alias"),
            F.lit(version).alias("version"),
            F.concat_ws("-", F.lit(self.alias), "dimension", F.lit(version)).alias("index_name"),
            "dimension",
            F.lit(event).alias("event"),
            F.lit(datetime.now(timezone.utc)).alias("at"),
        )

    def catalog(self) -> DataFrame:
        """One row per index: is it there, is it live, since when."""
        if not self._has(self._catalog()):
            return self.spark.createDataFrame([], "alias string, version string, index_name string, "
                                                  "dimension string, live boolean, built_at timestamp")
        events = self.spark.table(self._catalog())
        live = self.live_version()
        return (
            events.groupBy("alias", "version", "index_name", "dimension")
            .agg(F.max_by("event", "at").alias("last"), F.min("at").alias("built_at"))
            .where(F.col("last") != "dropped")
            .select(
                "alias", "version", "index_name", "dimension",
                F.coalesce(F.col("version") == F.lit(live), F.lit(False)).alias("live"), "built_at",
            )
        )

    def live_version(self) -> str | None:
        if not self._has(self._catalog()):
            return None
        row = (
            self.spark.table(self._catalog()).where(F.col("event") == "live").agg(F.max_by("version", "at")).first()
        )
        return row[0]

    def indices(self, live_only: bool = False, prefix: str | None = None) -> DataFrame:
        found = self.catalog()
        if live_only:
            found = found.where("live")
        if prefix is not None:
            found = found.where(F.col("index_name").startswith(prefix))
        return found

    # Writing

    def create(self, built: Built, version: str | None = None, max_records_per_file: int = 0) -> str:
        """Write a version; one of the same name is replaced unless it is live."""
        version = version or datetime.now(timezone.utc).strftime("%Y%m%d%H%M%S")
        if not _VERSION.fullmatch(version):
            raise PublishError(f"not a version: {version!r}")
        if version == self.live_version():
            raise PublishError(f"version {version} is live; update it or choose another name")
        self._drop(version)
        text = built.text
        placed = built.docs.repartitionByRange("dimension", "workspace", "path").sortWithinPartitions(
            "dimension", "workspace", "path"
        )
        parts = built.parts.repartitionByRange("dimension", "workspace", "root_id", "part_order")
        self._write(placed, version, "docs", ("dimension", "workspace"), max_records_per_file)
        self._write(parts, version, "parts", ("dimension", "workspace"), max_records_per_file)
        self._write(lay_out(text.postings), version, "postings", ("dimension",), max_records_per_file)
        self._write(text.field_stats, version, "field_stats")
        stored = self.spark.table(self._table(version, "postings"))
        vocabulary = term_stats(stored).repartitionByRange("field", "term").sortWithinPartitions("field", "term")
        self._write(vocabulary, version, "term_stats")
        seen = Observation()
        self._write(validity.counted(built.errors, seen), version, "errors", ("run_id",))
        self.error_count = seen.get["errors"]
        self._pass_on(self.spark.table(self._table(version, "errors")))
        tree = built.tree.repartitionByRange("dimension", "workspace", "path").sortWithinPartitions(
            "dimension", "workspace", "path"
        )
        self._write(tree, version, "tree", ("dimension", "workspace"), max_records_per_file)
        for kind in ("field_stats", "term_stats"):
            deltas = self.spark.createDataFrame([], _DELTAS[kind] + ", batch bigint")
            self._write(deltas, version, f"{kind}_changes", ("batch",))
        for kind in CHANGING:
            empty = self.spark.table(self._table(version, kind)).limit(0)
            marked = empty.withColumn(_BATCH, F.lit(None).cast("bigint"))
            self._write(marked, version, f"{kind}_changes", (_BATCH,))
            self._write(marked.select(*_key(kind), _BATCH), version, f"{kind}_replaced", (_BATCH,))
        dimensions = self.spark.table(self._table(version, "docs")).select("dimension").distinct()
        self._record(self._event(version, dimensions, "created"))
        return version

    def _write(self, df: DataFrame, version: str, kind: str, partitions: tuple = (), max_records: int = 0) -> None:
        writer = df.write.mode("overwrite").format("parquet").option("maxRecordsPerFile", max_records)
        if partitions:
            writer = writer.partitionBy(*partitions)
        for column in _LOOKED_UP.get(kind, ()):
            writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
        writer.saveAsTable(self._table(version, kind))

    def make_live(self, version: str | None) -> None:
        """Point the main view, the version view and the dimension views at a version."""
        if not version:
            raise PublishError("no version given")
        if not self._has(self._table(version, "docs")):
            raise PublishError(f"version {version} does not exist")
        for kind in KINDS:
            view = self.alias if kind == "docs" else f"{self.alias}_{kind}"
            self._view(view, self._current(version, kind))
        self._view(f"{self.alias}_v_{version}", self._current(version, "docs"))
        rows = self.spark.table(self._table(version, "docs")).select("dimension").distinct()
        # One name per configured dimension: a short list.
        served = set()
        for (dimension,) in rows.collect():
            name = f"{self.alias}_in_{view_suffix(dimension)}"
            quoted = dimension.replace("\\", "\\\\").replace("'", "\\'")
            self._view(name, self._current(version, "docs"), f"dimension = '{quoted}'")
            served.add(name.lower())
        # A dimension that is gone leaves no view behind.
        for row in self.spark.sql(f"SHOW VIEWS IN {self.database} LIKE '{self.alias}_in_*'").collect():
            if not row.isTemporary and row.viewName.lower() not in served:
                self.spark.sql(f"DROP VIEW IF EXISTS {self.database}.{row.viewName}")
        self._record(self._event(version, rows, "live"))

    def _view(self, name: str, source: str, condition: str | None = None) -> None:
        where = f" WHERE {condition}" if condition else ""
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.database}.{name} AS SELECT * FROM {source}{where}")

    def _current(self, version: str, kind: str, before: int | None = None) -> str:
        """The base with the changes over it: replaced rows out, the last new ones in.

        Filters on the view reach both sides, so a lookup prunes the base as if
        there were no changes. ``before`` leaves out that batch and later ones.
        """
        base = self._table(version, kind)
        seen = "true" if before is None else f"batch < {int(before)}"
        if kind == "term_stats":
            return (
                f"(SELECT dimension, field, term, sum(df) AS df FROM (SELECT dimension, field, term, df FROM {base} "
                f"UNION ALL SELECT dimension, field, term, df FROM {base}_changes WHERE {seen}) "
                f"GROUP BY dimension, field, term HAVING sum(df) > 0)"
            )
        if kind == "field_stats":
            return (
                f"(SELECT dimension, field, sum(n_docs) AS n_docs, sum(total_dl) / sum(n_docs) AS avg_dl FROM "
                f"(SELECT dimension, field, n_docs, n_docs * avg_dl AS total_dl FROM {base} "
                f"UNION ALL SELECT dimension, field, n_docs, total_dl FROM {base}_changes WHERE {seen}) "
                f"GROUP BY dimension, field HAVING sum(n_docs) > 0)"
            )
        if kind not in CHANGING:
            return base
        names = [f"`{c}`" for c in self.spark.table(base).columns]
        keys = _key(kind)
        same = " AND ".join(f"b.{k} = r.{k}" for k in keys)
        new = " AND ".join(f"c.{k} = r.{k}" for k in keys)
        last = f"(SELECT {', '.join(keys)}, max(batch) AS batch FROM {base}_replaced WHERE {seen} GROUP BY {', '.join(keys)})"
        return (
            f"(SELECT {', '.join('b.' + n for n in names)} FROM {base} b LEFT ANTI JOIN "
            f"(SELECT * FROM {base}_replaced WHERE {seen}) r ON {same} "
            f"UNION ALL SELECT {', '.join('c.' + n for n in names)} FROM "
            f"(SELECT * FROM {base}_changes WHERE {seen}) c LEFT SEMI JOIN {last} r ON {new} AND c.batch = r.batch)"
        )

    def update(
        self,
        batch_id: int,
        changes: Mapping[str, tuple[DataFrame, DataFrame]],
        postings: tuple[DataFrame, DataFrame] | None = None,
        errors: DataFrame | None = None,
    ) -> None:
        """Put a batch of changes over the live version; views and version stay.

        ``changes``: per kind the keys that are replaced and the rows that take
        their place. ``postings``: those of the replaced
        documents before and after, for the statistics. ``errors``: documents
        of the batch that were held back. A batch that is sent again replaces
        itself, also if it has fewer rows or none.
        """
        version = self.live_version()
        if version is None:
            raise PublishError(f"index {self.alias} has no live version")
        unknown = set(changes) - set(CHANGING)
        if unknown:
            raise PublishError(f"these tables take no changes: {sorted(unknown)}")
        for kind, (replaced, rows) in changes.items():
            for part, df in (("changes", rows), ("replaced", replaced)):
                self._put(df, f"{self._table(version, kind)}_{part}", batch_id)
        if postings is not None:
            for kind, deltas in zip(("term_stats", "field_stats"), stats_change(*postings)):
                self._put(deltas, f"{self._table(version, kind)}_changes", batch_id)

        if errors is not None:
            target = self._table(version, "errors")
            columns = [c for c in self.spark.table(target).columns if c != "run_id"]
            run = f"batch-{int(batch_id)}"
            self._overwrite(errors.select(columns), target, f"run_id = '{run}'")
            self._pass_on(self.spark.table(target).where(F.col("run_id") == run))

    def _pass_on(self, stored: DataFrame) -> None:
        """To the sink, from what is stored. A batch that is sent again is there twice, under the same references."""
        if self.error_sink is not None:
            error_sinks.store(stored, *self.error_sink)

    def _put(self, df: DataFrame, target: str, batch_id: int) -> None:
        columns = [c for c in self.spark.table(target).columns if c != _BATCH]
        self._overwrite(df.select(columns), target, f"{_BATCH} = {int(batch_id)}")

    def _overwrite(self, df: DataFrame, target: str, partition: str) -> None:
        """Put ``df`` in the place of one partition, which is emptied even if ``df`` is empty."""
        view = f"_put_{uuid.uuid4().hex}"
        # A stream's batch belongs to a session of its own; tables are the same in all of them.
        session = df.sparkSession
        df.createOrReplaceTempView(view)
        try:
            session.sql(f"INSERT OVERWRITE TABLE {target} PARTITION ({partition}) SELECT * FROM {view}")
        finally:
            session.catalog.dropTempView(view)

    def compact(self, version: str | None = None) -> str:
        """Fold the changes into a new version and make it live."""
        live = self.live_version()
        if live is None:
            raise PublishError(f"index {self.alias} has no live version")
        current = {k: self.spark.table(f"{self.database}.{self.alias}_{k}") for k in KINDS if k != "docs"}
        docs = self.spark.table(f"{self.database}.{self.alias}")
        postings = current["postings"]
        text = TextIndex(postings, field_stats(postings), term_stats(postings), self.analyzers)
        none = current["errors"].limit(0)
        built = Built(docs, current["parts"], current["tree"], text, current["errors"], none, none)
        created = self.create(built, version)
        self.make_live(created)
        return created

    def _drop(self, version: str) -> None:
        self.spark.sql(f"DROP VIEW IF EXISTS {self.database}.{self.alias}_v_{version}")
        for kind in KINDS:
            for suffix in ("", "_changes", "_replaced"):
                self.spark.sql(f"DROP TABLE IF EXISTS {self._table(version, kind)}{suffix}")

    def remove_old(self) -> DataFrame:
        """Drop all versions but the live one; other names are never touched."""
        live = self.indices(live_only=True)
        removed = stale(self.indices(), live).select("version", "index_name", "dimension")
        versions = [r.version for r in removed.select("version").distinct().collect()]
        names = removed.select("index_name").collect()
        for version in versions:
            gone = removed.where(F.col("version") == version).select("dimension").collect()
            dimensions = self.spark.createDataFrame(gone, "dimension string")
            self._drop(version)
            self._record(self._event(version, dimensions, "dropped"))
        return self.spark.createDataFrame(names, "index_name string")

    def drop(self) -> None:
        """The whole index: views, all versions, the catalog."""
        if not self._has(self._catalog()):
            return
        versions = [r.version for r in self.catalog().select("version").distinct().collect()]
        served = {f"{self.alias}_{kind}" for kind in KINDS if kind != "docs"} | {self.alias}
        for row in self.spark.sql(f"SHOW VIEWS IN {self.database} LIKE '{self.alias}*'").collect():
            if not row.isTemporary and (row.viewName in served or row.viewName.startswith(f"{self.alias}_in_")):
                self.spark.sql(f"DROP VIEW IF EXISTS {self.database}.{row.viewName}")
        for version in versions:
            self._drop(version)
        self.spark.sql(f"DROP TABLE IF EXISTS {self._catalog()}")

    # Reading

    def read(self, workspaces: Mapping[str, str | None] | None = None) -> SearchIndex:
        """The live index, by its views."""
        if self.live_version() is None:
            raise PublishError(f"index {self.alias} has no live version")

        def view(kind: str) -> DataFrame:
            return self.spark.table(f"{self.database}.{self.alias}_{kind}")

        text = TextIndex(view("postings"), view("field_stats"), view("term_stats"), self.analyzers)
        docs = self.spark.table(f"{self.database}.{self.alias}")
        return SearchIndex(docs, text, dict(workspaces or {"live": None}))

    def current(self, kind: str, before: int | None = None) -> DataFrame:
        """A table of the live index, as it was before a batch if one is given."""
        if kind not in KINDS:
            raise PublishError(f"no such table: {kind}")
        if before is not None:
            return self.spark.sql(f"SELECT * FROM {self._current(self.live_version(), kind, before)}")
        return self.spark.table(f"{self.database}.{self.alias}" + ("" if kind == "docs" else f"_{kind}"))
