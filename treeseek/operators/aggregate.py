"""Bucket and metric aggregations, nested by path."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from treeseek.errors import QueryError
from treeseek.model import DEFAULT_BUCKETS
from treeseek.operators.filters import field_type
from treeseek.operators.skew import first_n

BUCKET_TYPES = ("terms", "histogram", "date_histogram")
METRIC_TYPES = ("min", "max", "avg", "sum", "stats", "value_count", "cardinality", "percentiles")

# Calendar intervals.
INTERVALS = {
    "year": "year", "1y": "year", "quarter": "quarter", "1q": "quarter", "month": "month", "1M": "month",
    "week": "week", "1w": "week", "day": "day", "1d": "day", "hour": "hour", "1h": "hour",
    "minute": "minute", "1m": "minute",
}
_BROADCAST_BUCKETS = 100_000


@dataclass(frozen=True)
class Aggregation:
    path: tuple[str, ...]
    type: str
    field: str
    options: Mapping = field(default_factory=dict)

    @property
    def name(self) -> str:
        return self.path[-1]


@dataclass(frozen=True)
class Aggregations:
    """The aggregations of a query; checked while they are added."""

    items: tuple[Aggregation, ...] = ()

    def find(self, path: tuple[str, ...]) -> Aggregation | None:
        return next((a for a in self.items if a.path == path), None)

    def add(self, name: str, spec: Mapping, parent_path: str = "") -> Aggregations:
        parent = tuple(parent_path.split(".")) if parent_path else ()
        for depth in range(1, len(parent) + 1):
            above = self.find(parent[:depth])
            if above is None:
                raise QueryError(f"the parent path {parent_path!r} does not exist")
            if above.type not in BUCKET_TYPES:
                raise QueryError(f"{'.'.join(above.path)} is a metric and cannot have children")
        nested = {k: v for k, v in spec.items() if k in ("aggs", "aggregations")}
        kinds = [k for k in spec if k not in nested]
        if len(kinds) != 1 or kinds[0] not in (*BUCKET_TYPES, *METRIC_TYPES):
            raise QueryError(f"unknown aggregation definition: {dict(spec)!r}")
        options = dict(spec[kinds[0]])
        if "field" not in options:
            raise QueryError(f"aggregation {name!r} has no field")
        added = Aggregations((*self.items, Aggregation((*parent, name), kinds[0], options.pop("field"), options)))
        for children in nested.values():
            for child, child_spec in children.items():
                added = added.add(child, child_spec, ".".join((*parent, name)))
        return added

    @property
    def fields(self) -> list[str]:
        """Top-level columns that the aggregations read."""
        return sorted({a.field.split(".")[0] for a in self.items})

    def children(self, path: tuple[str, ...]) -> list[Aggregation]:
        return [a for a in self.items if a.path[:-1] == path]

    def metrics(self, docs: DataFrame) -> DataFrame | None:
        """All metrics at the top as one row, out of one pass."""
        top = [a for a in self.items if len(a.path) == 1 and a.type in METRIC_TYPES]
        return docs.agg(*[c for a in top for c in metric_columns(docs, a)]) if top else None

    @property
    def countable(self) -> bool:
        """Can all be counted in one pass: sketches would be kept for every bucket of every aggregation."""
        return not any(a.type in ("cardinality", "percentiles") for a in self.items)

    def counted(self, docs: DataFrame) -> DataFrame:
        """All buckets of all aggregations in one pass over ``docs``, before any limit.

        These are grouping sets: each row turns into one small row per bucket it
        falls into, with the number of the aggregation in ``_set`` (-1: metrics
        at the top) and its keys in ``_key…``; rows are counted before the one
        shuffle. Fields with several values fan out for their own aggregation only.
        """
        targets = [a for a in self.items if a.type in BUCKET_TYPES]
        kinds = [docs.select(bucket_key(a, _element(docs, a))).schema[0].dataType for a in targets]
        at = {a.path: i for i, a in enumerate(targets)}

        def rows_of(number: int, levels: list[Aggregation], keys: dict[int, Column]) -> Column:
            if not levels:
                made = [keys.get(i, F.lit(None)).cast(kind).alias(f"_key{i}") for i, kind in enumerate(kinds)]
                return F.array(F.struct(F.lit(number).alias("_set"), *made))
            level, rest = levels[0], levels[1:]
            source = F.col(level.field)

            def below(value: Column) -> Column:
                return rows_of(number, rest, {**keys, at[level.path]: bucket_key(level, value)})

            if isinstance(field_type(docs, level.field), T.ArrayType):
                values = F.filter(F.array_distinct(source), lambda v: v.isNotNull())
                return F.flatten(F.array_compact(F.transform(values, below)))
            return F.when(source.isNotNull(), below(source))

        sets = [rows_of(i, [self.find(a.path[: d + 1]) for d in range(len(a.path))], {}) for i, a in enumerate(targets)]
        metrics = [a for a in self.items if a.type in METRIC_TYPES]
        if any(len(a.path) == 1 for a in metrics):
            sets.append(rows_of(-1, [], {}))
        read = sorted({a.field.split(".")[0] for a in metrics})
        rows = docs.select(*read, F.inline(F.flatten(F.array_compact(F.array(*sets)))))
        columns = [c for a in metrics for c in metric_columns(docs, replace(a, path=(self._alias(a),)))]
        return rows.groupBy("_set", *[f"_key{i}" for i in range(len(targets))]).agg(
            F.count(F.lit(1)).alias("_count"), *columns
        )

    def _alias(self, metric: Aggregation) -> str:
        return f"_metric{self.items.index(metric)}"

    def _renamed(self, metrics: Sequence[Aggregation], empty: bool = False) -> list[Column]:
        """Metric columns of :meth:`counted` under their names; ``empty`` gives zero where nothing was counted."""
        columns = []
        for a in metrics:
            for name in _metric_names(a):
                value = F.col(self._alias(a) + name.removeprefix(a.name))
                if empty:
                    zero = a.type in ("sum", "value_count") or (a.type == "stats" and name.endswith(("_count", "_sum")))
                    value = F.coalesce(F.max(value), F.lit(0)) if zero else F.max(value)
                columns.append(value.alias(name))
        return columns

    def compute(self, docs: DataFrame, counted: DataFrame | None = None) -> dict[str, DataFrame]:
        """One DataFrame per bucket aggregation, with the metrics below it, and
        one per metric at the top. Keys are dotted paths. With ``counted``, what
        :meth:`counted` gave, ``docs`` is not read again."""
        results: dict[str, DataFrame] = {}
        top = [a for a in self.items if len(a.path) == 1 and a.type in METRIC_TYPES]
        if counted is None or not top:
            row = self.metrics(docs)
        else:
            row = counted.where(F.col("_set") == -1).agg(*self._renamed(top, empty=True))
        for a in self.items:
            if len(a.path) == 1 and a.type in METRIC_TYPES:
                results[a.name] = row.select(*_metric_names(a))
        for a in self.items:
            if a.type in BUCKET_TYPES:
                results[".".join(a.path)] = self._buckets(docs, a, results, counted)
            elif len(a.path) > 1:
                keys = list(a.path[:-1])
                results[".".join(a.path)] = results[".".join(keys)].select(*keys, *_metric_names(a))
        return results

    def _grouped(self, docs: DataFrame, target: Aggregation, counted: DataFrame | None) -> DataFrame:
        """The buckets of one aggregation, all of them: its keys, ``doc_count`` and the metrics below it."""
        levels = [self.find(target.path[: i + 1]) for i in range(len(target.path))]
        below = [a for a in self.children(target.path) if a.type in METRIC_TYPES]
        if counted is not None:
            at = [a.path for a in self.items if a.type in BUCKET_TYPES]
            keys = [F.col(f"_key{at.index(a.path)}").alias(a.name) for a in levels]
            own = counted.where(F.col("_set") == at.index(target.path))
            return own.select(*keys, F.col("_count").alias("doc_count"), *self._renamed(below))
        keyed = docs
        for a in levels:
            keyed = with_key(keyed, a)
        metrics = [c for a in below for c in metric_columns(docs, a)]
        return keyed.groupBy(*[a.name for a in levels]).agg(F.count("*").alias("doc_count"), *metrics)

    def _buckets(
        self, docs: DataFrame, target: Aggregation, done: Mapping[str, DataFrame], counted: DataFrame | None
    ) -> DataFrame:
        levels = [self.find(target.path[: i + 1]) for i in range(len(target.path))]
        keys = [a.name for a in levels]
        grouped = self._grouped(docs, target, counted)
        parents = keys[:-1]
        limited = [a for a in levels[:-1] if a.type == "terms"]
        if limited:
            above = done[".".join(target.path[:-1])].select(*parents)
            # Parent buckets are limited in number, level by level, if all are terms.
            rows = math.prod(a.options.get("size") or DEFAULT_BUCKETS for a in limited)
            small = len(limited) == len(parents) and rows <= _BROADCAST_BUCKETS
            grouped = grouped.join(F.broadcast(above) if small else above, parents, "left_semi")
        return top_buckets(grouped, parents, target).select(*keys, "doc_count", *grouped.columns[len(keys) + 1 :])


def bucket_key(agg: Aggregation, source: Column) -> Column:
    """The bucket that a value falls into."""
    if agg.type == "histogram":
        step = float(agg.options["interval"])
        return F.floor(source / step) * step
    if agg.type == "date_histogram":
        interval = agg.options.get("calendar_interval", agg.options.get("interval"))
        if interval not in INTERVALS:
            raise QueryError(f"unknown interval {interval!r}")
        return F.date_trunc(INTERVALS[interval], source)
    return source


def _element(docs: DataFrame, agg: Aggregation) -> Column:
    source = F.col(agg.field)
    return F.get(source, F.lit(0)) if isinstance(field_type(docs, agg.field), T.ArrayType) else source


def with_key(docs: DataFrame, agg: Aggregation) -> DataFrame:
    """``docs`` with the bucket key in a column of the aggregation's name."""
    source = F.col(agg.field)
    if isinstance(field_type(docs, agg.field), T.ArrayType):
        docs = docs.withColumn("_value", F.explode(F.array_distinct(source)))
        source = F.col("_value")
    key = bucket_key(agg, source)
    return docs.where(source.isNotNull()).withColumn(agg.name, key).drop("_value")


def top_buckets(grouped: DataFrame, parents: Sequence[str], agg: Aggregation) -> DataFrame:
    """The largest buckets, ties by key; histograms keep all, in key order."""
    if agg.type != "terms":
        return grouped.orderBy(*parents, agg.name) if not parents else grouped
    size = agg.options.get("size") or DEFAULT_BUCKETS
    order = [F.desc("doc_count"), F.asc(agg.name)]
    if not parents:
        return grouped.orderBy(*order).limit(size)
    return first_n(grouped, parents, order[:1], size, spread=(agg.name,))


def _metric_names(agg: Aggregation) -> list[str]:
    if agg.type == "stats":
        return [f"{agg.name}_{part}" for part in ("count", "min", "max", "avg", "sum")]
    return [agg.name]


def metric_columns(docs: DataFrame, agg: Aggregation) -> list[Column]:
    """Aggregate Columns of a metric; on arrays every element counts."""
    kind = field_type(docs, agg.field)
    value = F.col(agg.field)
    if isinstance(kind, T.ArrayType):
        present = F.filter(value, lambda v: v.isNotNull())
        low, high = F.min(F.array_min(value)), F.max(F.array_max(value))
        count = F.coalesce(F.sum(F.when(value.isNotNull(), F.size(present))), F.lit(0))
        if isinstance(kind.elementType, T.NumericType):
            total = F.sum(F.aggregate(present, F.lit(0.0), lambda a, v: a + v.cast("double")))
        else:
            total = F.lit(None).cast("double")
        mean = total / F.nullif(count, F.lit(0))
    else:
        low, high, count = F.min(value), F.max(value), F.count(value)
        total, mean = F.sum(value), F.avg(value)
    name = agg.name
    if agg.type == "stats":
        parts = zip(_metric_names(agg), (count, low, high, mean, F.coalesce(total, F.lit(0))))
        return [c.alias(n) for n, c in parts]
    if agg.type == "cardinality":
        return [F.approx_count_distinct(value, agg.options.get("rsd", 0.01)).alias(name)]
    if agg.type == "percentiles":
        wanted = [p / 100.0 for p in agg.options.get("percents", (1, 5, 25, 50, 75, 95, 99))]
        return [F.percentile_approx(value, wanted, agg.options.get("accuracy", 10_000)).alias(name)]
    simple = {"min": low, "max": high, "avg": mean, "sum": F.coalesce(total, F.lit(0)), "value_count": count}
    return [simple[agg.type].alias(name)]


def counts_by_index(docs: DataFrame) -> DataFrame:
    """Indexed nodes per workspace and dimension."""
    return docs.groupBy("workspace", "dimension").agg(F.count("*").alias("n_docs"))
