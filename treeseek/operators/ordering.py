"""Sorting and paging."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from treeseek.errors import QueryError
from treeseek.functions import geo
from treeseek.operators.filters import field_type

_GEO_OPTIONS = ("order", "unit", "mode", "distance_type", "ignore_unmapped")


@dataclass(frozen=True)
class SortKey:
    field: str
    descending: bool = False
    geo: Mapping = field(default_factory=dict)
    column: Column | None = None

    def value(self, docs: DataFrame) -> Column:
        if self.column is not None:
            return self.column
        if self.geo:
            away = geo.distance_m(F.col(f"{self.field}.lat"), F.col(f"{self.field}.lon"), self.geo["point"])
            return away / geo.METRES[self.geo["unit"]]
        if self.field in ("_score", "score"):
            return F.col("score")
        column = F.col(self.field)
        if isinstance(field_type(docs, self.field), T.ArrayType):
            return F.array_max(column) if self.descending else F.array_min(column)
        return column

    def order(self, column: Column) -> Column:
        return F.desc_nulls_last(column) if self.descending else F.asc_nulls_last(column)


def parse(configuration: object) -> list[SortKey]:
    """Sort keys out of a name, a Column, a mapping or a list of these."""
    if isinstance(configuration, Column):
        return [SortKey("", column=configuration)]
    if isinstance(configuration, SortKey):
        return [configuration]
    if isinstance(configuration, str):
        return [SortKey(configuration)]
    if isinstance(configuration, (list, tuple)):
        return [key for part in configuration for key in parse(part)]
    keys = []
    for name, spec in configuration.items():
        if name == "_geo_distance":
            (target, origin), = [(k, v) for k, v in spec.items() if k not in _GEO_OPTIONS]
            unit = spec.get("unit", "m")
            if unit not in geo.METRES:
                raise QueryError(f"unknown unit {unit!r}")
            lat, lon = geo.point(origin)
            settings = {"point": {"lat": lat, "lon": lon}, "unit": unit}
            keys.append(SortKey(target, spec.get("order") == "desc", settings))
        else:
            order = spec.get("order", "asc") if isinstance(spec, Mapping) else spec
            keys.append(SortKey(name, str(order).lower() == "desc"))
    return keys


def page(
    docs: DataFrame,
    keys: Sequence[SortKey],
    limit: int | None,
    offset: int | None = None,
    columns: Sequence[str] | None = None,
    tie: str = "doc_id",
) -> tuple[DataFrame, list[Column]]:
    """The rows of one page with ``sort_values``, and the order to restore later.

    Only the asked columns go through the sort. With a limit it is a top-n per
    task and never a full sort.
    """
    keys = list(keys) or [SortKey("score", True)]
    values = [k.value(docs).alias(f"s{i}") for i, k in enumerate(keys)]
    wanted = list(dict.fromkeys([tie, *(columns if columns is not None else docs.columns)]))
    flat = docs.select(*wanted, F.struct(*values).alias("sort_values"))
    order = [k.order(F.col(f"sort_values.s{i}")) for i, k in enumerate(keys)] + [F.asc(tie)]
    ordered = flat.orderBy(*order)
    if offset:
        ordered = ordered.offset(offset)
    if limit is not None:
        ordered = ordered.limit(limit)
    return ordered, order
