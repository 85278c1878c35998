"""Filter clauses as Columns.

Missing values make a positive clause false and an exclusion true. A clause on
a multi-valued field holds if any element does. With a ``cap``, text values
longer than it are as if they were missing, for every clause alike.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from treeseek.errors import QueryError
from treeseek.functions import dates, geo

CLAUSES = ("must", "should", "must_not", "filter")

# Names of range bounds.
BOUNDS: dict[str, Callable[[Column, Column], Column]] = {
    "gt": lambda c, v: c > v,
    "gte": lambda c, v: c >= v,
    "lt": lambda c, v: c < v,
    "lte": lambda c, v: c <= v,
}


def conjunction(conditions: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def disjunction(conditions: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


def negation(condition: Column) -> Column:
    return ~F.coalesce(condition, F.lit(False))


def value(raw: object) -> Column:
    """A literal: Columns pass, nodes give their id, relative dates are resolved."""
    if isinstance(raw, Column):
        return raw
    if dates.is_relative(raw):
        return dates.relative(raw)
    if isinstance(raw, Mapping) and "node_id" in raw:
        return F.lit(raw["node_id"])
    if hasattr(raw, "node_id"):
        return F.lit(raw.node_id)
    return F.lit(raw)


def field_type(df: DataFrame, name: str) -> T.DataType:
    kind: T.DataType = df.schema
    for step in name.split("."):
        if not isinstance(kind, T.StructType) or step not in kind.fieldNames():
            raise QueryError(f"no such field: {name}")
        kind = kind[step].dataType
    return kind


def _capped(df: DataFrame, name: str, cap: int | None) -> bool:
    kind = field_type(df, name)
    text = kind.elementType if isinstance(kind, T.ArrayType) else kind
    return cap is not None and isinstance(text, T.StringType)


def _any(df: DataFrame, name: str, test: Callable[[Column], Column], cap: int | None = None) -> Column:
    if _capped(df, name, cap):
        return _any(df, name, lambda c: test(c) & (F.length(c) <= cap))
    if isinstance(field_type(df, name), T.ArrayType):
        return F.exists(F.col(name), test)
    return test(F.col(name))


def _typed(df: DataFrame, name: str, raw: object) -> Column:
    """A bound in the type of the field: text dates compare as dates."""
    kind = field_type(df, name)
    literal = value(raw)
    if isinstance(kind, T.TimestampType) and isinstance(raw, str) and not dates.is_relative(raw):
        return F.coalesce(dates.from_wire(literal), F.try_to_timestamp(literal))
    return literal


def _findable(wanted: object, cap: int | None) -> bool:
    return cap is None or not isinstance(wanted, str) or len(wanted) <= cap


def term(df: DataFrame, name: str, wanted: object, cap: int | None = None) -> Column:
    if not _findable(wanted, cap):
        return F.lit(False)
    if isinstance(field_type(df, name), T.ArrayType):
        return F.array_contains(F.col(name), _typed(df, name, wanted))
    return F.col(name) == _typed(df, name, wanted)


def terms(df: DataFrame, name: str, wanted: Sequence[object], cap: int | None = None) -> Column:
    plain = [w for w in wanted if w is not None and _findable(w, cap)]
    if not plain:
        return F.lit(False)
    literals = [_typed(df, name, w) for w in plain]
    if isinstance(field_type(df, name), T.ArrayType):
        return F.arrays_overlap(F.col(name), F.array(*literals))
    if any(isinstance(w, (Column, datetime, date)) or dates.is_relative(w) for w in plain):
        return disjunction([F.col(name) == v for v in literals])
    return F.col(name).isin(literals)


def exclude(df: DataFrame, name: str, unwanted: object, cap: int | None = None) -> Column:
    if not _findable(unwanted, cap):
        return F.lit(True)
    if isinstance(field_type(df, name), T.ArrayType):
        return negation(term(df, name, unwanted))
    # Null-safe, so that it stays one comparison that Parquet understands.
    return ~F.col(name).eqNullSafe(_typed(df, name, unwanted))


def range_(df: DataFrame, name: str, cap: int | None = None, **bounds: object) -> Column:
    unknown = set(bounds) - set(BOUNDS)
    if unknown:
        raise QueryError(f"unknown range bounds: {sorted(unknown)}")
    limits = [(BOUNDS[b], _typed(df, name, raw)) for b, raw in bounds.items()]
    # All bounds hold for one and the same element.
    if isinstance(field_type(df, name), T.ArrayType) or _capped(df, name, cap):
        return _any(df, name, lambda c: conjunction(b(c, v) for b, v in limits), cap)
    return conjunction(b(F.col(name), v) for b, v in limits)


def prefix(df: DataFrame, name: str, start: str, cap: int | None = None) -> Column:
    return _any(df, name, lambda c: c.startswith(start), cap)


def geo_distance(df: DataFrame, name: str, origin: object, distance: str | float) -> Column:
    field_type(df, name)
    cell = F.col(f"{name}.cell") if "cell" in field_type(df, name).fieldNames() else None
    return geo.within(F.col(f"{name}.lat"), F.col(f"{name}.lon"), origin, distance, cell)


def filter_map(df: DataFrame, wanted: Mapping[str, object]) -> list[Column]:
    """One clause per entry: a list means any of, null means no clause."""
    return [
        terms(df, name, list(v)) if isinstance(v, (list, tuple, set)) else term(df, name, v)
        for name, v in wanted.items()
        if v is not None
    ]


def at_least(conditions: Sequence[Column], n: int) -> Column:
    """Minimum should match."""
    if n <= 0:
        return F.lit(True)
    if n == 1:
        return disjunction(conditions)
    hits = [F.coalesce(c, F.lit(False)).cast("int") for c in conditions]
    return reduce(lambda a, b: a + b, hits, F.lit(0)) >= n


def combine(
    must: Sequence[Column] = (),
    filter: Sequence[Column] = (),
    should: Sequence[Column] = (),
    must_not: Sequence[Column] = (),
    min_should_match: int | None = None,
) -> Column:
    """A boolean group. ``should`` must match once if there is no must or filter."""
    required = [*must, *filter]
    parts = [*required, *[negation(c) for c in must_not]]
    if should:
        needed = min_should_match if min_should_match is not None else (0 if required else 1)
        if needed:
            parts.append(at_least(should, needed))
    return conjunction(parts)


def clause(df: DataFrame, kind: str, options: object) -> Column:
    """A clause by type name, as in a filter definition."""
    if isinstance(options, Column):
        return options
    if kind == "match_all":
        return F.lit(True)
    if kind == "match_none":
        return F.lit(False)
    if kind == "term":
        (name, wanted), = options.items()
        return term(df, name, wanted.get("value") if isinstance(wanted, Mapping) and "value" in wanted else wanted)
    if kind == "terms":
        (name, wanted), = options.items()
        return terms(df, name, list(wanted))
    if kind == "range":
        (name, bounds), = options.items()
        return range_(df, name, **bounds)
    if kind == "prefix":
        (name, start), = options.items()
        return prefix(df, name, start.get("value") if isinstance(start, Mapping) else start)
    if kind == "exists":
        return F.col(options["field"]).isNotNull()
    if kind == "geo_distance":
        rest = {k: v for k, v in options.items() if k != "distance"}
        (name, origin), = rest.items()
        return geo_distance(df, name, origin, options["distance"])
    if kind == "bool":
        return boolean(df, options)
    raise QueryError(f"unknown filter type {kind!r}; use where(Column) for anything else")


def boolean(df: DataFrame, options: Mapping[str, object]) -> Column:
    groups: dict[str, list[Column]] = {}
    for name, listed in options.items():
        if name == "minimum_should_match":
            continue
        if name not in CLAUSES:
            raise QueryError(f"unknown clause {name!r}, expected one of {CLAUSES}")
        if isinstance(listed, (Column, Mapping)):
            listed = [listed]
        groups[name] = [
            c if isinstance(c, Column) else conjunction(clause(df, k, o) for k, o in c.items()) for c in listed
        ]
    return combine(**groups, min_should_match=options.get("minimum_should_match"))


def not_hidden(name: str = "hidden") -> Column:
    return ~F.col(name).eqNullSafe(True)

