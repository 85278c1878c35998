"""Paths of ids, and values at dotted paths."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def prefixes(path: Column, separator: str = "/") -> Column:
    """All prefixes, shortest first, the whole path included."""
    parts = F.split(path, F.lit(separator))
    return F.transform(
        F.sequence(F.lit(1), F.size(parts)),
        lambda n: F.array_join(F.slice(parts, F.lit(1), n), separator),
    )


def ancestors(path: Column, separator: str = "/") -> Column:
    """All prefixes without the path itself; a root has none."""
    return drop_last(prefixes(path, separator))


def drop_last(values: Column) -> Column:
    return F.when(F.size(values) > 1, F.slice(values, F.lit(1), F.size(values) - 1)).otherwise(
        F.slice(values, 1, 0)
    )


def serialise(ids: Column, separator: str = "/") -> Column:
    return F.array_join(ids, separator)


def subtree(path: Column, root: str, separator: str = "/") -> Column:
    """The node at ``root`` and everything below it; both tests reach Parquet."""
    return (path == root) | path.startswith(root + separator)


def type_namespace(type_name: Column) -> Column:
    return F.split_part(type_name, F.lit(":"), F.lit(1))


def value_at(df: DataFrame, path: str | None) -> Column:
    """The value at a dotted path: struct fields, map keys, array positions.

    No path gives the whole row as a struct.
    """
    if not path:
        return F.struct(*[F.col(f"`{name}`") for name in df.columns])
    head, *rest = path.split(".")
    if head not in df.columns:
        return F.lit(None).cast("string")
    column, kind = F.col(f"`{head}`"), df.schema[head].dataType
    for step in rest:
        if isinstance(kind, T.StructType):
            if step not in kind.fieldNames():
                return F.lit(None).cast("string")
            column, kind = column.getField(step), kind[step].dataType
        elif isinstance(kind, T.MapType):
            column, kind = column.getItem(step), kind.valueType
        elif isinstance(kind, T.ArrayType) and step.isdigit():
            column, kind = F.get(column, F.lit(int(step))), kind.elementType
        else:
            return F.lit(None).cast("string")
    return column
