"""From declared property types to columns: defaults, overrides, conflicts, warnings."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from treeseek.functions.dates import from_wire
from treeseek.functions.geo import point_column
from treeseek.model import GEO_POINT, KEYWORD_LIMIT, NodeTypes, Property

# Index type per declared type. Assets are deliberately unmapped.
DEFAULTS = {
    "string": "keyword",
    "boolean": "boolean",
    "array": "keywords",
    "integer": "integer",
    "DateTime": "date",
    "reference": "keyword",
    "references": "keywords",
}
UNMAPPED = ("Asset", "array<Asset>", "Image")

# Column type per index type.
COLUMN_TYPES: dict[str, T.DataType] = {
    "keyword": T.StringType(),
    "keywords": T.ArrayType(T.StringType()),
    "text": T.StringType(),
    "boolean": T.BooleanType(),
    "integer": T.IntegerType(),
    "long": T.LongType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "date": T.TimestampType(),
    "geo_point": GEO_POINT,
}


def mapped_type(prop: Property) -> str | None:
    """Explicit mapping, else the default of the declared type, else none."""
    if prop.indexing is False:
        return None
    if prop.mapping:
        return prop.mapping
    default = DEFAULTS.get(prop.type)
    if prop.type == "references" and prop.max_items == 1:
        return "keyword"
    return default


def to_column(value: Column, mapping: str) -> Column:
    """Stored text of a property as its typed column; bad values become null."""
    if mapping == "keywords":
        return F.from_json(value, T.ArrayType(T.StringType()))
    if mapping == "date":
        return F.coalesce(from_wire(value), F.try_to_timestamp(value))
    if mapping == "geo_point":
        return point_column(value)
    if mapping in ("keyword", "text"):
        return value
    return value.try_cast(COLUMN_TYPES[mapping])


def schema_of(types: NodeTypes, indexed: Callable[[str], bool] = lambda name: True) -> dict[str, str]:
    """Field → index type over all types that can have documents; a conflict raises, see :func:`conflicts`.

    Abstract types and those that are not ``indexed`` take no part.
    """
    fields: dict[str, str] = {}
    for node_type in types:
        if node_type.abstract or not indexed(node_type.name):
            continue
        for name, prop in types.properties(node_type.name).items():
            mapping = mapped_type(prop)
            if mapping is None:
                continue
            if mapping not in COLUMN_TYPES:
                raise ValueError(f"{node_type.name}.{name}: unknown mapping {mapping}")
            if fields.setdefault(name, mapping) != mapping:
                raise ValueError(f"field {name} is mapped to both {fields[name]} and {mapping}")
    return fields


def conflicts(properties: DataFrame) -> DataFrame:
    """Fields that several types map differently, from (type, field, mapping)."""
    return (
        properties.where(F.col("mapping").isNotNull())
        .groupBy("field")
        .agg(F.array_sort(F.collect_set("mapping")).alias("mappings"))
        .where(F.size("mappings") > 1)
    )


def warnings(properties: DataFrame, known: DataFrame) -> DataFrame:
    """Properties whose declared type has no mapping, from (type, field, declared)."""
    return properties.join(known.select("declared"), "declared", "left_anti").select(
        "type", "field", "declared"
    )


def searchable(keyword: Column, cap: int | None = KEYWORD_LIMIT) -> Column:
    """With a cap, a longer keyword is stored but cannot be found."""
    return keyword if cap is None else F.when(F.length(keyword) <= cap, keyword)
