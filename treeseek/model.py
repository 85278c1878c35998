"""Node types, table schemas and the defaults that a query starts from."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Weight of a match per bucket.
FIELD_BOOSTS = {"h1": 20.0, "h2": 12.0, "h3": 10.0, "h4": 5.0, "h5": 3.0, "h6": 2.0, "text": 1.0}
# Limits. Those of keywords and assets hold only where they are asked for.
KEYWORD_LIMIT = 8191
ASSET_SIZE_LIMIT = 104_857_600
ASSET_TEXT_LIMIT = 100_000
DEFAULT_PAGE = 10
DEFAULT_BUCKETS = 10
HIGHLIGHT_SIZE, HIGHLIGHT_COUNT, HIGHLIGHT_NO_MATCH = 150, 2, 150
FLUSH_OCTETS = 40_000_000

TAG_DISABLED = "disabled"
TAG_REMOVED = "removed"
LIVE = "live"
NO_DIMENSION = "default"

KEYS = ("workspace", "dimension", "node_id")

GEO_POINT = T.StructType([T.StructField("lat", T.DoubleType()), T.StructField("lon", T.DoubleType())])

NODES = (
    "node_id string, parent_id string, workspace string, dimension string, type string, "
    "tags array<string>, sort_index bigint, created timestamp, last_modified timestamp, "
    "original_last_modified timestamp, hidden_in_menu boolean, properties map<string,string>"
)


@dataclass(frozen=True)
class Property:
    """A property of a node type and how it is indexed.

    ``mapping``: index type, ``None`` for the default of ``type``.
    ``indexing``: ``False`` drops the property, a callable ``(value, node)``
    computes the indexed Column from the stored one and the node's columns.
    ``extractor``: callable giving ``array<struct<bucket,text>>``.
    """

    type: str = "string"
    mapping: str | None = None
    indexing: Callable | bool | None = None
    extractor: Callable | None = None
    max_items: int | None = None


@dataclass(frozen=True)
class NodeType:
    name: str
    supertypes: tuple[str, ...] = ()
    abstract: bool = False
    fulltext_root: bool | None = None
    fulltext_enabled: bool | None = None
    properties: Mapping[str, Property] = field(default_factory=dict)


class NodeTypes:
    """The configured types. Configuration, so it is small and lives on the driver."""

    def __init__(self, types: Iterable[NodeType]):
        self.by_name = {t.name: t for t in types}
        for node_type in self.by_name.values():
            unknown = [s for s in node_type.supertypes if s not in self.by_name]
            if unknown:
                raise ValueError(f"{node_type.name}: unknown supertypes {unknown}")

    def __iter__(self):
        return iter(self.by_name.values())

    def closure(self, name: str) -> list[str]:
        """The type and all its supertypes, nearest first, each once."""
        seen: list[str] = []
        queue = [name]
        while queue:
            current = queue.pop(0)
            if current not in seen:
                seen.append(current)
                queue.extend(self.by_name[current].supertypes)
        return seen

    def _inherited(self, name: str, attribute: str, default: bool) -> bool:
        for ancestor in self.closure(name):
            value = getattr(self.by_name[ancestor], attribute)
            if value is not None:
                return value
        return default

    def is_fulltext_root(self, name: str) -> bool:
        return self._inherited(name, "fulltext_root", False)

    def is_fulltext_enabled(self, name: str) -> bool:
        return self._inherited(name, "fulltext_enabled", True)

    def properties(self, name: str) -> dict[str, Property]:
        merged: dict[str, Property] = {}
        for ancestor in reversed(self.closure(name)):
            merged.update(self.by_name[ancestor].properties)
        return merged

    def frame(self, spark: SparkSession) -> DataFrame:
        """One row per type: ``type, type_closure, fulltext_root, fulltext_enabled``."""
        rows = [
            (t.name, self.closure(t.name), self.is_fulltext_root(t.name), self.is_fulltext_enabled(t.name))
            for t in self
        ]
        return spark.createDataFrame(
            rows,
            "type string, type_closure array<string>, fulltext_root boolean, fulltext_enabled boolean",
        )

    def property_frame(self, spark: SparkSession) -> DataFrame:
        """One row per type and property, inherited ones included."""
        from treeseek.operators.mapping import mapped_type

        rows = [
            (t.name, name, p.type, mapped_type(p), p.indexing is not False)
            for t in self
            for name, p in self.properties(t.name).items()
        ]
        return spark.createDataFrame(
            rows, "type string, field string, declared string, mapping string, indexed boolean"
        )
