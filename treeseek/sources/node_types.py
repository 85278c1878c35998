"""Node types from configuration or from a table."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame

from treeseek.functions import html
from treeseek.model import NodeType, NodeTypes, Property

# Extractors by name, for types that come as data.
EXTRACTORS: dict[str, Callable] = {
    "html": html.bucket_rows,
    **{bucket: (lambda value, bucket=bucket: html.into(bucket, value)) for bucket in html.BUCKETS},
}


def from_config(config: Mapping[str, Mapping]) -> NodeTypes:
    """``{name: {supertypes, abstract, fulltext: {root, enable}, properties: {name:
    {type, mapping, indexing, extractor}}}}``; an extractor is a name or a callable."""
    types = []
    for name, spec in config.items():
        fulltext = spec.get("fulltext", {})
        properties = {}
        for prop, details in spec.get("properties", {}).items():
            extractor = details.get("extractor")
            if isinstance(extractor, str):
                extractor = EXTRACTORS[extractor]
            properties[prop] = Property(
                type=details.get("type", "string"),
                mapping=details.get("mapping"),
                indexing=details.get("indexing"),
                extractor=extractor,
                max_items=details.get("max_items"),
            )
        types.append(
            NodeType(
                name,
                tuple(spec.get("supertypes", ())),
                spec.get("abstract", False),
                fulltext.get("root"),
                fulltext.get("enable"),
                properties,
            )
        )
    return NodeTypes(types)


def from_table(types: DataFrame) -> NodeTypes:
    """From rows ``type, supertypes, abstract, fulltext_root, fulltext_enabled,
    properties array<struct<name,type,mapping,indexing,extractor>>``.

    The table holds configuration, one row per node type, so it is read to the driver.
    """
    config = {}
    for row in types.collect():
        properties = {}
        for p in row.properties or []:
            details = {k: v for k, v in p.asDict().items() if k != "name" and v is not None}
            if details.get("indexing") is True:
                details.pop("indexing")
            properties[p.name] = details
        config[row.type] = {
            "supertypes": tuple(row.supertypes or ()),
            "abstract": bool(row.abstract),
            "fulltext": {"root": row.fulltext_root, "enable": row.fulltext_enabled},
            "properties": properties,
        }
    return from_config(config)
