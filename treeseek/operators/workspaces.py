"""Workspaces that hold changes only, made whole where the changes reach.

A workspace is stored as the nodes that were changed, added or removed in it;
everything else shows through from its base. What a change reaches in the tree
has other paths, flags or page texts in the workspace than in the base:

- the nodes above a changed node, which place it;
- the page that a changed node belongs to, with all parts of that page, and the
  page that it was moved away from: their text is rolled up anew;
- everything below a node that was moved, hidden, removed or that changed its
  order or type.

:func:`complete` copies those, and only those, from the nearest workspace of the
chain. What is left shows the same in the workspace as in the base, so nothing
of it is copied: the work goes with the changes, not with the base. A step looks
up one level for all workspaces of a layer together.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from treeseek.model import KEYS
from treeseek.operators.overlay import chain
from treeseek.session import materialise, materialise_counted

_ORIGIN = "source_workspace"
_SLIM = (*KEYS, "parent_id", "type", "tags", "sort_index")


def layers(workspaces: Mapping[str, str | None]) -> list[list[str]]:
    """The workspaces with a base, those first whose bases come before them."""
    by_length: dict[int, list[str]] = {}
    for name in sorted(workspaces):
        by_length.setdefault(len(chain(dict(workspaces), name)), []).append(name)
    return [names for length, names in sorted(by_length.items()) if length > 1]


def complete(
    nodes: DataFrame, workspaces: Mapping[str, str | None], types: DataFrame, variants: bool = False
) -> DataFrame:
    """``nodes`` and the copies that make changed parts of each workspace whole.

    ``variants``: a copied node brings all its dimensions, for nodes that may
    stand in for missing ones.
    """
    roots = F.broadcast(types.select("type", F.coalesce("fulltext_root", F.lit(False)).alias("is_root")))
    slim = nodes.select(*_SLIM, F.col("workspace").alias(_ORIGIN)).join(roots, "type", "left")
    slim = slim.withColumn("is_root", F.coalesce("is_root", F.lit(False)))
    known, copies = materialise(slim, "placed-nodes"), None
    for names in layers(workspaces):
        found = _Layer(known, names, workspaces, variants).copies()
        known = materialise(known.unionByName(found), "placed-nodes")
        copies = found if copies is None else copies.unionByName(found)
    if copies is None:
        return nodes
    wanted = copies.select(
        F.col("workspace").alias("_copied_to"), F.col(_ORIGIN).alias("workspace"), "dimension", "node_id"
    )
    copied = nodes.join(wanted, list(KEYS)).select(
        *[F.col("_copied_to").alias(c) if c == "workspace" else F.col(c) for c in nodes.columns]
    )
    return nodes.unionByName(copied)


class _Layer:
    """Workspaces whose bases are complete already."""

    def __init__(self, known: DataFrame, names: list[str], workspaces: Mapping[str, str | None], variants: bool):
        pairs = [
            (name, base, position)
            for name in names
            for position, base in enumerate(chain(dict(workspaces), name)[1:])
        ]
        spark = known.sparkSession
        # Configuration: as many rows as workspaces have bases.
        self.chains = F.broadcast(spark.createDataFrame(pairs, "special string, general string, position int"))
        self.own = known.where(F.col("workspace").isin(names))
        self.below = known.where(~F.col("workspace").isin(names))
        self.variants = variants

    def seen_from(self, rows: DataFrame) -> DataFrame:
        """Base rows as workspaces of this layer may see them, with the position of their own in the chain."""
        return rows.join(self.chains, rows["workspace"] == F.col("general")).select(
            F.col("special").alias("workspace"), *[c for c in rows.columns if c != "workspace"], "position"
        )

    def nearest(self, wanted: DataFrame) -> DataFrame:
        """The base rows that the keys in ``wanted`` (workspace, dimension, node_id) show."""
        met = self.below.join(wanted.select("dimension", "node_id").distinct(), ["dimension", "node_id"], "left_semi")
        seen = self.seen_from(met).join(wanted, list(KEYS), "left_semi")
        rest = [c for c in seen.columns if c not in KEYS]
        return seen.groupBy(*KEYS).agg(F.min_by(F.struct(*rest), "position").alias("row")).select(
            *KEYS, *[F.col("row").getField(c).alias(c) for c in rest if c != "position"]
        )

    def children(self, parents: DataFrame) -> DataFrame:
        """Rows that these nodes show below them: own ones, and those of the nearest base that has them."""
        at = parents.select("workspace", "dimension", F.col("node_id").alias("parent_id"))
        own = self.own.join(at, ["workspace", "dimension", "parent_id"], "left_semi")
        met = self.below.join(at.select("dimension", "parent_id").distinct(), ["dimension", "parent_id"], "left_semi")
        offered = self.seen_from(met).join(at, ["workspace", "dimension", "parent_id"], "left_semi")
        # A nearer workspace may have the node elsewhere.
        shown = self.nearest(offered.select(*KEYS).distinct()).join(at, ["workspace", "dimension", "parent_id"], "left_semi")
        shown = shown.join(self.own.select(*KEYS), list(KEYS), "left_anti")
        return own.unionByName(shown.select(own.columns))

    def copies(self) -> DataFrame:
        before = materialise(self.nearest(self.own.select(*KEYS)), "replaced-nodes")
        pages, above = self._upwards(before)
        below = self._downwards(pages, self._reshaped(before))
        found = above.unionByName(below).join(self.own.select(*KEYS), list(KEYS), "left_anti")
        return materialise(found.dropDuplicates(list(KEYS)), "inherited-nodes")

    def _reshaped(self, before: DataFrame) -> DataFrame:
        """Keys of changed nodes below which the tree is another one."""
        old = before.select(*KEYS, F.struct("parent_id", "type", "tags", "sort_index").alias("old"))
        same = F.struct("parent_id", "type", "tags", "sort_index").eqNullSafe(F.col("old"))
        return self.own.join(old, list(KEYS)).where(~same).select(*KEYS)

    def _upwards(self, before: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Keys of the pages of changed nodes, and the base rows above changed nodes."""
        own = self.own
        seek = F.max(F.col("seek")).alias("seek")

        def parents(rows: DataFrame) -> DataFrame:
            going = rows.where("parent_id is not null")
            return going.select(
                "workspace", "dimension", F.col("parent_id").alias("node_id"),
                (F.col("seek") & ~F.col("is_root")).alias("seek"),
            )

        def others(rows: DataFrame) -> DataFrame:
            """The same nodes in other dimensions."""
            at = rows.select("workspace", "node_id").distinct()
            met = self.below.join(at.select("node_id").distinct(), "node_id", "left_semi")
            return self.seen_from(met).join(at, ["workspace", "node_id"], "left_semi").select(
                *KEYS, F.lit(False).alias("seek")
            )

        first = own.withColumn("seek", F.lit(True))
        wanted = parents(first).unionByName(parents(before.withColumn("seek", F.lit(True))))
        if self.variants:
            wanted = wanted.unionByName(others(own))
        pages = [own.where("is_root").select(*KEYS)]
        above, visited = [], None
        while True:
            frontier = wanted.groupBy(*KEYS).agg(seek)
            if visited is not None:
                done = visited.groupBy(*KEYS).agg(F.max("seek").alias("sought"))
                frontier = frontier.join(done, list(KEYS), "left").where("sought is null or (seek and not sought)")
                frontier = frontier.drop("sought")
            frontier, n = materialise_counted(frontier, "workspace-frontier")
            if not n:
                break
            visited = frontier if visited is None else visited.unionByName(frontier)
            mine = own.join(frontier, list(KEYS))
            base = self.nearest(frontier.select(*KEYS).join(own.select(*KEYS), list(KEYS), "left_anti"))
            base = materialise(base.join(frontier, list(KEYS)), "workspace-above")
            rows = mine.unionByName(base.select(mine.columns))
            pages.append(rows.where("seek and is_root").select(*KEYS))
            above.append(base.select(own.columns))
            wanted = parents(rows)
            if self.variants:
                wanted = wanted.unionByName(others(base))
        return _union(pages).distinct(), _union([own.limit(0), *above])

    def _downwards(self, pages: DataFrame, reshaped: DataFrame) -> DataFrame:
        """Base rows below: the parts of pages, and all of what has another shape now."""
        starts = pages.withColumn("all", F.lit(False)).unionByName(reshaped.withColumn("all", F.lit(True)))
        found, visited = [self.own.limit(0)], None
        frontier = starts.groupBy(*KEYS).agg(F.max("all").alias("all"))
        while True:
            if visited is not None:
                done = visited.groupBy(*KEYS).agg(F.max("all").alias("had_all"))
                frontier = frontier.join(done, list(KEYS), "left").where("had_all is null or (all and not had_all)")
                frontier = frontier.drop("had_all")
            frontier, n = materialise_counted(frontier, "workspace-frontier")
            if not n:
                return _union(found)
            visited = frontier if visited is None else visited.unionByName(frontier)
            up = frontier.select("workspace", "dimension", F.col("node_id").alias("parent_id"), "all")
            rows = self.children(frontier).join(up, ["workspace", "dimension", "parent_id"])
            # A page inside of a page has its own text.
            rows = materialise(rows.where("all or not is_root"), "workspace-below")
            found.append(rows.select(self.own.columns))
            frontier = rows.groupBy(*KEYS).agg(F.max("all").alias("all"))


def _union(frames: list[DataFrame]) -> DataFrame:
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result


def tombstones(tree: DataFrame, workspaces: Mapping[str, str | None], doc_id) -> DataFrame:
    """Rows that say that a workspace has removed a node which its bases may have."""
    changed = [name for names in layers(workspaces) for name in names]
    return tree.where(F.col("removed") & F.col("workspace").isin(changed)).select(
        doc_id(F.col("node_id"), F.col("workspace"), F.col("dimension")).alias("doc_id"), *KEYS,
        F.lit(True).alias("deleted"),
    )
