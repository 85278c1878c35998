"""Bring the live index up to date with a batch of changed nodes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from treeseek.functions.html import BUCKETS
from treeseek.functions.paths import ancestors
from treeseek.model import KEYS
from treeseek.operators import hierarchy, projection, rollup, text_index, validity
from treeseek.operators.filters import disjunction
from treeseek.plans.build import BuildConfig, checks_of, skeleton, variation_frame
from treeseek.plans.publish import IndexStore
from treeseek.session import materialise, materialise_counted
from treeseek.streaming.changes import REMOVE, latest, prepare

_KEYS = list(KEYS)
# Up to this many keys are looked up as literals, beyond it the join alone decides.
LOOKUP = 1_000


def lookup(df: DataFrame, keys: DataFrame, n: int, column: str = "node_id") -> DataFrame:
    """Rows of ``df`` under ``keys``, which has ``n`` rows and the key columns of ``df``.

    The ids of a small batch also go down to the files, where order and Bloom
    filters rule most of them out; the join keeps the result exact.
    """
    if n <= LOOKUP:
        df = df.where(F.col(column).isin([r[0] for r in keys.select(column).distinct().collect()]))
    return df.join(keys, keys.columns, "left_semi")


def below(tree: DataFrame, changed: DataFrame, n: int) -> DataFrame:
    """Keys of what lies below changed nodes, where these were placed before."""
    place = ["workspace", "dimension", "path"]
    marked = lookup(tree, changed, n).select(*place)
    if n <= LOOKUP:
        # Literal paths go down to the files; which workspace and dimension, the join below decides.
        paths = [r.path for r in marked.select("path").distinct().collect()]
        tree = tree.where(disjunction(F.col("path").startswith(p + "/") for p in paths))
    # Only paths as deep as a changed one can match, so that with changes far down the top of the tree,
    # which all rows share, is not among the keys.
    depth = F.size(F.split(F.col("path"), "/"))
    shallowest, deepest = marked.agg(F.min(depth), F.max(depth)).first()
    if shallowest is None:
        return tree.select(*_KEYS).limit(0)
    above = F.slice(ancestors(F.col("path")), F.lit(shallowest), F.lit(deepest - shallowest + 1))
    prefixes = tree.select(*_KEYS, F.explode(above).alias("path"))
    return prefixes.join(marked, place, "left_semi").select(*_KEYS).distinct()


def in_all_dimensions(changes: DataFrame, config: BuildConfig) -> DataFrame:
    """Changed keys, also in the dimensions that fall back to theirs."""
    keys = changes.select(*_KEYS)
    if not config.variation:
        return keys.distinct()
    edges = variation_frame(changes.sparkSession, config).select(F.col("general").alias("dimension"), "special")
    others = keys.join(F.broadcast(edges), "dimension").select("workspace", F.col("special").alias("dimension"), "node_id")
    return keys.unionByName(others).distinct()


def apply_changes(
    store: IndexStore, changes: DataFrame, nodes: DataFrame, config: BuildConfig, batch_id: int
) -> None:
    """Index and remove nodes, and refresh the text of every page they touch.

    ``changes(seq, op, workspace, dimension, node_id[, target_workspace])`` says
    what happened; ``nodes`` is the node table as it is now. A key that is not
    there any more, also not by fallback, leaves the index.
    """
    concerned = prepare(changes, config.index_all_workspaces)
    last, n_last = materialise_counted(latest(concerned.select("seq", "op", *_KEYS), _KEYS), "changes")
    if not n_last:
        return
    # As of before this batch, so that a batch that is sent again finds the same state.
    tree, parts, docs = (store.current(kind, before=batch_id) for kind in ("tree", "parts", "docs"))

    changed, n_changed = materialise_counted(in_all_dimensions(last, config), "changed-keys")
    keys, n = materialise_counted(
        changed.unionByName(below(tree, changed, n_changed)).distinct(), "touched-keys"
    )
    ids = keys.select("workspace", "node_id").distinct()
    stored = projection.scope_to_live(nodes, config.index_all_workspaces)
    taken_out = last.where(F.col("op") == REMOVE).select(*_KEYS)
    now = materialise(lookup(stored, ids, n).join(taken_out, _KEYS, "left_anti"), "changed-nodes")
    placed = materialise(skeleton(now, config).join(keys, _KEYS, "left_semi"), "placed-nodes")
    parents, n_parents = materialise_counted(
        placed.where(F.col("parent_id").isNotNull())
        .select("workspace", "dimension", F.col("parent_id").alias("node_id")).distinct(),
        "parents",
    )
    around = lookup(tree, parents, n_parents).join(keys, _KEYS, "left_anti")
    resolved = hierarchy.resolve(placed, config.types.frame(nodes.sparkSession), around).nodes
    removed = materialise(keys.join(resolved.select(*_KEYS), _KEYS, "left_anti"), "removed-keys")

    extracted = rollup.extract(
        now.where(projection.indexable(F.col("type"), config.type_settings)), rollup.extractors_of(config.types)
    )
    new_parts, _ = rollup.parts(extracted, resolved)
    new_parts = materialise(new_parts, "new-parts")
    # Pages that had or now have a part of a changed node; a removed page is no page any more.
    part_keys = keys.withColumnRenamed("node_id", "part_node_id")
    before = lookup(parts, part_keys, n, "part_node_id").select(*rollup.ROOT)
    as_root = removed.withColumnRenamed("node_id", "root_id")
    pages, n_pages = materialise_counted(
        before.unionByName(new_parts.select(*rollup.ROOT)).distinct().join(as_root, list(rollup.ROOT), "left_anti"),
        "touched-pages",
    )
    after = rollup.replace_parts(lookup(parts, pages, n_pages, "root_id"), keys, new_parts)
    chunks = rollup.chunked(after)
    text = rollup.to_buckets(rollup.roll_up(chunks)).withColumnRenamed("root_id", "node_id")

    projected = projection.project(now, resolved, config.types, config.type_settings, config.doc_id)
    page_keys = pages.withColumnRenamed("root_id", "node_id")
    plain = [c for c in docs.columns if c != "fulltext"]
    others = lookup(docs, page_keys, n_pages).join(keys, _KEYS, "left_anti").select(*plain)
    rewritten = projected.select(*plain).unionByName(others)
    # Text of pages in the batch is new; a projected page that lost no part keeps its old text.
    kept_text = (
        lookup(docs, keys, n).join(page_keys, _KEYS, "left_anti").select(*_KEYS, F.col("fulltext").alias("old_text"))
    )
    new_docs = (
        rewritten.join(text, _KEYS, "left")
        .join(kept_text, _KEYS, "left")
        .select(*plain, F.coalesce("fulltext", "old_text").alias("fulltext"))
    )
    # As in the build: what fails a check is left out and kept among the errors.
    good, bad = validity.split(new_docs, checks_of(config), f"batch-{batch_id}")
    bad = materialise(bad, "new-errors")
    new_docs = materialise(good, "new-docs")
    replaced, n_replaced = materialise_counted(keys.unionByName(page_keys).distinct(), "replaced-keys")

    def postings_of(some: DataFrame) -> DataFrame:
        texts = {b: F.col(f"fulltext.{b}") for b in BUCKETS}
        return text_index.invert(
            text_index.tokenise(some.where(F.col("fulltext").isNotNull()), texts, config.analyzers)
        )

    new_postings = materialise(postings_of(new_docs), "new-postings")
    old_postings = postings_of(lookup(docs, replaced, n_replaced))
    doc_ids = replaced.select(
        "workspace", "dimension",
        config.doc_id(F.col("node_id"), F.col("workspace"), F.col("dimension")).alias("doc_id"),
    )
    store.update(
        batch_id,
        {
            "tree": (keys, resolved.select(*tree.columns)),
            "parts": (part_keys, new_parts),
            "docs": (replaced, new_docs),
            "postings": (doc_ids, new_postings),
        },
        (old_postings, new_postings),
        bad,
    )


def follow(
    store: IndexStore, stream: DataFrame, nodes, config: BuildConfig, checkpoint: str, once: bool = True
):
    """Apply a stream of changes batch by batch; ``nodes`` is called for the node table of the moment."""

    def step(batch: DataFrame, batch_id: int) -> None:
        apply_changes(store, batch, nodes(), config, batch_id)

    writer = stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime="5 seconds")).start()

