"""Changes to an index: logged in batches, merged on read, folded in by compaction.

Changes arrive in small batches and touch documents anywhere. Rewriting stored
partitions for each batch would cost the whole table again and again, so a batch
only adds its own folder to the log. Readers put the log over the base; a
rebuild or a compaction folds it in.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from treeseek.model import FLUSH_OCTETS
from treeseek.operators import rollup
from treeseek.operators.projection import publish_to_target, scope_to_live

INDEX, REMOVE = "index", "remove"


def latest(changes: DataFrame, key: Sequence[str], order: str = "seq") -> DataFrame:
    """The last change per key.

    An aggregation and not a ranked window: a key with very many changes is
    reduced where its rows lie.
    """
    others = [c for c in changes.columns if c not in key]
    best = F.max_by(F.struct(*others), F.col(order)).alias("last")
    return changes.groupBy(*key).agg(best).select(*key, "last.*").select(changes.columns)


def merge(base: DataFrame, changes: DataFrame, key: Sequence[str], order: str = "seq", op: str = "op") -> DataFrame:
    """``base`` with changes applied: changed and removed rows out, new ones in."""
    last = latest(changes, key, order)
    kept = base.join(last.select(*key), list(key), "left_anti")
    return kept.select(base.columns).unionByName(last.where(F.col(op) == INDEX).select(base.columns))


def prepare(changes: DataFrame, index_all_workspaces: bool = True) -> DataFrame:
    """Changes as they concern the index: live only if so set, in their target workspace."""
    return publish_to_target(scope_to_live(changes, index_all_workspaces))


class ChangeLog:
    """A folder with one sub-folder per batch."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema

    def write(self, batch: DataFrame, batch_id: int) -> None:
        """A replayed batch replaces its own folder, so it counts once."""
        batch.select(self.schema.fieldNames()).write.mode("overwrite").parquet(f"{self.path}/batch={batch_id}")

    def read(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/batch=*")

    def start(
        self,
        stream: DataFrame,
        checkpoint: str,
        step: Callable[[DataFrame], DataFrame] | None = None,
        once: bool = True,
    ) -> StreamingQuery:
        """Log the stream; with ``once`` it stops when all that is there has been read."""

        def flush(batch: DataFrame, batch_id: int) -> None:
            self.write(step(batch) if step else batch, batch_id)

        writer = stream.writeStream.foreachBatch(flush).option("checkpointLocation", checkpoint)
        return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime="5 seconds")).start()


def read_changes(
    spark: SparkSession, path: str, schema: T.StructType, max_bytes: int = FLUSH_OCTETS, pattern: str | None = None
) -> DataFrame:
    """A stream of change files in batches of bounded size."""
    reader = spark.readStream.schema(schema).option("maxBytesPerTrigger", max_bytes)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.parquet(path)


def refresh_fulltext(
    parts: DataFrame, changed_nodes: DataFrame, new_parts: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """Parts after a batch, and the new text of the pages it touched.

    A page is touched if a changed part was filed under it before or is now, so
    a node that moves refreshes both pages. Other pages are not read again.
    """
    keys = changed_nodes.select("workspace", "dimension", F.col("node_id").alias("part_node_id")).distinct()
    before = parts.join(keys, ["workspace", "dimension", "part_node_id"], "left_semi").select(*rollup.ROOT)
    roots = before.unionByName(new_parts.select(*rollup.ROOT)).distinct()
    after = rollup.replace_parts(parts, changed_nodes, new_parts)
    refreshed = rollup.to_buckets(rollup.roll_up(rollup.chunked(rollup.touched(after, roots))))
    # A page that lost its last part stays, with nothing in it.
    return after, roots.join(refreshed, list(rollup.ROOT), "left")
