"""Split off documents that cannot be indexed, with a reference code each."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def reason(checks: Mapping[str, Column]) -> Column:
    """The first failed check by name, null if all hold."""
    failed = [F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in checks.items()]
    return F.coalesce(*failed) if failed else F.lit(None).cast("string")


def valid_json(payload: Column) -> Column:
    return F.try_parse_json(payload).isNotNull()


def split(
    docs: DataFrame, checks: Mapping[str, Column], run_id: str = "", payload: Column | None = None
) -> tuple[DataFrame, DataFrame]:
    """(good documents, error rows ``reference, run_id, doc_id, reason, payload``)."""
    judged = docs.withColumn("_reason", reason(checks))
    content = payload if payload is not None else F.to_json(F.struct(*[F.col(c) for c in docs.columns]))
    bad = judged.where(F.col("_reason").isNotNull()).select(
        F.substring(F.sha1(F.concat_ws("|", F.lit(run_id), F.col("doc_id").cast("string"), "_reason").cast("binary")), 1, 12).alias("reference"),
        F.lit(run_id).alias("run_id"),
        F.col("doc_id").cast("string").alias("doc_id"),
        F.col("_reason").alias("reason"),
        content.alias("payload"),
    )
    return judged.where(F.col("_reason").isNull()).drop("_reason"), bad


def counted(errors: DataFrame, observation: Observation) -> DataFrame:
    """Counts the errors while they are written, without another pass."""
    return errors.observe(observation, F.count("*").alias("errors"))
