"""Latest state of filings from repeated batches, with an id that lasts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def upsert_latest(rows: DataFrame, key: str = "source_relpath", order: str = "processed_at_utc", durable: str = "filing_id") -> DataFrame:
    """The last row of each key by ``order``, but with the ``durable`` value of its first row.

    One aggregation with partial combining, so a key that was processed a million times is combined before the shuffle.
    Null keys are dropped; of rows with equal order the one with the greatest remaining values counts.
    """
    rest = [c for c in rows.columns if c not in (key, durable)]
    last = F.max_by(F.struct(*rest), F.struct(order, *(F.col(c).cast("string") for c in rest if c != order)))
    first = F.min_by(durable, F.struct(order, durable))
    return rows.filter(F.col(key).isNotNull()).groupBy(key).agg(first.alias(durable), last.alias("_last")).select(key, durable, *(F.col(f"_last.{c}").alias(c) for c in rest)).select(*rows.columns)


def merge(current: DataFrame, batch: DataFrame, **names: str) -> DataFrame:
    """State after a batch: updates replace all but the id, new keys are added."""
    return upsert_latest(current.unionByName(batch), **names)


def children_of(current_children: DataFrame, batch_children: DataFrame, ids: DataFrame) -> DataFrame:
    """Child rows after a batch: those of the filings in ``ids`` (the batch's) are replaced as a whole."""
    return current_children.join(ids.select("filing_id").distinct(), "filing_id", "left_anti").unionByName(batch_children)


def publication(incoming: DataFrame, published: DataFrame, delete_raw: bool = False) -> DataFrame:
    """What to do with parsed filings whose target may exist: ``action`` and the ``status`` to log.

    ``published`` has source_relpath and source_sha256. The same content is a refresh (also after a run that died between
    publishing and committing), other content is a conflict and is not written. Raw files may go only where it is safe.
    """
    there = published.groupBy(F.col("source_relpath").alias("_path")).agg(F.max("source_sha256").alias("_sha"))
    j = incoming.join(there, F.col("source_relpath") == F.col("_path"), "left")
    action = F.when(F.col("_path").isNull(), "publish").when(F.col("_sha").eqNullSafe(F.col("source_sha256")), "refresh").otherwise("conflict")
    status = (
        F.when(action == "conflict", "conflict").when(~F.coalesce("delete_safe", F.lit(False)), "processed_with_warnings_raw_retained")
        .otherwise("processed_and_raw_deleted" if delete_raw else "processed_raw_retained")
    )
    return j.withColumn("action", action).withColumn("status", status).drop("_path", "_sha")
