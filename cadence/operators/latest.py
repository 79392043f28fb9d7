"""Latest state per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_per_key(
    rows: DataFrame,
    key: str = "event_id",
    order: Sequence[str] = ("recptn_dt", "ingested_at"),
) -> DataFrame:
    """One row per key, the greatest by ``order``; rows without a key are left out.

    ``max_by`` combines before the shuffle, so a key that holds a large share of
    the log reaches the reducer as one row per map task.
    """
    rest = [c for c in rows.columns if c != key]
    return (
        rows.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("r"))
        .select(*(F.col(key) if c == key else F.col(f"r.{c}").alias(c) for c in rows.columns))
    )


def newest(current: DataFrame, limit: int = 10) -> DataFrame:
    """The most recently received states."""
    return (
        current.select(
            "train_no", "statn_nm", "statn_tnm", "updn_line", "train_sttus", "recptn_dt", "event_id"
        )
        .orderBy(F.desc("recptn_dt"), "event_id")
        .limit(limit)
        .drop("event_id")
    )


def last_receipt(current: DataFrame) -> DataFrame:
    """Newest receipt string per line and direction."""
    return current.groupBy("line", "updn_line").agg(F.max("recptn_dt").alias("last_recptn_dt"))


def log_and_current(log: DataFrame, current: DataFrame) -> DataFrame:
    """Both row counts and whether the log is at least as long."""
    counts = (
        log.agg(F.count(F.lit(1)).alias("n"))
        .withColumn("what", F.lit("log"))
        .unionByName(current.agg(F.count(F.lit(1)).alias("n")).withColumn("what", F.lit("current")))
    )
    pick = lambda w: F.max(F.when(F.col("what") == w, F.col("n")))
    return counts.agg(pick("log").alias("log_rows"), pick("current").alias("current_rows")).withColumn(
        "ok", F.col("log_rows") >= F.col("current_rows")
    )


def count_by(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("cnt"))
