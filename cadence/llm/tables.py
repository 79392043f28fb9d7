"""What the operators share: columns with names that can't clash, and staged tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cadence.sources.staging import stage

__all__ = ["held_out", "numbered", "only", "parallel", "read", "release", "stage"]


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def only(df: DataFrame, **columns: str) -> DataFrame:
    """The named columns under the operator's own names; all other columns go, whatever they are called."""
    return df.select(*(F.col(f"`{name}`").alias(own) for own, name in columns.items()))


def held_out(key: Column) -> Column:
    """True for the fifth of the rows that no label is learnt from."""
    return F.crc32(key.cast("string").cast("binary")) % 5 == 0


def parallel(spark: SparkSession) -> int:
    """The session's number of shuffle partitions."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def release(spark: SparkSession) -> None:
    """Let the shuffle files of ended steps go now: Spark deletes them once the driver has collected their plans, by itself only every half hour."""
    spark.sparkContext._jvm.System.gc()


def numbered(df: DataFrame, group: str, *order: str) -> DataFrame:
    """``df`` (staged, sorted by group and order, nulls first) with ``rank``, from 0 inside each group, and ``n``, the group's rows.

    Rows are range-partitioned by group and order, so a group that holds much of the table is cut into many
    partitions; a partition's rows are counted by group, and the counts of earlier partitions are added to the places inside one.
    """
    rows = df.repartitionByRange(group, *order).sortWithinPartitions(group, *order).withColumn("at_", F.monotonically_increasing_id())
    rows = stage(rows, "sorted").withColumn("part_", F.shiftright("at_", 33))
    counts = rows.groupBy(F.col(group).alias("g_"), F.col("part_").alias("p_")).agg(F.min("at_").alias("low_"), F.count("*").alias("c_"))
    whole = Window.partitionBy("g_")
    before = whole.orderBy("p_").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("g_", "p_", (F.coalesce(F.sum("c_").over(before), F.lit(0)) - F.col("low_")).alias("base_"), F.sum("c_").over(whole).alias("n"))
    rows = rows.join(counts, F.col(group).eqNullSafe(F.col("g_")) & (F.col("part_") == F.col("p_")))
    return rows.withColumn("rank", F.col("at_") + F.col("base_")).drop("at_", "part_", "g_", "p_", "base_")
