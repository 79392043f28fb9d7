"""Freshness from date ranges that add up.

A range leaves two small tables: records and lag per line and minute, and which trains were heard in that minute as bitmaps over
numbered trains. Sums add and bitmaps unite, so any number of ranges, in any order, with late rows in whichever
range brings them, give the mart of a full run, distinct trains included. A range reads its own log rows and rewrites its own
partition only; run again, it replaces what it left.

Train numbers are given once and never change: a range appends those of the trains that no range has met. One range runs at a time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cadence.operators.freshness import per_train_minutes
from cadence.params import Params
from cadence.sources.staging import stage

TRAINS = "train_no string, train bigint"
SUMS = "line string, minute_ts timestamp, records bigint, lag_sum bigint, lag_n bigint"
HEARD = "line string, minute_ts timestamp, bucket bigint, bits binary"
#: Slices in which new trains are numbered.
SLICES = 64


def _table(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    spark.createDataFrame([], ddl).write.mode("ignore").parquet(path)
    return spark.read.schema(ddl).parquet(path)


def _number(spark: SparkSession, root: str, trains: DataFrame) -> DataFrame:
    """All known trains with their numbers, those of ``trains`` among them."""
    known = _table(spark, f"{root}/trains", TRAINS)
    new = stage(trains.join(known, "train_no", "left_anti").withColumn("slice", F.pmod(F.xxhash64("train_no"), F.lit(SLICES))), "trains")
    counts = {r["slice"]: r["count"] for r in new.groupBy("slice").count().collect()}  # at most SLICES rows
    if counts:
        start, first = known.agg(F.coalesce(F.max("train") + 1, F.lit(0))).first()[0], {}
        for k in sorted(counts):
            first[k], start = start, start + counts[k]
        base = F.create_map(*(F.lit(x) for k in first for x in (k, first[k])))[F.col("slice")]
        at = F.row_number().over(Window.partitionBy("slice").orderBy("train_no")) - 1
        new.select("train_no", (base + at).cast("bigint").alias("train")).write.mode("append").parquet(f"{root}/trains")
    return spark.read.schema(TRAINS).parquet(f"{root}/trains")


def add_range(spark: SparkSession, root: str, range_id: str, log: DataFrame, p: Params = Params()) -> None:
    """Add one range of log rows, or replace what it left before."""
    heard = stage(per_train_minutes(log, p), "heard")
    numbers = _number(spark, root, heard.select("train_no").where(F.col("train_no").isNotNull()).distinct())
    sums = heard.groupBy("line", "minute_ts").agg(F.sum("n").alias("records"), F.sum("lag_sum").alias("lag_sum"), F.sum("lag_n").alias("lag_n"))
    bits = (
        heard.join(numbers, "train_no")
        .groupBy("line", "minute_ts", F.bitmap_bucket_number("train").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("train")).alias("bits"))
    )
    for name, rows in (("sums", sums), ("heard", bits)):
        placed = rows.withColumn("range_id", F.lit(range_id)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        placed.partitionBy("range_id").parquet(f"{root}/{name}")


def read_freshness(spark: SparkSession, root: str) -> DataFrame:
    """The freshness mart of all ranges."""
    sums = _table(spark, f"{root}/sums", SUMS).groupBy("line", "minute_ts").agg(*(F.sum(c).alias(c) for c in ("records", "lag_sum", "lag_n")))
    bits = _table(spark, f"{root}/heard", HEARD).groupBy("line", "minute_ts", "bucket").agg(F.bitmap_count(F.bitmap_or_agg("bits")).alias("n"))
    trains = bits.groupBy(F.col("line").alias("__l"), F.col("minute_ts").alias("__m")).agg(F.sum("n").alias("n"))
    both = sums.join(trains, F.col("line").eqNullSafe(F.col("__l")) & F.col("minute_ts").eqNullSafe(F.col("__m")), "left")
    return both.select(
        "line", "minute_ts", "records", F.coalesce("n", F.lit(0)).alias("distinct_trains"),
        F.round(F.try_divide("lag_sum", "lag_n"), 1).alias("ingest_lag_avg_sec"),
    )
