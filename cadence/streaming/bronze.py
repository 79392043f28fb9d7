"""Continuous ingest: one read of the stream feeds the log and the latest state.

Both sinks are idempotent per micro-batch, so a replayed batch changes nothing:
the log keeps each batch in a partition of its own and overwrites it, and the
state is a maximum per key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cadence.operators.latest import latest_per_key
from cadence.schema import POSITION_CURRENT, POSITION_LOG
from cadence.sources.events import position_log
from cadence.sources.staging import stage

LOG_DDL = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in POSITION_LOG.fields)
CURRENT_DDL = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in POSITION_CURRENT.fields)
STATE_ORDER = ("recptn_dt", "ingested_at")


def key_day(key: str = "event_id"):
    """Partition of the state table: the date a key ends in, else one shared partition.

    A function of the key alone, so a key never moves between partitions, and a
    batch of today's events touches today's partition only.
    """
    day = F.regexp_extract(key, r"(\d{4}-\d{2}-\d{2})$", 1)
    return F.when(day == "", "undated").otherwise(day)


def append_log(rows: DataFrame, path: str, batch_id: int) -> None:
    """Append one batch, partitioned by date."""
    (
        rows.select(*POSITION_LOG.fieldNames(), *_extra(rows), F.lit(batch_id).alias("batch_id"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("dt", "batch_id")
        .parquet(path)
    )


#: Bits of a day's key filter, and how many of them a key sets.
FILTER_BITS = 1 << 30
FILTER_HASHES = 2
KEYS_DDL = "dt string, bucket bigint, bits binary, batch_id bigint"


def append_once(rows: DataFrame, path: str, batch_id: int, key: str = "raw_json") -> None:
    """Append the rows of one batch that the log doesn't hold yet, however long ago they first came.

    A watermark forgets; this does not. Every batch leaves a filter of its keys per date: bitmaps of hashed keys, in
    pieces. A key whose bits are not all set in the date's filters is new for certain and is appended. Only the others, true
    replays and a few by chance, are compared with the stored rows of their date. Of rows with one key in the batch itself one
    stays. A replayed micro-batch looks at the other batches only, and so appends the same rows again to its own partition.
    """
    spark = rows.sparkSession
    hashes = [F.pmod(F.xxhash64(key, F.lit(i)), F.lit(FILTER_BITS)) for i in range(FILTER_HASHES)]
    batch = stage(rows.dropDuplicates([key]).withColumn("__bits", F.array(*hashes)), "batch")
    bits = batch.select(key, F.col("dt").alias("__dt"), F.explode("__bits").alias("bit"))
    bits = bits.select(key, "__dt", F.bitmap_bucket_number("bit").alias("bucket"), F.bitmap_bit_position("bit").alias("at"))
    filters = _stored(spark, f"{path}-keys", KEYS_DDL).where(F.col("batch_id") != batch_id).drop("batch_id")
    byte = F.conv(F.hex(F.substring("bits", F.floor(F.col("at") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    is_set = F.floor(byte / F.pow(F.lit(2), F.col("at") % 8)) % 2 == 1
    met = bits.join(filters, F.col("__dt").eqNullSafe(F.col("dt")) & (bits["bucket"] == filters["bucket"])).where(is_set)
    met = met.select(key, filters["bucket"].alias("b"), "at").distinct().groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    wanted = bits.select(key, "bucket", "at").distinct().groupBy(key).agg(F.count(F.lit(1)).alias("of"))
    maybe = stage(met.join(wanted, key).where("n = of").select(key), "maybe")
    stored = _stored(spark, path, f"{LOG_DDL}, batch_id bigint").where(F.col("batch_id") != batch_id)
    days = batch.select(F.coalesce("dt", F.lit("")).alias("d")).distinct()
    stored = stored.withColumn("d", F.coalesce("dt", F.lit(""))).join(days, "d", "left_semi").select(key)
    known = maybe.join(stored, key, "left_semi")
    fresh = stage(batch.join(known, key, "left_anti").drop("__bits"), "fresh")
    append_log(fresh, path, batch_id)
    own = bits.join(fresh.select(key), key, "left_semi").groupBy(F.col("__dt").alias("dt"), "bucket").agg(F.bitmap_construct_agg("at").alias("bits"))
    own.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(f"{path}-keys")


def upsert_current(rows: DataFrame, path: str, batch_id: int = 0, share: float = 0.25) -> None:
    """Merge one batch into the state: it appends its own latest rows, as a delta per date of the key, and nothing else.

    Where the deltas of a date have grown past ``share`` of the rows that were last folded for it, that date is folded: its state is
    written anew as a base, and a line in ``_folds`` says which batches it covers. So a row is rewritten a few times
    in all, whatever the number of batches, and dates that get no rows are never touched again. Folders that a fold
    supersedes are no longer read.
    """
    spark = rows.sparkSession
    cols = [*POSITION_CURRENT.fieldNames(), *_extra(rows)]
    order = (*STATE_ORDER, *_extra(rows))
    delta = latest_per_key(rows.select(*cols), order=order).withColumn("key_day", key_day()).withColumn("batch_id", F.lit(batch_id))
    _partitioned(delta, f"{path}/delta", "batch_id", "key_day")
    ddl = "".join(f", {c} {rows.schema[c].dataType.simpleString()}" for c in _extra(rows))
    mine = _deltas(spark, path, ddl).where(F.col("batch_id") == batch_id).select("key_day").distinct()
    waiting = _unfolded(spark, path, ddl).join(mine, "key_day", "left_semi").groupBy("key_day").agg(F.count(F.lit(1)).alias("n"))
    due = waiting.join(_folds(spark, path), "key_day", "left").where(F.col("n") >= share * F.coalesce("folded", F.lit(FIRST_FOLD)))
    days = [r["key_day"] for r in due.select("key_day").collect()]  # dates of one batch
    if days:
        fold(spark, path, days, batch_id, ddl)


#: Rows of a date that are kept as deltas before its first fold, as if so many had been folded, times ``share``.
FIRST_FOLD = 4_000_000
FOLDS = "key_day string, through bigint, folded bigint"


def fold(spark: SparkSession, path: str, days: list[str], through: int, extra: str = "") -> None:
    """Write the state of some dates as a base that covers all batches up to ``through``; a repeated fold overwrites itself."""
    state = _latest(spark, path, extra).where(F.col("key_day").isin(*days)).withColumn("through", F.lit(through))
    _partitioned(state, f"{path}/base", "key_day", "through")
    written = _bases(spark, path, extra).where(F.col("key_day").isin(*days) & (F.col("through") == through))
    done = written.groupBy("key_day", "through").agg(F.count(F.lit(1)).alias("folded"))
    done.coalesce(1).write.mode("append").json(f"{path}/_folds")


def _partitioned(rows: DataFrame, path: str, *by: str) -> None:
    """Overwrite the partitions that the rows belong to; by range of the key, so that a large date is written by many tasks."""
    placed = rows.repartitionByRange("key_day", "event_id").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    placed.partitionBy(*by).parquet(path)


def _stored(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """A table that may not be there yet: a first use creates it empty, later uses leave it alone."""
    spark.createDataFrame([], ddl).write.mode("ignore").parquet(path)
    return spark.read.schema(ddl).parquet(path)


def _deltas(spark: SparkSession, path: str, extra: str) -> DataFrame:
    return _stored(spark, f"{path}/delta", f"{CURRENT_DDL}{extra}, batch_id bigint, key_day string")


def _bases(spark: SparkSession, path: str, extra: str) -> DataFrame:
    return _stored(spark, f"{path}/base", f"{CURRENT_DDL}{extra}, key_day string, through bigint")


def _folds(spark: SparkSession, path: str) -> DataFrame:
    """The newest fold of each date: one short row a date."""
    spark.createDataFrame([], FOLDS).write.mode("ignore").json(f"{path}/_folds")
    rows = spark.read.schema(FOLDS).json(f"{path}/_folds")
    return rows.groupBy("key_day").agg(F.max("through").alias("through"), F.max_by("folded", "through").alias("folded"))


def _unfolded(spark: SparkSession, path: str, extra: str) -> DataFrame:
    done = _folds(spark, path).select("key_day", "through")
    rows = _deltas(spark, path, extra).join(done, "key_day", "left")
    return rows.where(F.col("through").isNull() | (F.col("batch_id") > F.col("through"))).drop("through", "batch_id")


def _latest(spark: SparkSession, path: str, extra: str) -> DataFrame:
    done = _folds(spark, path).select("key_day", "through")
    base = _bases(spark, path, extra).join(done, ["key_day", "through"], "left_semi").drop("through")
    cols = [f.split()[0] for f in extra.split(", ") if f]
    rows = base.unionByName(_unfolded(spark, path, extra))
    return latest_per_key(rows, order=(*STATE_ORDER, *cols))


def read_log(spark: SparkSession, path: str, extra: str = "") -> DataFrame:
    return spark.read.schema(f"{LOG_DDL}, batch_id bigint{extra}").parquet(path).drop("batch_id")


def read_current(spark: SparkSession, path: str, extra: str = "") -> DataFrame:
    """The state: per key the latest row of the folded base and the deltas since."""
    return _latest(spark, path, extra).drop("key_day")


def fan_out(
    raw: DataFrame,
    log_path: str,
    current_path: str,
    checkpoint: str,
    once: bool = False,
    every: str = "30 seconds",
    replays: bool = True,
) -> StreamingQuery:
    """Start the ingest query over a stream with a ``raw_json`` column.

    The log keeps records that were delivered twice, or (``replays=False``) drops them, see :func:`append_once`.
    """

    def both(batch: DataFrame, batch_id: int) -> None:
        rows = position_log(batch).persist()
        try:
            (append_log if replays else append_once)(rows, log_path, batch_id)
            upsert_current(rows, current_path, batch_id)
        finally:
            rows.unpersist()

    writer = raw.writeStream.foreachBatch(both).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime=every)
    return writer.start()


def drop_replays(events: DataFrame, key: str = "event_id", ts: str = "recptn_ts", delay: str = "10 minutes") -> DataFrame:
    """At-least-once delivery made duplicate-free within the watermark."""
    return events.withWatermark(ts, delay).dropDuplicatesWithinWatermark([key])


def _extra(rows: DataFrame) -> list[str]:
    return [c for c in rows.columns if c not in POSITION_LOG.fieldNames()]

