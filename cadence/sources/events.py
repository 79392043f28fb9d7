"""Raw JSON records to position rows; API records to canonical events.

The same column code serves a batch and a stream.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamReader
from pyspark.sql.types import StructType

from cadence.functions.texts import as_json
from cadence.schema import API_FIELDS, EVENT, EVENT_FIELDS, RAW


def project_json(
    raw: DataFrame, column: str = "raw_json", names: Sequence[str] = EVENT_FIELDS
) -> DataFrame:
    """Event fields of a JSON text column, from one parse per record.

    Malformed records give NULL in every field, and so do values that are JSON
    objects or arrays. Text that merely starts like one is kept: for records with
    such a value the types are looked up, for all others they are not. The parse
    sits in a generator, through which Spark pushes no filter, so a filter on a
    field does not parse the record again. Other columns are kept.
    """
    wanted = StructType([EVENT[n] for n in names])
    event = F.from_json(F.col(column), wanted, {"mode": "PERMISSIVE"})
    nested = {n: F.substring(n, 1, 1).isin("{", "[") for n in names}
    types = F.transform_values(
        F.from_json(F.col(column), "map<string,variant>"), lambda _, v: F.schema_of_variant(v)
    )
    some_nested = reduce(lambda a, b: a | b, (F.coalesce(c, F.lit(False)) for c in nested.values()))
    parsed = raw.select(*raw.columns, F.inline(F.array(event))).withColumn(
        "__types", F.when(some_nested, types)
    )
    fields = [
        F.when(~nested[n] | (F.col("__types")[n] == "STRING"), F.col(n)).alias(n) for n in names
    ]
    return parsed.select(*fields, *raw.columns)


def position_log(raw: DataFrame) -> DataFrame:
    """Log rows of raw records: records without an ``event_id`` are dropped."""
    rows = project_json(raw).where(F.col("event_id").isNotNull())
    if "ingested_at" not in raw.columns:
        rows = rows.withColumn("ingested_at", F.current_timestamp())
    return rows.withColumn("dt", F.substring("recptn_dt", 1, 10))


def normalise_api(api: DataFrame) -> DataFrame:
    """API records (camelCase text columns plus ``line``) to canonical events.

    ``event_id`` is train, station, status and date joined by ``-``; a missing part
    is empty. It has no line, so two lines that share a train number share keys.
    """
    renamed = api.select("line", *(F.col(a).alias(b) for a, b in API_FIELDS.items()))
    part = lambda c: F.coalesce(F.col(c), F.lit(""))
    return renamed.select(
        F.concat_ws(
            "-",
            part("train_no"),
            part("statn_id"),
            part("train_sttus"),
            F.substring(part("recptn_dt"), 1, 10),
        ).alias("event_id"),
        "line",
        "subway_id",
        part("train_no").alias("train_no"),
        "statn_id",
        "statn_nm",
        "statn_tnm",
        "updn_line",
        "train_sttus",
        "direct_at",
        "lstcar_at",
        part("recptn_dt").alias("recptn_dt"),
        F.current_timestamp().alias("ingested_at"),
    )


def keyed_json(events: DataFrame, key: str = "train_no") -> DataFrame:
    """``key value`` records for a message sink: compact JSON keyed by one column."""
    return events.select(F.col(key).cast("string").alias("key"), as_json(*events.columns).alias("value"))


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    """Landed or dumped records, one JSON text per line."""
    return spark.read.schema(RAW.fieldNames()[0] + " string").text(path)


@dataclass(frozen=True)
class RawSource:
    """A stream of ``raw_json`` that a query resumes from its checkpoint: a landing folder, or a topic with ``servers``.

    A first run starts at the earliest record, or after the newest for a monitor that only watches what flows now
    (``start="latest"``); later runs go on where the checkpoint stands, whatever ``start`` says.
    """

    where: str
    servers: str | None = None
    start: str = "earliest"
    options: Mapping[str, str] = field(default_factory=dict)

    def __post_init__(self) -> None:
        if self.start not in ("earliest", "latest"):
            raise ValueError(f"start is {self.start}, not earliest or latest")

    def stream(self, spark: SparkSession, checkpoint: str | None = None) -> DataFrame:
        """The records; a landing folder read from its newest file on keeps that start next to ``checkpoint``."""
        if self.servers is not None:
            return self._reader(spark.readStream.format("kafka"), self.topic_options()).load().select(F.col("value").cast("string").alias("raw_json"))
        reader = self._reader(spark.readStream.schema(RAW.fieldNames()[0] + " string"), self.options)
        if self.start == "earliest":
            return reader.text(self.where)
        if checkpoint is None:
            raise ValueError("a tail of a folder needs its checkpoint, to start in the same place again")
        since = self.tail_start(spark, f"{checkpoint}-start")
        return reader.text(self.where).where(F.col("_metadata.file_modification_time") > F.lit(since)).select("raw_json")

    def topic_options(self) -> dict[str, str]:
        """Options of the Kafka reader."""
        return {"kafka.bootstrap.servers": str(self.servers), "subscribe": self.where, "startingOffsets": self.start, **self.options}

    def tail_start(self, spark: SparkSession, path: str) -> datetime:
        """The time of the newest file when the tail first started; stored then, and read ever after."""
        kept = spark.read.schema("since timestamp")
        # only names and times are listed: the content column is not read
        newest = spark.read.format("binaryFile").load(self.where).agg(F.coalesce(F.max("modificationTime"), F.lit("1970-01-01").cast("timestamp")).alias("since"))
        newest.coalesce(1).write.mode("ignore").parquet(path)
        return kept.parquet(path).first()["since"]

    @staticmethod
    def _reader(reader: DataStreamReader, options: Mapping[str, str]) -> DataStreamReader:
        for name, value in options.items():
            reader = reader.option(name, value)
        return reader


def stream_raw(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """The same records as a stream over a directory."""
    return RawSource(path, options={} if max_files is None else {"maxFilesPerTrigger": str(max_files)}).stream(spark)


def stream_kafka(
    spark: SparkSession, servers: str, topic: str, tail: bool = False, **options: str
) -> DataFrame:
    """The event topic as a stream of ``raw_json``; needs the Kafka connector package."""
    return RawSource(topic, servers, "latest" if tail else "earliest", options).stream(spark)


def dump_raw(log: DataFrame, path: str) -> None:
    """Write the raw records of a log as JSON lines, to be replayed later."""
    log.where(F.col("raw_json").isNotNull()).select("raw_json").write.mode("overwrite").text(path)
