"""CSV in and out, file statistics, compaction of Parquet directories."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadence.schema import PLAN_CSV, TIMETABLE_API, TIMETABLE_CSV

TARGET_FILE_BYTES = 256 << 20


def read_plan(spark: SparkSession, path: str) -> DataFrame:
    """Plan headways: all text on disk, numbers by a cast that gives NULL on bad text."""
    text = spark.read.schema(PLAN_CSV).option("header", True).csv(path)
    return text.withColumns(
        {
            "plan_p50_sec": F.col("plan_p50_sec").try_cast("double"),
            "plan_n": F.col("plan_n").try_cast("int"),
        }
    )


def read_timetable(spark: SparkSession, path: str) -> DataFrame:
    """Timetable CSV, UTF-8 with an optional byte-order mark, sixteen text columns."""
    return spark.read.schema(TIMETABLE_CSV).option("header", True).option("encoding", "UTF-8").csv(path)


def normalise_timetable(api: DataFrame, line: str) -> DataFrame:
    """Landed timetable API records to the sixteen text columns; a missing value is empty."""
    names = dict(zip(TIMETABLE_CSV.fieldNames()[1:], TIMETABLE_API))
    have = set(api.columns)
    value = lambda a: F.coalesce(F.col(a).cast("string"), F.lit("")) if a in have else F.lit("")
    return api.select(F.lit(line).alias("line"), *(value(a).alias(n) for n, a in names.items()))


def stations(timetable: DataFrame) -> DataFrame:
    """One row per station code."""
    return (
        timetable.groupBy("station_cd")
        .agg(F.max_by(F.struct("fr_code", "station_nm"), F.struct("fr_code", "station_nm")).alias("s"))
        .select("station_cd", "s.fr_code", "s.station_nm")
    )


def export_csv(
    tables: Mapping[str, DataFrame], out: str, single_file: bool = False
) -> list[tuple[str, str]]:
    """Write every table as CSV with a header, without its raw JSON.

    A table that fails is reported and skipped. Files stay as parallel as the data
    unless ``single_file`` asks for one per table.
    """
    report = []
    for name, df in tables.items():
        try:
            rows = df.drop("raw_json")
            if single_file:
                rows = rows.coalesce(1)
            rows.write.mode("overwrite").option("header", True).csv(f"{out}/{name}")
            report.append((name, "ok"))
        except Exception as e:  # noqa: BLE001
            report.append((name, f"skip: {str(e).splitlines()[0]}"))
    return report


def file_list(table: DataFrame) -> DataFrame:
    """Records and bytes per data file of a file-backed table."""
    return table.groupBy(
        F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_size").alias("file_size")
    ).agg(F.count(F.lit(1)).alias("record_count"))


def file_stats(table: DataFrame, *partition: str) -> DataFrame:
    """Data files and records of a table, or of each of its partitions."""
    files = table.groupBy(*partition, F.col("_metadata.file_path").alias("file_path")).agg(
        F.count(F.lit(1)).alias("n")
    )
    return files.groupBy(*partition).agg(
        F.count(F.lit(1)).alias("data_files"), F.coalesce(F.sum("n"), F.lit(0)).alias("records")
    )


def compact(
    table: DataFrame,
    out: str,
    partition: Sequence[str] = (),
    order: Sequence[str] = (),
    target_bytes: int = TARGET_FILE_BYTES,
) -> DataFrame:
    """Rewrite a file-backed table into fewer files; returns one row of before and after.

    The number of output files follows from the bytes at hand. Rows are spread by
    range over ``partition + order``, so a partition that holds most of the rows is
    written by many tasks and a small one by a single task. With neither, each task
    reads the stored files of its share and writes them as one: about ``target_bytes``
    as stored, where a shuffle would bring the same rows as several times as much.
    """
    spark = table.sparkSession
    before = file_list(table).agg(
        F.count(F.lit(1)).alias("files_before"),
        F.coalesce(F.sum("record_count"), F.lit(0)).alias("records_before"),
        F.sum("file_size").alias("bytes"),
    ).first()
    pieces = max(1, -(-int(before["bytes"] or 0) // target_bytes))
    spread = [*partition, *order]
    rows = table.repartitionByRange(pieces, *spread) if spread else table.coalesce(pieces)
    writer = rows.write.mode("overwrite")
    if partition:
        writer = writer.partitionBy(*partition)
    writer.parquet(out)
    written = spark.read.schema(table.schema).parquet(out)
    return file_stats(written).select(
        F.lit(before["files_before"]).alias("files_before"),
        F.col("data_files").alias("files_after"),
        F.lit(before["records_before"]).alias("records_before"),
        F.col("records").alias("records_after"),
        (F.col("records") == before["records_before"]).alias("rows_unchanged"),
    )
