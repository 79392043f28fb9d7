"""Headways and the headway mart.

The statistics are computed from a histogram, not from the detail rows. A valid
headway is a whole number of seconds between 1 and the cut-off, so a group has at
most ``max_headway_sec`` distinct values however many rows it holds. Counting per
``(group, headway)`` collapses on the map side, spreads a hot group over many
shuffle keys, and keeps percentiles exact; the histogram of two date ranges is the
sum of their histograms, which makes the mart incremental.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadence.functions import labels as L
from cadence.operators.ordered import with_previous
from cadence.operators.sides import counted_broadcast
from cadence.params import HEADWAY_KEYS, Params

DEFAULT_TIES = ("train_no",)
ATTRS = ("statn_nm", "branch")
GAP_COLUMNS = (
    "line", "statn_id", "statn_nm", "direction", "branch", "svc", "time_band", "day_type", "arrival_ts",
)


def label_arrivals(arrived: DataFrame, p: Params = Params()) -> DataFrame:
    """Direction, service, branch, band and day type of every known-direction arrival."""
    return arrived.where(L.known_direction()).select(
        *arrived.columns,
        L.direction(p=p).alias("direction"),
        L.service(p=p).alias("svc"),
        L.branch(p=p).alias("branch"),
        L.time_band("arrival_ts", p).alias("time_band"),
        L.day_type("arrival_ts", p).alias("day_type"),
    )


def express_lines(labelled: DataFrame, p: Params = Params()) -> DataFrame:
    """Lines that run express service at all."""
    return labelled.where(F.col("svc") == p.labels.svc_express).select("line").distinct()


def on_express_lines(labelled: DataFrame, p: Params = Params()) -> DataFrame:
    """Arrivals of lines with express service (semi-join)."""
    lines = counted_broadcast(express_lines(labelled, p), p)
    return labelled.join(lines, "line", "left_semi")


def headways(
    arrived: DataFrame,
    ties: Sequence[str] = DEFAULT_TIES,
    p: Params = Params(),
    keep: Sequence[str] = (),
    express: DataFrame | None = None,
) -> DataFrame:
    """Gap to the previous arrival with its status, one or two rows per arrival.

    Every arrival yields a row for the mixed stream; arrivals of lines with express
    service yield a second row for the gap to the previous train of the same
    service. Both gaps come from one shuffle. ``arrived`` should be a stored table:
    it is read once for the express lines, once for the hot keys and once in full.
    ``keep`` names further columns to carry along; ``express`` replaces the search
    for express lines by a given list.
    """
    lab = p.labels
    labelled = label_arrivals(arrived, p)
    rows = with_previous(
        labelled.select(
            *GAP_COLUMNS,
            *(c for c in dict.fromkeys((*ties, *keep)) if c not in GAP_COLUMNS),
        ),
        ("line", "statn_id", "direction"),
        ("arrival_ts", *ties),
        ("arrival_ts",),
        views={"prev_any": (), "prev_svc": ("svc",)},
        p=p,
    )
    lines = express_lines(labelled, p) if express is None else express.select("line").distinct()
    split = counted_broadcast(lines.withColumn("__split", F.lit(True)), p)
    mixed = F.struct(F.lit(lab.svc_all).alias("svc_type"), _gap("prev_any").alias("headway_sec"))
    alike = F.struct(F.col("svc").alias("svc_type"), _gap("prev_svc").alias("headway_sec"))
    return (
        rows.join(split, "line", "left")
        .select(
            "line", "statn_id", "statn_nm", "direction", "branch", "time_band", "day_type",
            "arrival_ts", *keep,
            F.inline(F.when(F.col("__split"), F.array(mixed, alike)).otherwise(F.array(mixed))),
        )
        .withColumn("status", L.headway_status(F.col("headway_sec"), p))
    )


def _gap(prev: str) -> Column:
    return F.unix_timestamp("arrival_ts") - F.unix_timestamp(f"{prev}.arrival_ts")


def valid_headways(classified: DataFrame) -> DataFrame:
    return classified.where(F.col("status") == "valid")


def headway_histogram(
    classified: DataFrame, keys: Sequence[str] = HEADWAY_KEYS, attrs: Sequence[str] = ATTRS
) -> DataFrame:
    """Rows per group, status and, for valid rows, attributes and headway in seconds.

    Attributes (a station's name, its branch) are part of the key rather than a
    ``max``: they hardly vary within a group, and counting alone stays a hash
    aggregate where a text ``max`` would sort every row.
    """
    valid = F.col("status") == "valid"
    return classified.groupBy(
        *keys, "status", *(F.when(valid, F.col(c)).alias(c) for c in (*attrs, "headway_sec"))
    ).agg(F.count(F.lit(1)).alias("n"))


def merge_histograms(
    a: DataFrame, b: DataFrame, keys: Sequence[str] = HEADWAY_KEYS, attrs: Sequence[str] = ATTRS
) -> DataFrame:
    """Histogram of both inputs together."""
    return (
        a.unionByName(b)
        .groupBy(*keys, "status", *attrs, "headway_sec")
        .agg(F.sum("n").alias("n"))
    )


def histogram_stats(
    hist: DataFrame,
    keys: Sequence[str] = HEADWAY_KEYS,
    attrs: Sequence[str] = ATTRS,
    p: Params = Params(),
) -> DataFrame:
    """Statistics per group, for groups with at least one valid headway.

    A percentile is the smallest headway whose running count reaches the share.
    Running count, group median and final sums share one partitioning.
    """
    group = Window.partitionBy(*keys)
    upto = group.orderBy("headway_sec").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    gap = F.col("headway_sec")
    used = F.when(gap.isNotNull(), F.col("n")).otherwise(F.lit(0))
    reach = lambda num, den: F.min(
        F.when(gap.isNotNull() & (F.col("__cum") * den >= F.col("__all") * num), gap)
    )
    weighted = (
        hist.withColumn("__cum", F.sum(used).over(upto))
        .withColumn("__all", F.sum(used).over(group))
        .withColumn("__p50", reach(1, 2).over(group))
    )
    over = gap * p.over_ratio_den > F.col("__p50") * p.over_ratio_num
    exact = "decimal(38,0)"
    sums = weighted.groupBy(*keys).agg(
        *(F.max(a).alias(a) for a in attrs),
        F.sum(used).alias("headway_samples"),
        F.max("__p50").alias("p50_sec"),
        reach(9, 10).alias("p90_sec"),
        F.sum(gap * F.col("n")).alias("__s1"),
        F.sum((gap * gap).cast("decimal(19,0)") * F.col("n").cast("decimal(18,0)")).alias("__s2"),
        F.sum(F.when(over, F.col("n")).otherwise(0)).alias("__over"),
        F.sum(F.when(F.col("status") == "gap_missing", F.col("n")).otherwise(0)).alias("n_missing"),
        F.sum(F.when(F.col("status") == "nonpos", F.col("n")).otherwise(0)).alias("n_anomaly"),
    )
    n = F.col("headway_samples")
    mean = F.col("__s1") / n
    spread = (
        n.cast("decimal(18,0)") * F.col("__s2").cast("decimal(38,0)")
        - F.col("__s1").cast("decimal(19,0)") * F.col("__s1").cast("decimal(19,0)")
    ).cast("double")
    std = F.when(n > 1, F.sqrt(spread / (n * (n - 1)).cast("double")))
    return sums.where(n > 0).select(
        *keys,
        *attrs,
        "headway_samples",
        "p50_sec",
        "p90_sec",
        F.round(mean, 0).alias("mean_sec"),
        F.round(std, 1).alias("std_sec"),
        F.round(std / F.nullif(mean, F.lit(0.0)), 3).alias("cv"),
        F.round(F.col("__over") / n, 3).alias("over_1p5x_ratio"),
        "n_missing",
        "n_anomaly",
    )


MART_COLUMNS = (
    "line", "statn_id", "statn_nm", "direction", "svc_type", "time_band", "day_type",
    "branch", "is_rush", "headway_samples", "p50_sec", "p90_sec", "mean_sec", "std_sec",
    "cv", "over_1p5x_ratio", "n_missing", "n_anomaly",
)


def mart_from_histogram(hist: DataFrame, p: Params = Params()) -> DataFrame:
    """The 18-column mart. Rows without a line never reach it."""
    return (
        histogram_stats(hist.where(F.col("line").isNotNull()), p=p)
        .withColumn("is_rush", L.is_rush(p=p))
        .select(*MART_COLUMNS)
    )


def headway_mart(
    arrived: DataFrame, ties: Sequence[str] = DEFAULT_TIES, p: Params = Params()
) -> DataFrame:
    """Regularity per line, station, direction, service, time band and day type."""
    return mart_from_histogram(headway_histogram(headways(arrived, ties, p)), p)


def exclusion_counts(classified: DataFrame) -> DataFrame:
    """Rows kept out of the statistics, per group."""
    return classified.groupBy(*HEADWAY_KEYS).agg(
        F.count_if(F.col("status") == "gap_missing").alias("n_missing"),
        F.count_if(F.col("status") == "nonpos").alias("n_anomaly"),
    )


def group_medians(classified: DataFrame, p: Params = Params()) -> DataFrame:
    """Median valid headway per group, the yardstick of the over-ratio."""
    return histogram_stats(headway_histogram(classified, attrs=()), attrs=(), p=p).select(
        *HEADWAY_KEYS, F.col("p50_sec").alias("grp_p50")
    )


def exploratory_mart(
    arrived: DataFrame,
    min_samples: int,
    ties: Sequence[str] = DEFAULT_TIES,
    p: Params = Params(),
) -> DataFrame:
    """Groups without service and day split, with a minimum sample count."""
    keys = ("line", "statn_id", "statn_nm", "direction", "time_band")
    rows = with_previous(
        label_arrivals(arrived, p).select(*dict.fromkeys((*keys, "arrival_ts", *ties))),
        ("line", "statn_id", "direction"),
        ("arrival_ts", *ties),
        ("arrival_ts",),
        p=p,
    ).withColumn("headway_sec", _gap("prev"))
    used = rows.where(F.col("headway_sec").between(1, p.max_headway_sec)).withColumn(
        "status", F.lit("valid")
    )
    stats = histogram_stats(headway_histogram(used, keys, ()), keys, (), p)
    return stats.where(F.col("headway_samples") >= min_samples).select(
        *keys, F.col("headway_samples").alias("n"), "p50_sec", "p90_sec", "cv"
    )
