"""Arrivals: the moment an entity is first seen at a new station."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.functions.clock import receipt_ts
from cadence.functions.labels import is_blank
from cadence.operators.ordered import with_previous
from cadence.operators.sides import counted_broadcast
from cadence.params import Params
from cadence.sources.staging import stage

ARRIVAL_COLUMNS = (
    "line", "train_no", "statn_id", "statn_nm", "statn_tnm", "updn_line", "direct_at",
)
DEFAULT_TIES = ("ingested_at", "event_id", "statn_id")


def sightings(log: DataFrame, need_train: bool = True) -> DataFrame:
    """Log rows that can take part in a sequence, with a typed receipt time.

    A receipt that is not a timestamp cannot be ordered and is left out.
    """
    keep = F.col("statn_id").isNotNull() & ~is_blank("recptn_dt")
    if need_train:
        keep &= ~is_blank("train_no")
    return (
        log.where(keep).withColumn("recptn_ts", receipt_ts()).where(F.col("recptn_ts").isNotNull())
    )


def arrivals(
    log: DataFrame, ties: Sequence[str] = DEFAULT_TIES, p: Params = Params()
) -> DataFrame:
    """Station changes per ``(line, train_no)``; rows without a train are left out.

    This is the canonical extractor: the marts read its ``direct_at``. ``ties``
    orders rows of one second (an ingest sequence, where the log has one).
    """
    return _changes(sightings(log), ("line", "train_no"), ties, p)


def arrival_runs(
    log: DataFrame, ties: Sequence[str] = DEFAULT_TIES, p: Params = Params()
) -> DataFrame:
    """First row of every maximal run of one station, per ``train_no`` alone.

    The pattern form of the extractor: it keeps rows without a train (all of them
    form one sequence) and does not tell lines apart.
    """
    return _changes(sightings(log, need_train=False), ("train_no",), ties, p).drop("direct_at")


def arrivals_since(
    new_rows: DataFrame,
    last_seen: DataFrame,
    ties: Sequence[str] = DEFAULT_TIES,
    p: Params = Params(),
) -> DataFrame:
    """Arrivals of a later date range, given the last sighting per key before it.

    ``last_seen`` is the output of :func:`last_sightings` on the earlier rows. Both
    ranges together give the same arrivals as one run over all rows, if no row is
    late: a row that does not come after the last sighting of its key (a replayed one
    is such a row) is in :func:`late_sightings` instead. The caller keeps those, or
    builds the ranges they belong to again.
    """
    keys = ("line", "train_no")
    after = F.col("__at").isNull() | (_order(ties) > F.col("__at"))
    fresh = _against(new_rows, last_seen, ties, p).where(after).drop("__at").withColumn("__old", F.lit(False))
    both = fresh.unionByName(last_seen.withColumn("__old", F.lit(True)), allowMissingColumns=True)
    return _changes(both, keys, ties, p, only=~F.col("__old"))


def late_sightings(
    new_rows: DataFrame,
    last_seen: DataFrame,
    ties: Sequence[str] = DEFAULT_TIES,
    p: Params = Params(),
) -> DataFrame:
    """The sightings that :func:`arrivals_since` cannot place: not after the last one of their key."""
    return _against(new_rows, last_seen, ties, p).where(_order(ties) <= F.col("__at")).drop("__at")


def _order(ties: Sequence[str]):
    """A sighting's place in its key's order; NULL ties come first, as in a sort."""
    return F.struct("recptn_ts", *ties)


def _against(new_rows: DataFrame, last_seen: DataFrame, ties: Sequence[str], p: Params) -> DataFrame:
    """Sightings with ``__at``, the place of the last one of their key."""
    known = counted_broadcast(
        last_seen.select(F.col("line").alias("__l"), F.col("train_no").alias("__t"), _order(ties).alias("__at")), p
    )
    same = F.col("line").eqNullSafe(F.col("__l")) & (F.col("train_no") == F.col("__t"))
    return sightings(new_rows).join(known, same, "left").drop("__l", "__t")


def last_sightings(
    log: DataFrame, ties: Sequence[str] = DEFAULT_TIES, earlier: DataFrame | None = None, p: Params = Params()
) -> DataFrame:
    """Newest sighting per ``(line, train_no)``, to be carried to the next range.

    The newest second of each key is a hash aggregate; only the rows of that second
    are compared whole. ``log`` should be a stored table, as it is read twice.
    """
    rows = sightings(log)
    if earlier is not None:
        rows = rows.unionByName(earlier, allowMissingColumns=True)
    cols = list(dict.fromkeys([*_present(rows), "recptn_ts", *ties]))
    rows = rows.select(*cols)
    key = (F.col("line").alias("__l"), F.col("train_no").alias("__t"))
    top = stage(rows.groupBy(*key).agg(F.max("recptn_ts").alias("__top")), "newest")
    same = F.col("line").eqNullSafe(F.col("__l")) & (F.col("train_no") == F.col("__t"))
    newest = F.max_by(F.struct(*cols), F.struct("recptn_ts", *ties))
    return (
        rows.join(counted_broadcast(top, p), same & (F.col("recptn_ts") == F.col("__top")))
        .groupBy("__l", "__t")
        .agg(newest.alias("r"))
        .select("r.*")
    )


def travel_times(arrived: DataFrame, p: Params = Params()) -> DataFrame:
    """Seconds between consecutive arrivals of one train."""
    hops = with_previous(
        arrived, ("line", "train_no"), ("arrival_ts", "statn_id"), ("statn_id", "arrival_ts"), p=p
    )
    return hops.where(F.col("prev").isNotNull()).select(
        "line",
        "train_no",
        F.col("prev.statn_id").alias("from_statn_id"),
        F.col("statn_id").alias("to_statn_id"),
        F.col("prev.arrival_ts").alias("from_ts"),
        F.col("arrival_ts").alias("to_ts"),
        (F.unix_timestamp("arrival_ts") - F.unix_timestamp("prev.arrival_ts")).alias("travel_sec"),
    )


def trace(arrived: DataFrame, train_no: str, limit: int = 40) -> DataFrame:
    """One train's stops in time order."""
    return (
        arrived.where(F.col("train_no") == train_no)
        .select("statn_nm", "statn_tnm", "updn_line", "arrival_ts")
        .orderBy("arrival_ts", "statn_nm", "updn_line")
        .limit(limit)
    )


def _present(rows: DataFrame) -> list[str]:
    return [c for c in ARRIVAL_COLUMNS if c in rows.columns]


def _changes(rows, keys, ties, p, only=None) -> DataFrame:
    marked = with_previous(rows, keys, ("recptn_ts", *ties), ("statn_id",), p=p)
    moved = F.col("prev").isNull() | (F.col("statn_id") != F.col("prev.statn_id"))
    if only is not None:
        moved &= only
    return marked.where(moved).select(
        *_present(rows),
        F.col("recptn_ts").alias("arrival_ts"),
        F.date_format("recptn_ts", "yyyy-MM-dd").alias("dt"),
    )
