"""Date-bounded builds: one range of log rows at a time, same results as a full run.

Three small tables carry the past: the last sighting per train, the last arrival
per station and direction (one per service), and the headway histogram. A run reads
its own log rows only; the mart is recomputed from the histogram.

Each range is one commit that names it, so a run that broke off has changed nothing and a
range that is there is not added again. Rows that come late (or are replayed under another range)
are never lost: the ranges from the first one they touch are built again from their stored
sightings and the state before them, in the same commit.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.operators import arrivals as A
from cadence.operators import headway as H
from cadence.params import Params
from cadence.sources.store import MartStore

SEEN = "state/last_sightings"
LAST = "state/last_arrivals"
HIST = "state/headway_histogram"
RANGES = "state/ranges"
SIGHTINGS = "silver/sightings"
ARRIVALS = "silver/arrivals"
MART = "staging/headway_by_station_tod"


def last_arrivals(
    arrived: DataFrame, ties: Sequence[str] = H.DEFAULT_TIES, p: Params = Params()
) -> DataFrame:
    """Newest arrival per line, station, direction and service.

    The newest over all services is among them, so both kinds of gap can go on.
    """
    labelled = H.label_arrivals(arrived, p)
    keys = ("line", "statn_id", "direction", "svc")
    rest = [c for c in arrived.columns if c not in keys]
    return (
        labelled.groupBy(*keys)
        .agg(F.max_by(F.struct(*rest), F.struct("arrival_ts", *ties)).alias("r"))
        .select("line", "statn_id", *(F.col(f"r.{c}").alias(c) for c in rest))
        .select(*arrived.columns)
    )


def headways_since(
    arrived: DataFrame, last: DataFrame, express: DataFrame, ties: Sequence[str], p: Params
) -> DataFrame:
    """Classified headways of the new arrivals, given the newest earlier ones."""
    return H.headways(
        arrived.withColumn("__new", F.lit(True)).unionByName(last.withColumn("__new", F.lit(False))),
        ties,
        p,
        keep=("__new",),
        express=express,
    ).where("__new").drop("__new")


def run_day(
    store: MartStore,
    range_id: str,
    log: DataFrame,
    express: DataFrame,
    ties: Sequence[str] = A.DEFAULT_TIES,
    arrival_ties: Sequence[str] = H.DEFAULT_TIES,
    p: Params = Params(),
) -> bool:
    """Add one range of log rows, in date order; False when the range is there already.

    ``express`` lists the lines with express service. It is a property of the
    network here, not of the day: a full run finds it in the data, and would split a
    line's whole history once its first express train was seen.
    """
    live = live_ranges(store)
    if any(range_id in r["ids"] for r in live):
        return False
    version, ids = store.next_version(), [range_id]
    name = f"{version:08d}"
    # placed once: what the commit will name is what the steps before it read
    seen = store.place(f"{SIGHTINGS}/{name}", A.sightings(log), version)
    if live:
        late = A.late_sightings(seen.table, store.read(SEEN, live[-1]["version"]), ties, p)
        first = late.agg(F.min("recptn_ts")).first()[0]
        again = [r for r in live if first is not None and r["newest"] is not None and r["newest"] >= first]
        rows = seen.table
        for r in again:
            ids = [*r["ids"], *ids]
            rows = rows.unionByName(store.read(f"{SIGHTINGS}/{r['name']}", r["version"]))
        if again:
            live = live[: live.index(again[0])]
            seen = store.place(f"{SIGHTINGS}/{name}", rows.dropDuplicates(), version)

    rows, at_arrivals = seen.table, f"{ARRIVALS}/{name}"
    if live:
        at = live[-1]["version"]
        before, last = store.read(SEEN, at), store.read(LAST, at)
        arrived = store.place(at_arrivals, A.arrivals_since(rows, before, ties, p), version)
        fresh = H.headway_histogram(headways_since(arrived.table, last, express, arrival_ties, p))
        hist = H.merge_histograms(store.read(HIST, at), fresh)
        newest = last_arrivals(arrived.table.unionByName(last), arrival_ties, p)
    else:
        before = None
        arrived = store.place(at_arrivals, A.arrivals(rows, ties, p), version)
        hist = H.headway_histogram(H.headways(arrived.table, arrival_ties, p, express=express))
        newest = last_arrivals(arrived.table, arrival_ties, p)
    hist = store.place(HIST, hist, version)
    until = rows.agg(F.max("recptn_ts")).first()[0]
    table = [(r["name"], r["version"], r["ids"], r["newest"]) for r in live]
    ranges = store.spark.createDataFrame([*table, (name, version, ids, until)], RANGES_DDL)
    store.write_all(
        {
            at_arrivals: arrived,
            f"{SIGHTINGS}/{name}": seen,
            SEEN: A.last_sightings(rows, ties, before, p),
            LAST: newest,
            HIST: hist,
            MART: H.mart_from_histogram(hist.table, p),
            RANGES: ranges.coalesce(1),
        },
        f"range {range_id}",
    )
    return True


RANGES_DDL = "name string, version bigint, ids array<string>, newest timestamp"


def live_ranges(store: MartStore) -> list:
    """The committed ranges in order, one row per build."""
    try:
        return store.read(RANGES).orderBy("name").collect()
    except LookupError:
        return []


def read_arrivals(store: MartStore) -> DataFrame:
    """All arrivals of all ranges."""
    parts = [store.read(f"{ARRIVALS}/{r['name']}", r["version"]) for r in live_ranges(store)]
    return reduce(DataFrame.unionByName, parts)
