"""The registered queries: every operator over the whole ``events`` table.

Each takes ``(spark, sf_dir)`` and returns a DataFrame. Timestamps are returned
zone-less, so results read the same in every session time zone.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cadence.functions import labels as L
from cadence.functions.clock import receipt_ts
from cadence.operators import alerts as AL
from cadence.operators import arrivals as A
from cadence.operators import freshness as FR
from cadence.operators import headway as H
from cadence.operators import latest as LT
from cadence.operators import punctuality as P
from cadence.operators import quality as Q
from cadence.operators import serving as S
from cadence.operators import sketches as K
from cadence.operators import watchdog as W
from cadence.plans import daily, ranges, wap
from cadence.sources import events as E
from cadence.sources import external, files
from cadence.sources.staging import shared_folder, stage
from cadence.sources.store import MartStore
from cadence.streaming import arrivals as SA
from cadence.streaming import bronze as SB
from cadence.streaming import keyed as SK
from cadence.streaming import watchdog as SWD
from cadence.streaming import windows as SW
from cadence.workload import fixture as X

Query = Callable[[SparkSession, str], DataFrame]

p = X.PARAMS
GAP_TIES = ("train_no", "statn_nm")
MIN_SAMPLES = 10
LATEST_ORDER = ("recptn_dt", "ingest_seq")

QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return zoneless(fn(spark, sf_dir))

    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    QUERIES[fn.__name__] = run
    return fn


def zoneless(df: DataFrame) -> DataFrame:
    stamps = [f.name for f in df.schema.fields if f.dataType.typeName() == "timestamp"]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in stamps}) if stamps else df


# -- layers ---------------------------------------------------------------------


def log_of(spark, d):
    return X.position_log(spark, d)


def arrival_receipts(arrived: DataFrame) -> DataFrame:
    """The arrivals as a log of their own: each of them has a train, so each of its minutes has one too."""
    return arrived.select("line", "train_no", F.date_format("arrival_ts", "yyyy-MM-dd HH:mm:ss").alias("recptn_dt"), F.col("arrival_ts").alias("ingested_at"))


def current_of(spark, d):
    return LT.latest_per_key(log_of(spark, d), order=LATEST_ORDER)


def mart_of(spark, d):
    return H.headway_mart(X.staged_arrivals(spark, d), GAP_TIES, p)


def fresh_of(spark, d):
    return stage(FR.freshness_mart(log_of(spark, d), p), "freshness")


def punctual_of(spark, d):
    return P.punctuality(mart_of(spark, d), P.planned_headways(X.timetable(spark, d), p), p)


def delays_of(spark, d):
    arrived = A.arrivals(log_of(spark, d), X.TIES, p)
    return P.nearest_plan_delay(arrived, stage(X.timetable(spark, d), "timetable"), p)


def windows_of(spark, d):
    records = E.project_json(X.raw_events(spark, d), names=AL.CHECKED_FIELDS)
    return AL.null_windows(records, "ingested_at", p)


def receipts_of(spark, d):
    return log_of(spark, d).withColumn("recptn_ts", receipt_ts())


def watch_span(receipts: DataFrame) -> tuple[int, int]:
    """Whole days around the receipts, as epoch seconds."""
    day = lambda c: F.unix_timestamp(F.date_trunc("day", c))
    lo, hi = receipts.agg(day(F.min("recptn_ts")), day(F.max("recptn_ts"))).first()
    return lo, hi + 86_400


def silent_of(spark, d):
    receipts = receipts_of(spark, d)
    return W.silent_ticks(receipts, *watch_span(receipts), p=p)


# -- ingest and state -------------------------------------------------------------


@query
def json_project(spark, d):
    return E.position_log(X.raw_events(spark, d)).drop("raw_json", "ingested_at")


@query
def null_predicates(spark, d):
    rows = E.project_json(X.raw_events(spark, d), names=AL.CHECKED_FIELDS)
    return rows.groupBy(L.or_missing("line", p).alias("line")).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(L.is_blank("train_no")).alias("blank_train"),
        F.count_if(L.is_blank("statn_id")).alias("blank_station"),
        F.count_if(L.broken_key("event_id")).alias("broken_keys"),
    )


@query
def api_normalise(spark, d):
    rows = X.position_src(spark, d)
    renamed = {"subwayId": "line", "trainNo": "train_no", "statnId": "statn_id", "statnNm": "statn_nm",
               "statnTnm": "statn_nm", "updnLine": "updn_line", "trainSttus": "train_sttus",
               "directAt": "direct_at", "lstcarAt": "direct_at", "recptnDt": "recptn_dt"}
    api = rows.select("line", *(F.col(c).alias(a) for a, c in renamed.items()))
    return E.normalise_api(api).drop("ingested_at")


@query
def keyed_messages(spark, d):
    rows = X.position_src(spark, d).select("line", "train_no", "statn_id", "recptn_dt")
    return E.keyed_json(rows)


@query
def upsert_current(spark, d):
    return current_of(spark, d)


@query
def log_vs_current(spark, d):
    log = log_of(spark, d).where(F.col("event_id").isNotNull())
    return LT.log_and_current(log, current_of(spark, d))


@query
def partition_counts(spark, d):
    return LT.count_by(log_of(spark, d), "dt")


@query
def current_latest(spark, d):
    rows = current_of(spark, d).withColumn("statn_tnm", F.col("statn_nm"))
    return LT.newest(rows)


@query
def last_receipt(spark, d):
    return LT.last_receipt(current_of(spark, d))


# -- arrivals ---------------------------------------------------------------------


@query
def arrivals_lag(spark, d):
    return A.arrivals(log_of(spark, d), X.TIES, p)


@query
def arrivals_hot(spark, d):
    """Arrivals with every key above two hundred rows cut into slices."""
    return A.arrivals(log_of(spark, d), X.TIES, p.but(hot_key_rows=200))


@query
def arrivals_runs(spark, d):
    return A.arrival_runs(log_of(spark, d), X.TIES, p)


@query
def arrivals_by_line(spark, d):
    return LT.count_by(A.arrivals(log_of(spark, d), X.TIES, p), "line")


@query
def section_travel(spark, d):
    return A.travel_times(X.staged_arrivals(spark, d), p)


@query
def travel_quantiles(spark, d):
    """Travel times per line from sketches per date, merged: the rank of each quantile lies within the stated error."""
    hops = stage(A.travel_times(X.staged_arrivals(spark, d), p), "hops")
    daily_parts = stage(K.sketches(hops, ["line", F.to_date("to_ts").alias("day")], "travel_sec"), "sketches")
    found = K.quantiles(K.merged(daily_parts, ["line"]), (0.1, 0.5, 0.9))
    value = F.col("travel_sec").cast("double")
    below, upto = F.count_if(value < F.col("value")) / F.count("*"), F.count_if(value <= F.col("value")) / F.count("*")
    ranks = hops.join(found, "line").groupBy("line", "n", "share", "value").agg(below.alias("below"), upto.alias("upto"))
    within = (F.col("below") <= F.col("share") + K.RANK_ERROR) & (F.col("upto") >= F.col("share") - K.RANK_ERROR)
    return ranks.select("line", "share", F.col("n").alias("hops"), within.alias("within"))


@query
def entity_trace(spark, d):
    arrived = A.arrivals(log_of(spark, d), X.TIES, p).withColumn("statn_tnm", F.col("statn_nm"))
    return A.trace(arrived, "7")


@query
def arrival_labels(spark, d):
    return H.label_arrivals(A.arrivals(log_of(spark, d), X.TIES, p), p)


# -- headways ---------------------------------------------------------------------


@query
def headway_status(spark, d):
    return H.headways(X.staged_arrivals(spark, d), GAP_TIES, p)


@query
def express_lines_semi(spark, d):
    labelled = H.label_arrivals(X.staged_arrivals(spark, d), p)
    return H.on_express_lines(labelled, p).select("line", "train_no", "statn_id", "svc", "arrival_ts")


@query
def exclusion_counts(spark, d):
    return H.exclusion_counts(H.headways(X.staged_arrivals(spark, d), GAP_TIES, p))


@query
def group_medians(spark, d):
    return H.group_medians(H.headways(X.staged_arrivals(spark, d), GAP_TIES, p), p)


@query
def headway_mart(spark, d):
    return mart_of(spark, d)


@query
def headway_mart_hot(spark, d):
    """The mart with every key above two hundred arrivals cut into slices."""
    return H.headway_mart(X.staged_arrivals(spark, d), GAP_TIES, p.but(hot_key_rows=200))


@query
def headway_min_sample(spark, d):
    return H.exploratory_mart(X.staged_arrivals(spark, d), 15, GAP_TIES, p)


@query
def exploratory_topk(spark, d):
    groups = H.exploratory_mart(X.staged_arrivals(spark, d), 2, GAP_TIES, p)
    return S.exploratory_topk(groups, p)


@query
def rush_topk(spark, d):
    return S.rush_topk(mart_of(spark, d), p)


@query
def service_mix(spark, d):
    return S.service_mix(mart_of(spark, d), None, p.but(min_samples=2))


# -- freshness --------------------------------------------------------------------


@query
def freshness_mart(spark, d):
    return FR.freshness_mart(log_of(spark, d), p)


@query
def freshness_by_ranges(spark, d):
    """Freshness from date ranges, one of them run twice and one that brings rows of an earlier one late."""
    root, log = _new_folder(spark, "ranges"), log_of(spark, d)
    for name, of in _three_ranges().items():
        for _ in range(2 if name == "second" else 1):
            ranges.add_range(spark, root, name, log.where(of), p)
    return ranges.read_freshness(spark, root)


@query
def coverage(spark, d):
    return FR.coverage(FR.freshness_mart(log_of(spark, d), p))


@query
def gap_classes(spark, d):
    return FR.gap_classes(fresh_of(spark, d), p)


@query
def hiccup_total(spark, d):
    return FR.hiccup_total(fresh_of(spark, d), p)


@query
def heartbeat_series(spark, d):
    return FR.heartbeat_series(FR.freshness_mart(log_of(spark, d), p))


# -- serving ----------------------------------------------------------------------


@query
def kpi_groups(spark, d):
    return S.group_count(mart_of(spark, d), S.mart_filter(MIN_SAMPLES, p=p))


@query
def kpi_filtered(spark, d):
    where = S.mart_filter(2, p.labels.svc_express, "click", p.labels.midday, p)
    return S.group_count(mart_of(spark, d), where)


@query
def kpi_worst_line(spark, d):
    return S.worst_line(mart_of(spark, d), S.mart_filter(MIN_SAMPLES, p=p))


@query
def kpi_worst_station(spark, d):
    return S.worst_station(mart_of(spark, d), S.mart_filter(MIN_SAMPLES, p=p))


@query
def line_band_summary(spark, d):
    return S.line_band_summary(mart_of(spark, d), S.mart_filter(MIN_SAMPLES, p=p))


# -- plan -------------------------------------------------------------------------


@query
def timetable_load(spark, d):
    """The timetable as landed API records, through the CSV export and back as sixteen text columns: rows per station and day type."""
    out, api = _new_folder(spark, "timetable"), X.timetable(spark, d)
    landed = api.select(
        F.col("station_nm").alias("STATION_NM"), F.col("week_tag").alias("WEEK_TAG"), F.col("inout_tag").alias("INOUT_TAG"),
        F.col("express_yn").alias("EXPRESS_YN"), F.col("arrive_sec").alias("ARRIVETIME"),
    )
    report = files.export_csv({"timetable": files.normalise_timetable(landed, p.rules.plan_line)}, out)
    if any(state != "ok" for _, state in report):
        raise RuntimeError(f"export failed: {report}")
    back = files.read_timetable(spark, f"{out}/timetable")
    return back.groupBy("line", "station_nm", "week_tag").agg(
        F.count(F.lit(1)).alias("stops"), F.count_if(F.col("express_yn") == "D").alias("express"), F.min(F.col("arrive_time").cast("long")).alias("first_sec")
    )


@query
def ingest_stamp(spark, d):
    """Records without a time of ingestion get that of the run: all of them, none before it or after its end."""
    began = spark.sql("SELECT current_timestamp()").first()[0]
    rows = E.position_log(X.raw_events(spark, d).select("raw_json"))
    fresh = (F.col("ingested_at") >= F.lit(began)) & (F.col("ingested_at") <= F.current_timestamp())
    return rows.groupBy("line").agg(F.count(F.lit(1)).alias("records"), F.count_if(fresh).alias("stamped"))


@query
def plan_headway(spark, d):
    return P.planned_headways(X.timetable(spark, d), p)


@query
def punctuality(spark, d):
    return punctual_of(spark, d)


@query
def punctuality_topk(spark, d):
    return P.worst_to_plan(punctual_of(spark, d), p.but(min_samples=2))


@query
def service_vs_plan(spark, d):
    return P.service_vs_plan(punctual_of(spark, d), p.but(min_samples=2))


@query
def nearest_plan_delay(spark, d):
    return delays_of(spark, d)


@query
def delay_by_station(spark, d):
    return P.delay_by_station(delays_of(spark, d))


@query
def delay_by_band(spark, d):
    return P.delay_by_timeband(delays_of(spark, d))


@query
def delay_by_direction(spark, d):
    return P.delay_by_direction(delays_of(spark, d))


@query
def delayed_topk(spark, d):
    return P.most_delayed(P.delay_by_station(delays_of(spark, d)))


# -- alerts and watchdog ------------------------------------------------------------


@query
def null_windows(spark, d):
    return windows_of(spark, d)


@query
def window_messages(spark, d):
    return AL.window_messages(windows_of(spark, d))


@query
def alert_rules(spark, d):
    return AL.alert_rules(windows_of(spark, d), p)


@query
def alert_cooldown(spark, d):
    raised = stage(AL.alert_rules(windows_of(spark, d), p), "alerts")
    return AL.throttle(raised, ("line", "rule"), "window_end", p.alerts.cooldown_sec)


@query
def alert_log(spark, d):
    return AL.alert_log(AL.alert_rules(windows_of(spark, d), p))


@query
def watchdog_ticks(spark, d):
    return silent_of(spark, d)


@query
def watchdog_alerts(spark, d):
    return W.watchdog_alerts(stage(silent_of(spark, d), "silent"), p)


@query
def watchdog_seed(spark, d):
    now = F.timestamp_seconds(F.lit(1_717_200_000))
    return W.seed_from_current(current_of(spark, d), now, p)


# -- quality and gates --------------------------------------------------------------


@query
def suite_headway(spark, d):
    return Q.run_suite(mart_of(spark, d), Q.headway_rules(p))


@query
def suite_freshness(spark, d):
    return Q.run_suite(FR.freshness_mart(log_of(spark, d), p), Q.freshness_rules())


@query
def consistency_checks(spark, d):
    return Q.consistency_checks(mart_of(spark, d))


@query
def suite_contaminated(spark, d):
    return Q.run_suite(Q.spoil(mart_of(spark, d), cv=99.0, direction="X"), Q.headway_rules(p))


@query
def suite_bad_row(spark, d):
    mart = stage(mart_of(spark, d), "mart")
    return Q.run_suite(Q.with_bad_row(mart, direction=None, cv=9.9), Q.headway_rules(p))


@query
def mart_counts(spark, d):
    return Q.mart_counts(headway=mart_of(spark, d), freshness=FR.freshness_mart(log_of(spark, d), p))


def _new_folder(spark: SparkSession, what: str) -> str:
    return f"{shared_folder(spark)}/cadence-{what}/{uuid.uuid4().hex}"


def _published(spark, d) -> MartStore:
    store = MartStore(spark, _new_folder(spark, "marts"))
    arrived = X.staged_arrivals(spark, d)
    wap.run(store, arrived, arrival_receipts(arrived), "all", GAP_TIES, p)
    return store


@query
def wap_run(spark, d):
    """The served headway mart after write, audit, publish and validate."""
    return _published(spark, d).read(wap.SERVED["headway"])


@query
def wap_blocked(spark, d):
    """Bad marts are staged and stopped by the audit: the mart that is served stays as it was."""
    store = MartStore(spark, _new_folder(spark, "marts"))
    wap.build_direct(store, X.staged_arrivals(spark, d), log_of(spark, d), GAP_TIES, p)
    spoilt = Q.spoil(store.read(wap.SERVED["headway"]), cv=99.0)
    store.write_all({wap.STAGED["headway"]: spoilt, wap.STAGED["freshness"]: store.read(wap.SERVED["freshness"])})
    try:
        wap.run(store, X.staged_arrivals(spark, d), log_of(spark, d), "publish", GAP_TIES, p)
    except wap.AuditFailed:
        return store.read(wap.SERVED["headway"])
    raise RuntimeError("the audit let a spoilt mart through")


@query
def wap_refused(spark, d):
    """The whole log, with its minutes without any train: what the audit refuses, and the rows still served from before."""
    store = MartStore(spark, _new_folder(spark, "marts"))
    arrived = X.staged_arrivals(spark, d)
    wap.build_direct(store, arrived, log_of(spark, d), GAP_TIES, p)
    served = lambda: {r["mart"]: r["version"] for r in store.heads().collect() if r["mart"] in wap.SERVED.values()}
    before, report = served(), []
    try:
        wap.run(store, arrived, log_of(spark, d), "all", GAP_TIES, p)
    except wap.AuditFailed as refused:
        report = refused.report
        if served() != before:
            raise RuntimeError("a refused run changed what is served") from refused
    rows = [(r["mart"], r["rule"], r["column"], r["unexpected"]) for r in report]  # at most one row per rule
    kept = store.read(wap.SERVED["headway"]).count()
    return spark.createDataFrame(rows, "mart string, rule string, column string, unexpected long").withColumn("served_rows", F.lit(kept).cast("long"))


@query
def external_marts(spark, d):
    """Served marts in a second session, as external tables over the same files, next to the log; then again after a new publication."""
    store = MartStore(spark, _new_folder(spark, "marts"))
    mart, log, landed = stage(mart_of(spark, d), "mart"), log_of(spark, d), _new_folder(spark, "log")
    log.write.parquet(landed)
    other = spark.newSession()
    reader = external.ExternalMarts(other, store.root, f"served_{uuid.uuid4().hex}")
    logs = other.read.schema(log.schema).parquet(landed).groupBy("line").agg(F.count(F.lit(1)).alias("log_rows"))
    found = []
    for publication, least in ((1, 1), (2, 3)):
        store.write(wap.SERVED["headway"], mart.where(F.col("headway_samples") >= least))
        reader.refresh()
        groups = reader.table(wap.SERVED["headway"]).groupBy("line").agg(F.count(F.lit(1)).alias("groups"))
        joined = logs.join(groups, "line", "left").select(F.lit(publication).alias("publication"), "line", "log_rows", F.coalesce("groups", F.lit(0).cast("long")).alias("groups"))
        found.append(joined)
    return found[0].unionByName(found[1])


@query
def wap_audit(spark, d):
    mart = stage(mart_of(spark, d), "mart")
    return Q.audit(mart, FR.freshness_mart(log_of(spark, d), p), p)


@query
def reconcile(spark, d):
    return wap.validate(_published(spark, d))


@query
def rollback(spark, d):
    """Published, emptied, rolled back: the mart of the first version is served again."""
    store = MartStore(spark, _new_folder(spark, "marts"))
    version = store.write("headway", mart_of(spark, d))
    store.empty("headway")
    store.rollback("headway", version)
    return store.read("headway")


@query
def mart_history(spark, d):
    store = MartStore(spark, _new_folder(spark, "marts"))
    version = store.write("freshness", FR.freshness_mart(log_of(spark, d), p))
    store.empty("freshness")
    store.rollback("freshness", version)
    return store.history("freshness").drop("committed_at")


@query
def mart_list(spark, d):
    return _published(spark, d).marts().select("mart", "records")


@query
def compact(spark, d):
    store = MartStore(spark, _new_folder(spark, "marts"))
    store.write("log", log_of(spark, d).repartition(12))
    done = store.compact("log")
    fewer = (F.col("files_after") < F.col("files_before")).alias("fewer_files")
    return done.select("records_before", "records_after", "rows_unchanged", fewer)


@query
def file_stats(spark, d):
    return files.file_stats(spark.read.parquet(f"{d}/events.parquet")).select("data_files", "records")


@query
def direct_build(spark, d):
    store = MartStore(spark, _new_folder(spark, "marts"))
    return wap.build_direct(store, X.staged_arrivals(spark, d), log_of(spark, d), GAP_TIES, p)


@query
def csv_export(spark, d):
    """Rows read back from the exported CSV of the log."""
    out = _new_folder(spark, "export")
    report = files.export_csv({"position_log": E.position_log(X.raw_events(spark, d))}, out)
    if any(state != "ok" for _, state in report):
        raise RuntimeError(f"export failed: {report}")
    back = spark.read.option("header", True).csv(f"{out}/position_log")
    return LT.count_by(back, "line")


@query
def dump_replay(spark, d):
    """The latest state is the same after the dumped records were loaded twice."""
    out = _new_folder(spark, "dump")
    E.dump_raw(X.raw_events(spark, d), out)
    once = E.position_log(E.read_raw(spark, out))
    rest = [c for c in once.columns if c not in ("raw_json", "ingested_at")]
    twice = once.unionByName(once).select(*rest)
    return LT.latest_per_key(twice, order=("recptn_dt",)).select("event_id", "recptn_dt")


@query
def daily_build(spark, d):
    """The mart built in date ranges, one of them twice and one with late rows; equal to the mart built in one go."""
    return _daily(spark, d).read(daily.MART)


@query
def daily_arrivals(spark, d):
    """All arrivals after the same build."""
    return daily.read_arrivals(_daily(spark, d))


def _daily(spark, d) -> MartStore:
    store = MartStore(spark, _new_folder(spark, "marts"))
    # each range and the express lines read it: derived once, not once a reader
    log = stage(log_of(spark, d), "log")
    express = stage(H.express_lines(H.label_arrivals(A.arrivals(log, X.TIES, p), p), p), "express")
    parts = _three_ranges()
    for name in ("first", "second", "second", "third"):
        daily.run_day(store, name, log.where(parts[name]), express, X.TIES, GAP_TIES, p)
    return store


def _three_ranges() -> dict[str, Column]:
    """Conditions that share out the log: two date ranges, and a third with late rows of the first."""
    day, late = F.coalesce("dt", F.lit("")), F.pmod("ingest_seq", F.lit(8)) == 3
    return {
        "first": (day < "2024-01-11") & ~late,
        "second": (day >= "2024-01-11") & (day < "2024-01-21"),
        "third": (day >= "2024-01-21") | ((day < "2024-01-11") & late),
    }


# -- streams ------------------------------------------------------------------------


def _as_source(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Land a DataFrame as files and read them as a stream."""
    path = _new_folder(spark, f"source-{name}")
    df.write.parquet(path)
    return spark.readStream.schema(df.schema).parquet(path)


def _start(stream: DataFrame, out: str, check: str) -> StreamingQuery:
    """Drain what has landed into Parquet; the query stops by itself."""
    writer = stream.writeStream.format("parquet").option("checkpointLocation", check)
    with SK.state_store(stream.sparkSession):
        return writer.outputMode("append").trigger(availableNow=True).start(out)


def _run(stream: DataFrame, name: str) -> DataFrame:
    """Drain a stream into Parquet and read the result."""
    spark = stream.sparkSession
    out = _new_folder(spark, f"sink-{name}")
    _start(stream, out, _new_folder(spark, f"check-{name}")).awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


def _replay(df: DataFrame, by: Column, build: Callable[[DataFrame], DataFrame], name: str, parts: int = 3) -> DataFrame:
    """``df`` in stretches of ``by`` (a number), each landed as files of its own and consumed by a query that then stops.

    The next stretch is consumed by a query started anew from the same checkpoint, so state and offsets are resumed.
    """
    spark = df.sparkSession
    rows = stage(df.withColumn("__by", F.coalesce(by.cast("double"), F.lit(0.0))), name)
    edges = rows.stat.approxQuantile("__by", [k / parts for k in range(1, parts)], 0.01)
    path, out, check = (_new_folder(spark, f"{x}-{name}") for x in ("source", "sink", "check"))
    slice_of = sum(((F.col("__by") > e).cast("int") for e in edges), F.lit(0))
    for k in range(parts):
        rows.where(slice_of == k).drop("__by").write.mode("append").parquet(path)
        stream = build(spark.readStream.schema(df.schema).parquet(path))
        _start(stream, out, check).awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


@query
def stream_upsert(spark, d):
    """Latest states after the ingest stream consumed all raw records."""
    log, current, check = (_new_folder(spark, x) for x in ("log", "current", "check"))
    raw = _as_source(spark, X.raw_events(spark, d), "raw")
    SB.fan_out(raw, log, current, check, once=True).awaitTermination()
    return SB.read_current(spark, current, ", ingest_seq bigint").select("event_id", "recptn_dt", "ingest_seq")


@query
def stream_log(spark, d):
    """Log rows per date after the ingest stream consumed all raw records."""
    log, current, check = (_new_folder(spark, x) for x in ("log", "current", "check"))
    raw = _as_source(spark, X.raw_events(spark, d), "raw")
    SB.fan_out(raw, log, current, check, once=True).awaitTermination()
    undated = F.when(L.is_blank("dt"), "undated").otherwise(F.col("dt"))
    return LT.count_by(SB.read_log(spark, log).withColumn("dt", undated), "dt")


@query
def stream_log_once(spark, d):
    """Log rows per date after a second delivery of every other record, weeks behind any watermark."""
    raw = stage(X.raw_events(spark, d), "raw")
    src, log, current, check = (_new_folder(spark, x) for x in ("delivered", "log", "current", "check"))
    for rows in (raw, raw.where(F.pmod("ingest_seq", F.lit(2)) == 0)):
        rows.write.mode("append").parquet(src)
        SB.fan_out(spark.readStream.schema(raw.schema).parquet(src).drop("ingest_seq"), log, current, check, once=True, replays=False).awaitTermination()
    undated = F.when(L.is_blank("dt"), "undated").otherwise(F.col("dt"))
    return LT.count_by(SB.read_log(spark, log).withColumn("dt", undated), "dt")


@query
def stream_arrivals(spark, d):
    """Arrivals by keyed state, the feed in stretches with a restart after each and its rows shuffled inside one.

    A last row far enough ahead moves the watermark past the feed, and is itself never judged.
    """
    log = log_of(spark, d).select("line", "train_no", "statn_id", "statn_nm", "updn_line", "direct_at", "recptn_dt", "ingest_seq")
    newest = log.agg(F.max(F.col("recptn_dt").try_cast("timestamp")).alias("t"))
    after = F.date_format(F.col("t") + F.expr("INTERVAL 2 DAYS"), "yyyy-MM-dd HH:mm:ss")
    end = newest.select(*(F.lit("end").alias(c) for c in log.columns[:-2]), after.alias("recptn_dt"), F.lit(1 << 60).alias("ingest_seq"))
    feed = log.unionByName(end).repartition("ingest_seq")
    return _replay(feed, F.col("ingest_seq"), lambda rows: SA.stream_arrivals(rows, "1 day", X.TIES, p=p), "log")


@query
def stream_null_windows(spark, d):
    """Windows closed by the watermark: all but those still open at the newest row."""
    raw = _as_source(spark, X.raw_events(spark, d), "raw")
    return _run(SW.stream_null_windows(raw, "ingested_at", p=p), "windows")


@query
def stream_arrival_windows(spark, d):
    """Windows over the time of arrival, closed by the clock: a replay with its stamps, so all of them, the last one too."""
    raw = _as_source(spark, X.raw_events(spark, d), "raw")
    stream = SW.stream_arrival_windows(raw, "ingested_at", p)
    out, check = _new_folder(spark, "sink-arrived"), _new_folder(spark, "check-arrived")
    with SK.state_store(spark):
        running = stream.writeStream.format("parquet").option("checkpointLocation", check).trigger(processingTime="1 second").start(out)
    SK.stop_when_idle(running)
    return spark.read.schema(stream.schema).parquet(out)


@query
def stream_resume(spark, d):
    """Two consumers of one landing folder, both started again for each of three deliveries: one takes all records, one those after its start."""
    raw = stage(X.raw_events(spark, d), "raw")
    path, counted = _new_folder(spark, "landing"), []
    names = {"all": "earliest", "tail": "latest"}
    folders = {n: (_new_folder(spark, f"sink-{n}"), _new_folder(spark, f"check-{n}")) for n in names}
    for k in range(3):
        raw.where(F.pmod("ingest_seq", F.lit(3)) == k).select("raw_json").write.mode("append").text(path)
        for name, start in names.items():
            out, check = folders[name]
            records = E.project_json(E.RawSource(path, start=start).stream(spark, check), names=("line",)).select("line")
            _start(records, out, check).awaitTermination()
    for name, (out, _) in folders.items():
        rows = spark.read.schema("line string").parquet(out)
        counted.append(LT.count_by(rows, "line").select(F.lit(name).alias("consumer"), "line", F.col("cnt").alias("records")))
    return counted[0].unionByName(counted[1])


@query
def stream_cooldown(spark, d):
    raised = _as_source(spark, AL.alert_rules(windows_of(spark, d), p), "alerts")
    return _run(SK.stream_throttle(raised.withWatermark("window_end", "0 seconds"), p.alerts.cooldown_sec), "cooldown")


@query
def stream_alert_lane(spark, d):
    """Raw records in, throttled alerts out, as one query that is stopped and started again twice on the way."""
    return _replay(X.raw_events(spark, d), F.unix_timestamp("ingested_at"), lambda raw: SW.alert_lane(raw, "ingested_at", p=p), "lane")


def _monitored(raw: DataFrame, start: int) -> DataFrame:
    receipts = E.project_json(raw, names=("line", "updn_line", "recptn_dt")).withColumn("recptn_ts", receipt_ts())
    return SWD.stream_watchdog(receipts, start, p=p)


@query
def stream_monitors(spark, d):
    """Two monitors over one landed stream, side by side, each with a checkpoint of its own."""
    raw = X.raw_events(spark, d)
    start, _ = watch_span(E.project_json(raw, names=("recptn_dt",)).withColumn("recptn_ts", receipt_ts()))
    source = _as_source(spark, raw, "shared")
    lane, watch = SW.alert_lane(source, "ingested_at", p=p), _monitored(source, start)
    outs = [_new_folder(spark, f"sink-{x}") for x in ("lane", "watch")]
    running = [_start(m, out, _new_folder(spark, "check-monitor")) for m, out in zip((lane, watch), outs, strict=True)]
    for q in running:
        q.awaitTermination()
    sent = spark.read.schema(lane.schema).parquet(outs[0]).select(F.lit("validity").alias("monitor"), F.col("window_end").alias("at"), "line", F.col("rule").alias("subject"))
    lost = spark.read.schema(watch.schema).parquet(outs[1]).select(F.lit("completeness").alias("monitor"), F.col("tick_ts").alias("at"), "line", F.col("updn_line").alias("subject"))
    return sent.unionByName(lost)


@query
def stream_watchdog(spark, d):
    """Silence alerts at the ticks the newest receipt has passed, the receipts in stretches with a restart after each."""
    receipts = receipts_of(spark, d).select("line", "updn_line", "recptn_ts")
    start, _ = watch_span(receipts)
    return _replay(receipts, F.unix_timestamp("recptn_ts"), lambda rows: SWD.stream_watchdog(rows, start, p=p), "receipts")
