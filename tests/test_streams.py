"""Streams fed in several files give what the batch operators give on all rows."""

import time

import pytest
from conftest import as_set
from pyspark.sql import functions as F

from cadence.operators import alerts as AL
from cadence.operators import arrivals as A
from cadence.operators import latest as LT
from cadence.operators import watchdog as W
from cadence.sources import events as E
from cadence.streaming import arrivals as SA
from cadence.streaming import bronze as SB
from cadence.streaming import keyed as SK
from cadence.streaming import watchdog as SWD
from cadence.streaming import windows as SW
from cadence.workload import fixture as X
from cadence.workload.registered import receipts_of, watch_span

P = X.PARAMS


def land(df, path, cuts, key="ingest_seq"):
    """Append ``df`` as one file per range of ``key``, in order."""
    edges = [None, *cuts, None]
    for lo, hi in zip(edges, edges[1:]):
        part = df
        if lo is not None:
            part = part.where(F.col(key) >= lo)
        if hi is not None:
            part = part.where(F.col(key) < hi)
        part.coalesce(1).write.mode("append").parquet(path)


def source(spark, df, path, per_batch=1):
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", per_batch).parquet(path)


def drain(stream, folder, name="out"):
    with SK.state_store(stream.sparkSession):
        q = (
            stream.writeStream.format("parquet").option("checkpointLocation", f"{folder}/check-{name}")
            .trigger(availableNow=True).start(f"{folder}/{name}")
        )
    q.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{folder}/{name}")


def watched(src, folder, start, name="out", **more):
    return drain(SWD.stream_watchdog(src, start, **more), folder, name)


def closing_sighting(log):
    """A row two days ahead: it moves the watermark past all others and is not judged itself."""
    end = log.where("recptn_dt <> '' AND statn_id IS NOT NULL AND train_no <> ''").orderBy(F.col("recptn_dt").desc()).limit(1)
    ahead = F.date_format(F.col("recptn_dt").cast("timestamp") + F.expr("INTERVAL 2 DAYS"), "yyyy-MM-dd HH:mm:ss")
    return end.withColumns({"recptn_dt": ahead, "train_no": F.lit("end"), "ingest_seq": F.lit(10**9)})


@pytest.fixture(scope="module")
def raw(spark, sf):
    return X.raw_events(spark, sf).cache()


def test_fan_out_resumes_and_replays(spark, raw, folder):
    log, cur, check, src = (f"{folder}/{n}" for n in ("log", "cur", "check", "src"))
    land(raw.where("ingest_seq < 600"), src, [200, 400])
    SB.fan_out(source(spark, raw, src), log, cur, check, once=True).awaitTermination()
    assert SB.read_log(spark, log).count() == E.position_log(raw.where("ingest_seq < 600")).count()
    # the rest arrives, together with a replay of earlier rows
    land(raw.where("ingest_seq >= 600"), src, [800])
    land(raw.where("ingest_seq < 200"), src, [])
    SB.fan_out(source(spark, raw, src), log, cur, check, once=True).awaitTermination()

    want = LT.latest_per_key(E.position_log(raw), order=(*SB.STATE_ORDER, "ingest_seq"))
    got = SB.read_current(spark, cur, ", ingest_seq bigint")
    cols = ["event_id", "line", "train_no", "recptn_dt", "ingest_seq", "raw_json"]
    assert as_set(got.select(*cols)) == as_set(want.select(*cols))
    rows = SB.read_log(spark, log)
    assert rows.count() == E.position_log(raw).count() + E.position_log(raw.where("ingest_seq < 200")).count()
    assert LT.log_and_current(rows, got).first().ok


def test_a_replayed_micro_batch_changes_nothing(spark, raw, folder):
    rows = E.position_log(raw).cache()
    for _ in range(2):
        SB.append_log(rows, f"{folder}/log", 0)
        SB.upsert_current(rows, f"{folder}/cur")
    assert SB.read_log(spark, f"{folder}/log").count() == rows.count()
    assert SB.read_current(spark, f"{folder}/cur").count() == rows.select("event_id").distinct().count()


def test_a_batch_writes_its_own_rows_only(spark, raw, folder):
    """Deltas hold the batch, bases change only in a fold, and folds are few; the state is right after each batch, replays included."""
    import glob
    import os

    rows = E.position_log(raw).withColumn("dt", F.lit("2024-01-01")).cache()
    parts = [rows.where((SB.key_day() == "2024-01-15") & (F.pmod("ingest_seq", F.lit(4)) == k)) for k in range(4)]
    size = lambda kind: sum(os.path.getsize(f) for f in glob.glob(f"{folder}/cur/{kind}/**/*.parquet", recursive=True))
    SB.upsert_current(rows, f"{folder}/cur", 0)
    SB.fold(spark, f"{folder}/cur", [r[0] for r in rows.select(SB.key_day()).distinct().collect()], 0, ", ingest_seq bigint")
    base, delta = size("base"), size("delta")
    for batch in (1, 2, 2):
        SB.upsert_current(parts[batch].withColumn("recptn_dt", F.concat("recptn_dt", F.lit(f".{batch}"))), f"{folder}/cur", batch, share=50.0)
    assert size("base") == base and size("delta") - delta < base / 4
    written = spark.read.parquet(f"{folder}/cur/delta").groupBy("batch_id").count().collect()
    assert {r["batch_id"]: r["count"] for r in written if r["batch_id"]} == {k: parts[k].select("event_id").distinct().count() for k in (1, 2)}
    changed = parts[1].withColumn("recptn_dt", F.concat("recptn_dt", F.lit(".1"))).unionByName(parts[2].withColumn("recptn_dt", F.concat("recptn_dt", F.lit(".2"))))
    want = LT.latest_per_key(rows.unionByName(changed), order=(*SB.STATE_ORDER, "ingest_seq"))
    cols = ["event_id", "recptn_dt", "ingest_seq", "raw_json"]
    read = lambda: as_set(SB.read_current(spark, f"{folder}/cur", ", ingest_seq bigint").select(*cols))
    assert read() == as_set(want.select(*cols))
    SB.upsert_current(parts[2].withColumn("recptn_dt", F.concat("recptn_dt", F.lit(".2"))), f"{folder}/cur", 3, share=0.0001)
    assert size("base") > base and read() == as_set(want.select(*cols))
    assert spark.read.json(f"{folder}/cur/_folds").where("through = 3").count() == parts[2].select(SB.key_day()).distinct().count()


def test_state_is_partitioned_by_the_date_of_the_key(spark):
    rows = spark.createDataFrame([("7-1-1-2026-07-20",), ("7-1-1-",), ("x",)], "event_id string")
    assert [r[0] for r in rows.select(SB.key_day()).collect()] == ["2026-07-20", "undated", "undated"]


def test_stream_arrivals_equal_batch(spark, sf, folder):
    log = X.position_log(spark, sf)
    land(log.repartition(3), f"{folder}/src", [150, 500, 501, 900])
    land(closing_sighting(log), f"{folder}/src", [])
    got = drain(SA.stream_arrivals(source(spark, log, f"{folder}/src"), "1 day", X.TIES, p=P), folder)
    assert as_set(got) == as_set(A.arrivals(log, X.TIES, P))


def test_late_sightings_make_no_false_arrival(spark, sf, folder):
    log = X.position_log(spark, sf)
    land(log, f"{folder}/src", [500])
    land(closing_sighting(log), f"{folder}/src", [])
    land(log.where("ingest_seq BETWEEN 100 AND 200"), f"{folder}/src", [])
    got = drain(SA.stream_arrivals(source(spark, log, f"{folder}/src"), "1 day", X.TIES, p=P), folder)
    assert as_set(got) == as_set(A.arrivals(log, X.TIES, P))


def test_arrivals_out_of_order_inside_the_delay(spark, folder):
    """Rows of one train arrive backwards over three batches and a restart; state holds trains and open sightings only."""
    at = lambda m: f"2024-01-01 10:{m:02d}:00"
    rows = [("A", "1", s, at(m), m) for m, s in enumerate("aabbbacc")]
    df = spark.createDataFrame(rows[::-1], "line string, train_no string, statn_id string, recptn_dt string, ingest_seq long")
    for part in ("ingest_seq >= 6", "ingest_seq BETWEEN 2 AND 5", "ingest_seq < 2"):
        df.where(part).coalesce(1).write.mode("append").parquet(f"{folder}/src")
        stream = lambda: SA.stream_arrivals(source(spark, df, f"{folder}/src"), "30 minutes", X.TIES, p=P)
        assert drain(stream(), folder).count() == 0
    end = df.limit(1).withColumns({"recptn_dt": F.lit("2024-01-01 11:00:00"), "train_no": F.lit("2"), "ingest_seq": F.lit(99).cast("long")})
    end.coalesce(1).write.mode("append").parquet(f"{folder}/src")
    got = drain(stream(), folder)
    assert sorted((r.statn_id, r.arrival_ts.minute) for r in got.collect()) == [("a", 0), ("a", 5), ("b", 2), ("c", 6)]


def test_a_forgotten_train_arrives_again(spark, folder):
    rows = [("A", "1", "a", "2024-01-01 10:00:00", 0), ("A", "2", "b", "2024-01-01 11:00:00", 1), ("A", "1", "a", "2024-01-01 12:00:00", 2), ("A", "3", "c", "2024-01-01 12:00:01", 3)]
    df = spark.createDataFrame(rows, "line string, train_no string, statn_id string, recptn_dt string, ingest_seq long")
    land(df, f"{folder}/src", [1, 2, 3])
    seen = lambda name, forget: sorted((r.train_no, r.arrival_ts.hour) for r in drain(SA.stream_arrivals(source(spark, df, f"{folder}/src"), "0 seconds", X.TIES, forget, P), folder, name).collect())
    assert seen("kept", None) == [("1", 10), ("2", 11), ("3", 12)]
    assert seen("forgot", 600) == [("1", 10), ("1", 12), ("2", 11), ("3", 12)]


def test_windows_equal_batch_once_closed(spark, raw, folder):
    closing = raw.limit(1).withColumns({"ingested_at": F.lit("2030-01-01").cast("timestamp"), "ingest_seq": F.lit(10**9)})
    land(raw, f"{folder}/src", [300, 700])
    for _ in range(2):  # one more batch moves the watermark past the last window
        land(closing, f"{folder}/src", [])
    got = drain(SW.stream_null_windows(source(spark, raw, f"{folder}/src"), "ingested_at", p=P), folder)
    want = AL.null_windows(E.project_json(raw), "ingested_at", P)
    assert as_set(got.where("window_end < '2029-01-01'")) == as_set(want)


def test_late_rows_are_dropped_after_the_watermark(spark, raw, folder):
    land(raw, f"{folder}/src", [300, 700])
    for seq in (1, 2):
        land(raw.where("ingest_seq < 300"), f"{folder}/src", [])
    got = drain(SW.stream_null_windows(source(spark, raw, f"{folder}/src"), "ingested_at", p=P), folder)
    want = AL.null_windows(E.project_json(raw), "ingested_at", P)
    early = "window_end < '2024-01-08'"
    assert as_set(got.where(early)) == as_set(want.where(early))


def test_processing_time_form_runs(spark, raw, folder):
    land(raw, f"{folder}/src", [500])
    stream = SW.stream_null_windows(SW.stamped(source(spark, raw, f"{folder}/src")), "seen_ts", p=P)
    assert drain(stream, folder).columns[:4] == ["window_start", "window_end", "line", "total"]


def test_cooldown_stream_equals_batch(spark, raw, folder):
    alerts = AL.alert_rules(AL.null_windows(E.project_json(raw), "ingested_at", P), P).cache()
    ordered = alerts.withColumn("k", F.unix_timestamp("window_end"))
    land(ordered, f"{folder}/src", [1_704_500_000, 1_705_500_000], "k")
    src = source(spark, ordered, f"{folder}/src").withWatermark("window_end", "0 seconds")
    got = drain(SK.stream_throttle(src, P.alerts.cooldown_sec), folder)
    want = AL.throttle(alerts, ("line", "rule"), "window_end", P.alerts.cooldown_sec)
    assert as_set(got) == as_set(want.select(*got.columns))


def test_alert_lane_equals_batch_and_restarts(spark, raw, folder):
    """Raw records to throttled alerts in one query, stopped after each stretch; a second monitor has its own checkpoint."""
    at = F.unix_timestamp("ingested_at")
    lane = lambda: SW.alert_lane(source(spark, raw, f"{folder}/src"), "ingested_at", p=P)
    for lo, hi in ((0, 1_704_900_000), (1_704_900_000, 1_705_700_000), (1_705_700_000, 1 << 40)):
        raw.where((at >= lo) & (at < hi)).coalesce(1).write.mode("append").parquet(f"{folder}/src")
        got = drain(lane(), folder)
    raised = AL.alert_rules(AL.null_windows(E.project_json(raw), "ingested_at", P), P)
    want = AL.throttle(raised, ("line", "rule"), "window_end", P.alerts.cooldown_sec)
    newest = raw.agg(F.max("ingested_at")).first()[0]
    want = as_set(want.where(F.col("window_end") <= F.lit(newest)).select(*got.columns))
    assert as_set(got) == want
    assert as_set(drain(lane(), folder, "second")) == want


def test_windows_over_arrival_close_without_new_rows(spark, raw, folder):
    land(raw, f"{folder}/src", [])
    stream = SW.stream_arrival_windows(source(spark, raw, f"{folder}/src"), "ingested_at", P)
    with SK.state_store(spark):
        q = stream.writeStream.format("parquet").option("checkpointLocation", f"{folder}/c").trigger(processingTime="1 second").start(f"{folder}/out")
    SK.stop_when_idle(q)
    got = spark.read.schema(stream.schema).parquet(f"{folder}/out")
    assert as_set(got) == as_set(AL.null_windows(E.project_json(raw), "ingested_at", P))


def test_live_windows_end_by_the_clock(spark, raw, folder):
    """Stamped on arrival: a window is emitted when its end has passed, though no row follows."""
    from cadence import AlertRules, Params

    p = Params(alerts=AlertRules(window="4 seconds"))
    land(raw, f"{folder}/src", [])
    stream = SW.stream_arrival_windows(SW.stamped(source(spark, raw, f"{folder}/src")), p=p)
    with SK.state_store(spark):
        q = stream.writeStream.format("parquet").option("checkpointLocation", f"{folder}/c").trigger(processingTime="1 second").start(f"{folder}/out")
    read = lambda: spark.read.schema(stream.schema).parquet(f"{folder}/out")
    give_up = time.time() + 60
    while time.time() < give_up and not (q.recentProgress and read().count()):
        time.sleep(1)
    q.stop()
    assert read().agg(F.sum("total")).first()[0] == raw.count()


def test_watchdog_stream_equals_batch(spark, sf, folder):
    receipts = receipts_of(spark, sf).select("line", "updn_line", "recptn_ts", "ingest_seq")
    start, end = watch_span(receipts)
    src = f"{folder}/src"
    # in the order of the receipts, with a restart in the middle of the last stretch but one
    for lo, hi in ((None, 1_704_600_000), (1_704_600_000, 1_705_200_000), (1_705_200_000, 1_705_900_000), (1_705_900_000, None)):
        at = F.coalesce(F.unix_timestamp("recptn_ts"), F.lit(0))
        part = receipts.where((at >= (lo or 0)) & (at < (hi or 1 << 40)))
        part.coalesce(1).write.mode("append").parquet(src)
        if lo is None or hi is not None and hi > 1_705_200_000:
            watched(source(spark, receipts, src), folder, start, p=P)
    got = watched(source(spark, receipts, src), folder, start, p=P)
    newest = receipts.agg(F.max("recptn_ts")).first()[0]
    silent = W.silent_ticks(receipts, start, end, p=P)
    want = AL.throttle(silent, W.KEY, "tick_ts", P.watch.cooldown_sec).where(F.col("tick_ts") < F.lit(newest))
    assert as_set(got) == as_set(want)


def test_watchdog_stream_starts_from_a_seed(spark, folder):
    from cadence import Params, WatchRules

    p = Params(watch=WatchRules(lines=("a", "b"), directions=("0",), gap_sec=180, quiet_sec=90, tick_sec=20))
    rows = [("a", "0", 1000 + 20 * i, i) for i in range(16)]
    df = spark.createDataFrame(rows, "line string, updn_line string, t long, ingest_seq long").withColumn(
        "recptn_ts", F.timestamp_seconds("t")
    )
    land(df, f"{folder}/src", [5])
    run = lambda name, seed: [
        (r.line, r.silent_sec, r.last_seen is None)
        for r in watched(source(spark, df, f"{folder}/src"), folder, 1000, name, seed=seed, p=p).collect()
    ]
    assert run("none", None) == [("b", 200, True)]
    assert run("old", {("b", "0"): 900}) == [("b", 200, False)]
    assert run("fresh", {("b", "0"): 990}) == [("b", 190, False)]


def test_watchdog_stream_bounds_a_receipt_from_the_future(spark, folder):
    from cadence import Params, WatchRules

    p = Params(watch=WatchRules(lines=("a", "b"), directions=("0",), gap_sec=180, quiet_sec=90, tick_sec=20))
    start = int(time.time()) - 600
    rows = [("a", "0", start + 20 * i, i) for i in range(20)] + [("a", "0", 253_000_000_000, 20)]
    df = spark.createDataFrame(rows, "line string, updn_line string, t long, ingest_seq long").withColumn(
        "recptn_ts", F.timestamp_seconds("t")
    )
    land(df, f"{folder}/src", [5, 20])
    got = watched(source(spark, df, f"{folder}/src"), folder, start, p=p)
    assert got.agg(F.max("tick_ts") <= F.current_timestamp()).first()[0]
    assert [r.silent_sec for r in got.where("line = 'b'").orderBy("tick_ts").limit(1).collect()] == [200]


def test_replays_within_the_watermark_are_dropped(spark, sf, folder):
    log = receipts_of(spark, sf).where("event_id IS NOT NULL AND recptn_ts IS NOT NULL").dropDuplicates(["event_id"])
    land(log, f"{folder}/src", [500])
    land(log.where("ingest_seq >= 900"), f"{folder}/src", [])
    got = drain(SB.drop_replays(source(spark, log, f"{folder}/src"), delay="40 days"), folder)
    assert got.count() == log.count()


@pytest.mark.parametrize("bits", [1 << 30, 64])
def test_log_holds_each_record_once(spark, raw, folder, monkeypatch, bits):
    """Copies in a batch, in later batches and in a replayed micro-batch; with a filter too small to rule anything out as well."""
    monkeypatch.setattr(SB, "FILTER_BITS", bits)
    rows = E.position_log(raw.drop("ingest_seq")).cache()
    want = rows.select("raw_json").distinct().count()
    half = rows.where(F.crc32(F.encode("raw_json", "utf-8")) % 2 == 0)
    read = lambda: SB.read_log(spark, f"{folder}/log").select("raw_json")
    SB.append_once(half.unionByName(half), f"{folder}/log", 0)
    assert read().count() == half.select("raw_json").distinct().count()
    for _ in range(2):
        SB.append_once(rows, f"{folder}/log", 1)
        assert read().count() == read().distinct().count() == want
    SB.append_once(half, f"{folder}/log", 2)
    assert read().count() == want
    again = rows.limit(1).withColumn("raw_json", F.lit("{}"))
    SB.append_once(again, f"{folder}/log", 3)
    assert read().count() == want + 1


def test_sources_resume_and_tail(spark, folder):
    """Two consumers, one started after the first delivery: nothing lost or repeated over restarts, and the tail sees later rows only."""
    def deliver(*texts):
        spark.createDataFrame([(t,) for t in texts], "raw_json string").coalesce(1).write.mode("append").text(f"{folder}/src")
        time.sleep(1.1)

    def consume(name, start):
        src = E.RawSource(f"{folder}/src", start=start)
        return sorted(r.raw_json for r in drain(src.stream(spark, f"{folder}/check-{name}"), folder, name).collect())

    deliver("a", "b")
    assert consume("all", "earliest") == ["a", "b"] and consume("tail", "latest") == []
    deliver("c")
    deliver("d", "d")
    assert consume("tail", "latest") == ["c", "d", "d"]
    deliver("e")
    for _ in range(2):
        assert consume("all", "earliest") == ["a", "b", "c", "d", "d", "e"]
        assert consume("tail", "latest") == ["c", "d", "d", "e"]
    assert consume("late", "latest") == []
    with pytest.raises(ValueError):
        E.RawSource("x", start="middle")
    with pytest.raises(ValueError):
        E.RawSource(f"{folder}/src", start="latest").stream(spark)
    topic = E.RawSource("events", "host:1", "latest", {"failOnDataLoss": "false"}).topic_options()
    assert topic == {"kafka.bootstrap.servers": "host:1", "subscribe": "events", "startingOffsets": "latest", "failOnDataLoss": "false"}


def test_text_source_and_dump(spark, raw, folder):
    E.dump_raw(raw, f"{folder}/dump")
    got = drain(E.position_log(E.stream_raw(spark, f"{folder}/dump", 1)).select("event_id"), folder)
    assert got.count() == E.position_log(raw).count()
