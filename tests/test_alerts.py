import random

import pytest
from pyspark.sql import functions as F

from cadence import AlertRules, Params, WatchRules
from cadence.functions.texts import percent_text
from cadence.operators import alerts as AL
from cadence.operators import watchdog as W

P = Params()


def greedy(times, cooldown):
    out, last = [], None
    for t in sorted(set(times)):
        if last is None or t - last >= cooldown:
            out.append(t)
            last = t
    return out


@pytest.mark.parametrize("cooldown,slice_sec", [(300, 86_400), (300, 1000), (1000, 300), (50, 50), (7, 100_000)])
def test_throttle_equals_the_sequential_fold(spark, cooldown, slice_sec):
    rnd = random.Random(cooldown)
    keys = {
        ("a", "r"): [rnd.randrange(20_000) for _ in range(400)],
        ("a", "s"): list(range(0, 9000, 20)),
        ("b", "r"): [5],
        (("b"), "s"): [0, cooldown, 2 * cooldown, 2 * cooldown - 1, 19_999],
    }
    rows = [(k[0], k[1], t) for k, ts in keys.items() for t in ts]
    df = spark.createDataFrame(rows, "line string, rule string, t long").withColumn("at", F.timestamp_seconds("t"))
    got = {}
    for r in AL.throttle(df, ("line", "rule"), "at", cooldown, slice_sec).collect():
        got.setdefault((r.line, r.rule), []).append(r.t)
    assert {k: sorted(v) for k, v in got.items()} == {k: greedy(v, cooldown) for k, v in keys.items()}


def window_row(spark, **over):
    base = dict(line="2호선", total=10, null_event_id=0, null_statn_id=0, null_statn_nm=0, null_recptn_dt=0, null_train_no=0)
    base.update(over)
    names = list(base)
    ddl = ", ".join(f"{n} {'string' if n == 'line' else 'long'}" for n in names)
    return spark.createDataFrame([tuple(base[n] for n in names)], ddl).withColumn(
        "window_end", F.to_timestamp(F.lit("2026-07-20 08:01:00"))
    )


def fired(spark, **over):
    return sorted((r.level, r.rule) for r in AL.alert_rules(window_row(spark, **over), P).collect())


def test_rules(spark):
    assert fired(spark) == []
    assert fired(spark, null_statn_id=7) == [("CRITICAL", "statn_id")]
    assert fired(spark, null_event_id=3) == []
    assert fired(spark, null_train_no=5) == [("WARN", "train_no")]
    assert fired(spark, null_train_no=4) == []
    assert fired(spark, null_train_no=10, line="1호선") == []
    assert fired(spark, total=4) == [("WARN", "low_volume")]
    assert fired(spark, total=0) == []
    assert fired(spark, total=1, null_statn_nm=1, null_recptn_dt=1, null_train_no=1) == [
        ("CRITICAL", "recptn_dt"), ("CRITICAL", "statn_nm"), ("WARN", "low_volume"), ("WARN", "train_no"),
    ]


def test_texts(spark):
    (r,) = AL.alert_rules(window_row(spark, null_train_no=5, total=8), P).collect()
    assert r.text == "2026-07-20T08:01:00 창 train_no null 5/8 (62%) — 비정상 급증"
    (m,) = AL.alert_log(AL.alert_rules(window_row(spark, null_statn_id=7), P)).collect()
    assert m.message == (
        "[2026-07-20 08:01:00] CRITICAL · 2호선 · statn_id — "
        "2026-07-20T08:01:00 창에서 statn_id null 7건 / 총 10건 — 스키마·파싱 이상 의심"
    )
    shares = [i / 8 for i in range(9)]
    got = [r[0] for r in spark.createDataFrame([(s,) for s in shares], "s double").select(percent_text(F.col("s"))).collect()]
    assert got == [f"{s:.0%}" for s in shares]


def test_windows_count_malformed_rows_under_the_missing_line(spark):
    from cadence.sources.events import project_json

    raw = spark.createDataFrame(
        [("x", "2026-07-20 08:00:10"), ('{"line":"a","event_id":"--1-d","statn_id":""}', "2026-07-20 08:00:59"),
         ('{"line":"a","event_id":"t-s-1-d","statn_id":"s","statn_nm":"n","train_no":"t","recptn_dt":"r"}', "2026-07-20 08:01:00")],
        "raw_json string, t string",
    ).withColumn("ts", F.to_timestamp("t"))
    got = {(str(r.window_start)[11:], r.line): tuple(r)[3:] for r in AL.null_windows(project_json(raw), "ts").collect()}
    assert got == {
        ("08:00:00", "(null)"): (1, 1, 1, 1, 1, 1),
        ("08:00:00", "a"): (1, 1, 1, 1, 1, 1),
        ("08:01:00", "a"): (1, 0, 0, 0, 0, 0),
    }


def brute_watch(receipts, start, end, w):
    """The polling loop, tick by tick."""
    made, sent = [], {}
    t = start
    while t <= end:
        upto = [r for r in receipts if r[2] <= t]
        newest = max((r[2] for r in upto), default=None)
        if newest is not None and t - newest <= w.quiet_sec:
            for line in w.lines:
                for d in w.directions:
                    seen = max((r[2] for r in upto if r[:2] == (line, d)), default=None)
                    silent = t - (start if seen is None else seen)
                    if silent > w.gap_sec:
                        made.append((t, line, d, silent))
                        k = (line, d)
                        if k not in sent or t - sent[k][-1] >= w.cooldown_sec:
                            sent.setdefault(k, []).append(t)
        t += w.tick_sec
    return sorted(made), sorted((t, *k) for k, ts in sent.items() for t in ts)


@pytest.mark.parametrize("seed", range(4))
def test_watchdog_equals_the_polling_loop(spark, seed):
    rnd = random.Random(seed)
    w = WatchRules(lines=("a", "b", "ghost"), gap_sec=180, quiet_sec=90, tick_sec=20, cooldown_sec=300)
    p = Params(watch=w)
    start, end = 1_000_000, 1_003_000
    receipts = []
    t = start - 100
    while t < end + 50:
        t += rnd.choice([1, 5, 20, 20, 60, 150]) if rnd.random() < 0.97 else 400
        line = rnd.choice(["a", "a", "a", "a", "b", "other"])
        if line == "b" and t % 1000 < 500:
            continue
        receipts.append((line, rnd.choice("01") if line != "b" else "0", t))
    df = spark.createDataFrame(receipts, "line string, updn_line string, t long").withColumn(
        "recptn_ts", F.timestamp_seconds("t")
    )
    silent = W.silent_ticks(df, start, end, p=p)
    got = sorted(
        (r.t, r.line, r.updn_line, r.silent_sec)
        for r in silent.withColumn("t", F.unix_timestamp("tick_ts")).collect()
    )
    raw, kept = brute_watch(receipts, start, end, w)
    assert raw and got == raw
    alerts = W.watchdog_alerts(silent, p).withColumn("t", F.unix_timestamp("tick_ts")).collect()
    name = {"0": "상행", "1": "하행"}
    assert sorted((r.t, r.line, r.direction) for r in alerts) == sorted((t, l, name[d]) for t, l, d in kept)
    assert {r.rule for r in alerts} == {"no_data"} and "무수신(>180s)" in alerts[0].text


def test_seed_is_relative_to_the_newest_receipt(spark):
    cur = spark.createDataFrame(
        [("a", "0", "2026-01-01 00:00:00"), ("a", "0", "2026-01-01 00:01:00"), ("b", "1", "2026-01-01 00:03:00.5"),
         ("b", "0", "bad"), (None, "0", "2026-01-01 09:00:00")],
        "line string, updn_line string, recptn_dt string",
    )
    now = F.to_timestamp(F.lit("2026-02-01 00:00:00"))
    base = 1_769_904_000
    got = {(r.line, r.updn_line): r.last_seen_sec - base for r in W.seed_from_current(cur, now, P).collect()}
    assert got == {("a", "0"): -120, ("b", "1"): 0}


def test_null_keys_are_throttled_like_others(spark):
    rows = [(k, t) for k in ("a", None) for t in ("2026-07-20 08:00:00", "2026-07-20 08:01:00", "2026-07-20 09:00:00")]
    df = spark.createDataFrame(rows, "line string, t string").selectExpr("line", "CAST(t AS TIMESTAMP) AS window_end")
    kept = AL.throttle(df, ["line"], "window_end", 300)
    assert sorted(str(r["line"]) for r in kept.collect()) == ["None", "None", "a", "a"]


def test_cooldown_over_many_chains(spark, monkeypatch):
    """Chains of three slices against a plain fold: sparse and dense stretches, gaps of many slices, cooldowns near and above a slice."""
    import random

    monkeypatch.setattr(AL, "CHAIN", 3)
    r = random.Random(11)
    rows = []
    for key in ("a", "b", None):
        t = 0
        for _ in range(400):
            t += r.choice([1, 5, 30, 60, 300, 3_000])
            rows.append((key, t))
    df = spark.createDataFrame(rows, "k string, t long").withColumn("at", F.timestamp_seconds("t"))
    for cooldown, part in ((10, 60), (59, 60), (60, 60), (500, 60), (100, 1_000)):
        want = set()
        for key in ("a", "b", None):
            last = None
            for t in sorted({x for k, x in rows if k == key}):
                if last is None or t - last >= cooldown:
                    last = t
                    want.add((key, t))
        got = [(x.k, x.t) for x in AL.throttle(df, ("k",), "at", cooldown, part).collect()]
        assert len(got) == len(set(got)) and set(got) == want
