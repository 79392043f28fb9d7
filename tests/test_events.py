import json

from pyspark.sql import functions as F

from cadence.operators.freshness import freshness_mart
from cadence.operators.latest import latest_per_key
from cadence.params import Params
from cadence.sources import events as E
from cadence.sources import files
from cadence.workload import fixture as X


def raw(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "raw_json string")


def test_objects_and_arrays_have_no_text_but_strings_like_them_do(spark):
    rows = raw(
        spark,
        '{"event_id":"a","line":{"x":1},"statn_nm":[1,2],"train_no":"{odd","statn_id":"[odd"}',
        '{"event_id":"b","line":null,"train_no":7,"statn_id":true}',
        "not json",
        '{"line":"L"}',
    )
    a, b, bad, no_key = E.project_json(rows).select("event_id", "line", "statn_nm", "train_no", "statn_id").collect()
    assert tuple(a) == ("a", None, None, "{odd", "[odd")
    assert tuple(b) == ("b", None, None, "7", "true")
    assert tuple(bad) == (None,) * 5
    assert no_key.line == "L"
    log = E.position_log(rows)
    assert [r.event_id for r in log.select("event_id").collect()] == ["a", "b"]


def test_api_record_defaults(spark):
    api = spark.createDataFrame(
        [("9호선", None, "9177", "2026-07-20 08:00:01", None, "1", "a", "b", "0", "1", "0"),
         ("9호선", "1009", None, None, "s1", None, "a", "b", "0", "1", "0")],
        "line string, subwayId string, trainNo string, recptnDt string, statnId string, trainSttus string, "
        "statnNm string, statnTnm string, updnLine string, directAt string, lstcarAt string",
    )
    one, two = E.normalise_api(api).collect()
    assert (one.event_id, one.statn_id, one.recptn_dt) == ("9177--1-2026-07-20", None, "2026-07-20 08:00:01")
    assert (two.event_id, two.train_no, two.recptn_dt) == ("-s1--", "", "")


def test_keyed_json_keeps_nulls_and_hangul(spark):
    rows = spark.createDataFrame([("7", "강남", None)], "train_no string, statn_nm string, line string")
    r = E.keyed_json(rows).first()
    assert r.key == "7" and r.value == '{"train_no":"7","statn_nm":"강남","line":null}'
    assert json.loads(r.value)["statn_nm"] == "강남"


def test_garbage_receipts_give_null_not_errors(spark):
    log = spark.createDataFrame(
        [("l", "garbage", "t", "2026-01-01 00:00:05"), ("l", "2026-01-01 00:00:00", None, "2026-01-01 00:00:05")],
        "line string, recptn_dt string, train_no string, i string",
    ).withColumn("ingested_at", F.to_timestamp("i"))
    got = {r.minute_ts: (r.records, r.distinct_trains, r.ingest_lag_avg_sec) for r in freshness_mart(log).collect()}
    assert got[None] == (1, 1, None)
    assert [v for k, v in got.items() if k is not None] == [(1, 0, 5.0)]


def test_feed_zone_moves_only_the_lag(spark):
    log = spark.createDataFrame([("l", "2026-01-01 09:00:00", "t", "2026-01-01 00:00:07")],
                                "line string, recptn_dt string, train_no string, i string"
                                ).withColumn("ingested_at", F.to_timestamp("i"))
    r = freshness_mart(log, Params(feed_zone="Asia/Seoul")).first()
    assert r.ingest_lag_avg_sec == 7.0 and r.minute_ts.hour == 9


def test_csv_sources(spark, folder):
    (open(f"{folder}/plan.csv", "w", encoding="utf-8")).write(
        "statn_nm,direction,time_band,svc_type,plan_p50_sec,plan_n\nA,상행,출근,전체,240,12\nB,상행,출근,전체,x,\n"
    )
    a, b = files.read_plan(spark, f"{folder}/plan.csv").collect()
    assert (a.plan_p50_sec, a.plan_n, b.plan_p50_sec, b.plan_n) == (240.0, 12, None, None)
    head = "line,station_cd,fr_code,station_nm,train_no,arrive_time,left_time,origin_station,dest_station," \
           "origin_nm,dest_nm,week_tag,inout_tag,express_yn,fl_flag,branch_line"
    (open(f"{folder}/tt.csv", "w", encoding="utf-8-sig")).write(
        head + "\n09호선,901,1,개화,C1,05:30:00,05:30:30,1,2,a,b,1,1,G,0,\n09호선,901,1,개화,C2,24:10:00,,1,2,a,b,1,1,D,0,\n"
    )
    tt = files.read_timetable(spark, f"{folder}/tt.csv")
    from cadence.operators.punctuality import timed

    assert tt.columns[0] == "line" and tt.first().line == "09호선"
    assert sorted(r.arrive_sec for r in timed(tt).collect()) == [19800, 87000]
    assert [tuple(r) for r in files.stations(tt).collect()] == [("901", "1", "개화")]


def test_timetable_records(spark):
    api = spark.createDataFrame([("0901", "개화", None)], "STATION_CD string, STATION_NM string, TRAIN_NO string")
    r = files.normalise_timetable(api, "09호선").first()
    assert len(r) == 16
    assert (r.line, r.station_cd, r.station_nm, r.train_no, r.arrive_time) == ("09호선", "0901", "개화", "", "")


def test_export_skips_a_failing_table_and_drops_raw_json(spark, folder):
    good = raw(spark, "{}").withColumn("a", F.lit(1))
    bad = good.withColumn("m", F.create_map(F.lit("x"), F.lit(1)))
    report = dict(files.export_csv({"good": good, "bad": bad}, folder))
    assert report["good"] == "ok" and report["bad"].startswith("skip")
    assert spark.read.option("header", True).csv(f"{folder}/good").columns == ["a"]


def test_latest_survives_replay(spark, sf):
    log = X.position_log(spark, sf)
    order = ("recptn_dt", "ingest_seq")
    once = latest_per_key(log, order=order)
    twice = latest_per_key(log.unionByName(log), order=order)
    assert once.count() == twice.count() == once.unionByName(twice).distinct().count()


def test_file_stats_and_compaction(spark, folder):
    spark.range(1000).withColumn("dt", F.col("id") % 2).repartition(10).write.partitionBy("dt").parquet(f"{folder}/a")
    table = spark.read.parquet(f"{folder}/a")
    per = {r.dt: (r.data_files, r.records) for r in files.file_stats(table, "dt").collect()}
    assert per[0][1] == per[1][1] == 500 and per[0][0] == 10
    done = files.compact(table, f"{folder}/b", ["dt"], ["id"]).first()
    assert done.files_before == 20 and done.files_after == 2 and done.rows_unchanged
    many = files.compact(table, f"{folder}/c", ["dt"], ["id"], target_bytes=2000).first()
    assert many.files_after > 2 and many.records_after == 1000


def test_compaction_without_keys_joins_whole_files(spark, folder):
    """No shuffle: the rows of a small file stay together, as a task reads stored files only."""
    spark.range(0, 1000, 1, 10).write.parquet(f"{folder}/a")
    table = spark.read.parquet(f"{folder}/a")
    size = files.file_list(table).agg(F.sum("file_size")).first()[0]
    done = files.compact(table, f"{folder}/b", target_bytes=size // 2 + 1).first()
    assert done.rows_unchanged and 1 < done.files_after <= 2
    homes = spark.read.parquet(f"{folder}/b").groupBy(F.floor(F.col("id") / 100)).agg(F.count_distinct("_metadata.file_path").alias("n"))
    assert homes.where("n <> 1").isEmpty() and homes.count() == 10
