"""File sources: exports, preamble series, audience sections, landing,
history snapshots, incremental ingest."""
import datetime as dt
import json
import os

from pyspark.sql import functions as F

from pulsekit.sources import exports, greek, history, landing, normalize


def _write(path, text, enc="utf-8"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(text.encode(enc))


def test_preamble_series_utf16(spark, tmp_path):
    p = str(tmp_path / "Follows.csv")
    _write(p, 'sep=,\n"Follows"\nDate,"Primary"\n2025-12-16T00:00:00,"1"\nbad,"2"\n2025-12-17T00:00:00,"x"\n',
           "utf-16")
    t = exports.read_text_files(spark, p, exports.TIKTOK_ENCODINGS)
    rows = exports.parse_preamble_series(t, "follows").orderBy("date").collect()
    assert [(r["date"], r["value"]) for r in rows] == [(dt.date(2025, 12, 16), 1), (dt.date(2025, 12, 17), 0)]


def test_audience_sections(spark, tmp_path):
    p = str(tmp_path / "Audience.csv")
    _write(p, "Top countries\nGreece,South Korea,,Cyprus\n38.1,20.5,1.0,4\n"
              "Age & gender\nAge,Women,Men\n18-24,10.2,5.1\n25-34,20,10.05\nTop cities\nAthens,Seoul\n30,12\n")
    t = exports.read_text_files(spark, p)
    a = {(r["section"], r["name"]): r["value"] for r in exports.parse_audience(t).collect()}
    assert a[("countries", "Greece")] == 38.1 and ("countries", "") not in a
    assert a[("countries", "Cyprus")] == 4.0
    assert a[("age_gender", "18-24")] == 15.3
    assert a[("cities", "Seoul")] == 12.0
    assert ("age_gender", "Top cities") not in a


def test_instagram_export_ingest(spark, tmp_path):
    d = tmp_path / "instagram"
    hdr = '"Post ID","Description","Duration (sec)","Publish time","Permalink","Post type","Views","Reach","Likes","Shares","Follows","Comments","Saves"\n'
    rows = [
        '"1","gap","10","03/09/2025 02:30","u1","IG reel","5","100","10","1","0","2","3"\n',      # DST gap
        '"2","overlap","0","11/02/2025 01:30","u2","IG image","5","100","10","1","0","2","3"\n',  # DST overlap
        '"3","normal","0","3/1/2026 3:05","u3","Mystery","5","undefined","4","0","0","0","0"\n',  # reach undefined
        '"4","' + "x" * 250 + '","0","2026-03-02 10:00","u4","IG carousel","5","50","5","5","0","5","5"\n',
    ]
    _write(str(d / "export.csv"), "\ufeff" + hdr + "".join(rows))
    _write(str(d / "template.csv"), hdr)
    _write(str(d / "Follows.csv"), "Date,Primary\n")
    out = {r["post_id"]: r for r in exports.ingest_platform(spark, str(d), "instagram").collect()}
    assert set(out) == {"1", "2", "3", "4"}
    assert out["1"]["published_at"] is None and out["2"]["published_at"] is None
    assert out["3"]["published_at"] == dt.datetime(2026, 3, 1, 11, 5)       # PST -> UTC
    assert out["3"]["content_type"] == "other" and out["3"]["reach"] == 0 and out["3"]["engagement_rate"] == 0.0
    assert out["1"]["content_type"] == "short_video" and out["1"]["engagement_total"] == 16
    assert len(out["4"]["title"]) == 250   # whole captions by default


def test_json_export_flatten(spark, tmp_path):
    p = str(tmp_path / "x.json")
    _write(p, json.dumps([{"id": 1, "metrics": {"likes": 3, "reach": {"total": 9}}}]))
    df = exports.read_json_exports(spark, [p])
    assert {"id", "metrics.likes", "metrics.reach.total"} <= set(df.columns)


def test_greek_short_and_long(spark):
    short = spark.createDataFrame([("f", 1, "25 Φεβρουαρίου"), ("f", 2, "3 Δεκεμβρίου"), ("f", 3, "31 Φεβρουαρίου"),
                                   ("f", 4, "undefined"), ("f", 5, "2024-05-06")], "file string, row_no int, value string")
    r = {x["row_no"]: x["date"] for x in greek.parse_greek_dates(short, "2026-03-10").collect()}
    assert r[1] == dt.date(2026, 2, 25) and r[2] == dt.date(2025, 12, 3)
    assert r[3] is None and r[4] is None and r[5] == dt.date(2024, 5, 6)
    days = [dt.date(2024, 11, 1) + dt.timedelta(days=i) for i in range(90)]
    long = spark.createDataFrame([("g", i, f"{d.day} {greek.render_greek_month(d.month)}") for i, d in enumerate(days)],
                                 "file string, row_no int, value string")
    got = [x["date"] for x in greek.parse_greek_dates(long, "2025-01-29").orderBy("row_no").collect()]
    assert got == days


def test_country_and_percentage(spark):
    df = spark.createDataFrame([("GR", 0.381), ("RO", 0.141), ("XX", 0.01)], "c string, d double")
    rows = df.select(greek.country_name(F.col("c")).alias("n"), F.round(F.col("d") * 100, 1).alias("p")).collect()
    assert [(r["n"], r["p"]) for r in rows] == [("Greece", 38.1), ("Romania", 14.1), ("XX", 1.0)]


def test_landing_classify_and_validate(spark, tmp_path):
    d = tmp_path / "land"
    _write(str(d / "Overview.csv"), '"Date","Video Views","Profile Views","Likes"\n"1 Μαρτίου","1","2","3"\n')
    _write(str(d / "Mar-01-2026_Mar-07-2026_123.csv"), '"Post ID","Publish time","Reach"\n"1","03/01/2026 10:00","5"\n')
    _write(str(d / "random.csv"), "a,b\n1,2\n")
    _write(str(d / "Overview (1).csv"), '"Date","Video Views","Profile Views"\n')
    for i, n in enumerate(["Overview.csv", "Mar-01-2026_Mar-07-2026_123.csv", "random.csv", "Overview (1).csv"]):
        os.utime(str(d / n), (1_700_000_000 + i, 1_700_000_000 + i))   # arrival order
    files = landing.with_heads(spark, landing.list_landing(spark, str(d)), str(d))
    c = {r["file_name"]: r for r in landing.classify_files(files, "tiktok").collect()}
    assert c["Overview.csv"]["target"] == "Overview.csv" and c["Overview.csv"]["status"] == "ok"
    assert c["Mar-01-2026_Mar-07-2026_123.csv"]["status"] == "warn"
    assert c["random.csv"]["status"] == "err"
    assert c["Overview (1).csv"]["status"] == "err" and "already added" in c["Overview (1).csv"]["message"]
    v = {r["file_name"]: r for r in landing.validate_batch(files, "tiktok").collect()}
    assert v["Overview.csv"]["correct_name"] == "Overview.csv" and v["Overview.csv"]["error"] is None
    assert v["random.csv"]["error"] is not None and not v["random.csv"]["batch_ok"]


def test_history_versions_and_upsert(spark, tmp_path, posts):
    base = str(tmp_path / "hist")
    batch = posts.select(*[c for c in history.POSTS_SCHEMA.fieldNames() if c != "_ingested_at"]).limit(50)
    history.merge_posts_into_history(spark, base, batch, ingested_at="2026-01-01 00:00:00",
                                     platform_start={"instagram": "1990-01-01", "tiktok": "1990-01-01",
                                                     "youtube": "1990-01-01", "facebook": "1990-01-01"})
    bumped = batch.withColumn("likes", F.col("likes") + 1)
    history.merge_posts_into_history(spark, base, bumped, ingested_at="2026-02-01 00:00:00",
                                     platform_start={"instagram": "1990-01-01", "tiktok": "1990-01-01",
                                                     "youtube": "1990-01-01", "facebook": "1990-01-01"})
    assert len(history.versions(spark, base)) == 2
    h = history.read_history(spark, base)
    assert h.count() == 50
    joined = h.join(batch.select("post_id", "platform", F.col("likes").alias("l0")), ["post_id", "platform"])
    assert joined.where(F.col("likes") != F.col("l0") + 1).count() == 0


def test_incremental_stream(spark, tmp_path):
    from pulsekit.streaming.ingest import INSTAGRAM_EXPORT_COLUMNS, start_incremental_ingest
    land, base = tmp_path / "landing", str(tmp_path / "hist")
    hdr = ",".join(f'"{c}"' for c in INSTAGRAM_EXPORT_COLUMNS) + "\n"

    def row(pid, likes):
        vals = {"Post ID": pid, "Publish time": "03/01/2026 10:00", "Post type": "IG reel", "Reach": "100",
                "Likes": str(likes)}
        return ",".join(f'"{vals.get(c, "")}"' for c in INSTAGRAM_EXPORT_COLUMNS) + "\n"
    _write(str(land / "a.csv"), hdr + row("1", 5) + row("2", 7))
    start = {"instagram": "1990-01-01"}
    q = start_incremental_ingest(spark, str(land), base, "instagram", checkpoint=str(tmp_path / "ck"),
                                 platform_start=start)
    q.awaitTermination()
    _write(str(land / "b.csv"), hdr + row("2", 9) + row("3", 1))
    q = start_incremental_ingest(spark, str(land), base, "instagram", checkpoint=str(tmp_path / "ck"),
                                 platform_start=start)
    q.awaitTermination()
    h = {r["post_id"]: r["likes"] for r in history.read_history(spark, base).collect()}
    assert h == {"1": 5, "2": 9, "3": 1}


def test_normalize_column_map_first_candidate_wins():
    cm = normalize.build_column_map(["\ufeffPost ID", "Reach", "Impressions"], normalize.SOURCE_SPECS["instagram"])
    assert cm["post_id"] == "\ufeffPost ID" and cm["reach"] == "Reach" and cm["views"] == "Impressions"


def test_youtube_watch_hours_heuristic(spark):
    hours = spark.createDataFrame([("a", "Video 1", "2.5"), ("b", "Video 2", "1")],
                                  "`Video ID` string, `Video title` string, `Watch time (hours)` string")
    secs = spark.createDataFrame([("c", "Video 3", "5000"), ("d", "Video 4", "7000")],
                                 "`Video ID` string, `Video title` string, `Watch time (hours)` string")
    h = {r["post_id"]: r["watch_time_sec"] for r in normalize.normalize_export(hours, "youtube").collect()}
    s = {r["post_id"]: r["watch_time_sec"] for r in normalize.normalize_export(secs, "youtube").collect()}
    assert h == {"a": 7200, "b": 3600}      # int() truncation before the unit switch, as the reference
    assert s == {"c": 5000, "d": 7000}


def test_legacy_encoding_fallback(spark, tmp_path):
    p = str(tmp_path / "kr.csv")
    _write(p, "제목,좋아요\n서울 여행,12\n", "cp949")
    t = exports.read_text_files(spark, p)
    assert t.first()["text"].startswith("제목,좋아요")


def test_demographics_version_log(spark, tmp_path):
    log = str(tmp_path / "demo_log")
    d1 = spark.createDataFrame([("tiktok", "GR", 38.1)], "platform string, code string, percentage double")
    d2 = spark.createDataFrame([("tiktok", "GR", 40.0)], "platform string, code string, percentage double")
    history.append_demographics(spark, log, d1, "2026-03-01")
    history.append_demographics(spark, log, d2, "2026-03-08")
    latest = history.latest_demographics(spark, log).collect()
    assert len(latest) == 1 and latest[0]["percentage"] == 40.0
    assert spark.read.json(log).count() == 2


def test_every_file_of_a_folder_in_its_own_encoding(spark, tmp_path):
    d = tmp_path / "instagram"
    hdr = "Post ID,Description,Publish time,Post type,Reach,Likes\n"
    _write(str(d / "kr.csv"), hdr + '1,"서울\n여행",3/1/2026 3:05,IG reel,10,2\n', "cp949")
    _write(str(d / "sub dir" / "plain.csv"), "﻿" + hdr + '2,"été, ""quoted""","Mar 1, 2026",IG image,10,2\n')
    _write(str(d / "latin.CSV"), "Likes,Post ID,Description\n5,3,café\n", "latin-1")
    _write(str(d / "good.json"), json.dumps([{"post_id": "4", "description": "j", "likes": 1}]))
    _write(str(d / "broken.json"), '{"post_id": "5", ')
    (d / "empty.csv").write_bytes(b"")
    out = {r["post_id"]: r for r in exports.ingest_platform(spark, str(d), "instagram").collect()}
    assert set(out) == {"1", "2", "3", "4"}
    assert out["1"]["title"] == "서울\n여행" and out["2"]["title"] == 'été, "quoted"' and out["3"]["title"] == "café"
    assert out["1"]["likes"] == 2 and out["3"]["likes"] == 5
    assert out["2"]["published_at"] == dt.datetime(2026, 3, 1, 8, 0)


def test_other_encodings_of_the_second_platform(spark, tmp_path):
    d = tmp_path / "tiktok"
    hdr = "Video title,Video link,Post time,Total likes,Total views\n"
    _write(str(d / "Content.csv"), hdr + "Χαρά,https://x/video/7,2026-03-01,3,9\n", "utf-16")
    _write(str(d / "content_old.csv"), hdr + "Χαρά μου,https://x/video/8,2026-03-01,4,9\n", "cp1253")
    out = {r["post_id"]: r for r in exports.ingest_platform(spark, str(d), "tiktok").collect()}
    assert {k: (v["title"], v["likes"]) for k, v in out.items()} == {"7": ("Χαρά", 3), "8": ("Χαρά μου", 4)}


def test_written_dates(spark):
    cases = {"3/1/2026 3:05": "2026-03-01 03:05:00", "2026-03-01T10:00": "2026-03-01 10:00:00", "Mar 1, 2026": "2026-03-01 00:00:00",
             "March 1, 2026 4:30 PM": "2026-03-01 16:30:00", "1 March 2026": "2026-03-01 00:00:00", "2026/3/1 7:08": "2026-03-01 07:08:00",
             "3/1/2026": "2026-03-01 00:00:00", "Sep. 5 2025 11:00": "2025-09-05 11:00:00", "soon": None, "": None, None: None}
    df = spark.createDataFrame([(k,) for k in cases], "s string")
    got = {r["s"]: r["t"] for r in df.select("s", normalize.parse_local_time(F.col("s")).cast("string").alias("t")).collect()}
    assert got == cases
