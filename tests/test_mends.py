"""Cases that once went wrong: ties, zero vectors, negative metrics, history files, headers, settings."""

import os

import pytest
from pyspark.sql import functions as F

from pulsekit import session
from pulsekit.operators import history as H
from pulsekit.operators import ml, similarity, text
from pulsekit.sources import history, landing
from pulsekit.sources.testdata import raw_posts


def test_neighbours_do_not_depend_on_blocks(spark):
    rows = [("p", f"{i:04d}", 0.1 * (i % 7), None, [1.0, 2.0]) for i in range(300)] + [("p", "zero", 0.5, None, [0.0, 0.0])]
    v = spark.createDataFrame(rows, "platform string, post_id string, engagement_rate double, published_at timestamp_ntz, vec array<double>")
    a, b = ([tuple(r) for r in similarity.neighbours(v, 3, n).orderBy("post_id", "nb_rank").collect()] for n in (64, 4096))
    assert a == b and [r[2] for r in a if r[1] == "0000"] == ["0001", "0002", "0003"]
    assert [(r[2], r[3]) for r in a if r[1] == "zero"] == [("0000", 0.0), ("0001", 0.0), ("0002", 0.0)]


def test_lost_followers_stay(spark):
    p = raw_posts(spark, "/root/testdata/sf0.001").limit(5).withColumns({"followers_gained": F.lit(-7).cast("long"), "likes": F.lit(-3).cast("long")})
    got = H.sanitize_metrics(p).collect()
    assert all(r["followers_gained"] == -7 and r["likes"] == 0 for r in got)


def test_history_with_csv_files(spark, tmp_path, posts):
    base = str(tmp_path / "h")
    batch = posts.select(*[c for c in history.POSTS_SCHEMA.fieldNames() if c != "_ingested_at"]).limit(20)
    batch = batch.withColumn("_ingested_at", F.lit("2026-01-01 00:00:00").cast("timestamp_ntz"))
    history.write_snapshot(batch, base, "1", csv_copy=True)
    assert history.versions(spark, base) == ["1"] and history.read_history(spark, base).count() == 20
    flat = batch.withColumn("title", F.lit("t")).select(*history.POSTS_SCHEMA.fieldNames())
    flat.write.option("header", True).csv(f"{base}/v=2")
    assert history.versions(spark, base) == ["1", "2"]
    back = history.read_history(spark, base)
    assert back.count() == 20 and back.agg(F.sum("likes")).first()[0] == batch.agg(F.sum("likes")).first()[0]


def test_newest_demographics_keep_every_row(spark, tmp_path):
    log = str(tmp_path / "log")
    for day, rows in (("2026-01-01", [("a", "GR", 1.0)]), ("2026-01-08", [("a", "GR", 2.0), ("a", "KR", 3.0), (None, "FR", 4.0)])):
        history.append_demographics(spark, log, spark.createDataFrame(rows, "platform string, code string, percentage double"), day)
    assert sorted(r["percentage"] for r in history.latest_demographics(spark, log).collect()) == [2.0, 3.0, 4.0]


def test_outliers_do_not_depend_on_the_layout(spark, posts):
    few = posts.limit(400).cache()
    a, b = ({(r["platform"], r["post_id"]) for r in ml.isolation_outliers(x, n_trees=10).collect()} for x in (few, few.repartition(11)))
    assert a == b and a


def test_headers_are_read_whole(spark, tmp_path):
    (tmp_path / "odd.csv").write_text("x" * 9000 + ",Total followers,Date\n1,2,3\n" + "y" * 100_000)
    files = landing.with_heads(spark, landing.list_landing(spark, str(tmp_path)), str(tmp_path))
    r = landing.classify_files(files, "tiktok").first()
    assert (r["target"], r["status"]) == ("FollowerHistory.csv", "ok")
    assert landing.classify_files(files, "tiktok", max_bytes=1000).first()["status"] == "err"
    many = files.withColumn("file_name", F.lit("Overview.csv"))
    assert landing.validate_batch(many, "tiktok").first()["batch_ok"] and not landing.validate_batch(many, "tiktok", max_files=0).first()["batch_ok"]


def test_columns_in_another_order_are_not_misread(spark, tmp_path):
    (tmp_path / "a.csv").write_text("b,a\n1,2\n")
    with pytest.raises(Exception):
        spark.read.schema("a string, b string").option("header", True).option("enforceSchema", False).csv(str(tmp_path)).collect()


def test_stop_words_are_fixed(spark):
    from pulsekit.plans.oracle import STOP_WORDS
    assert text.default_stop_words() == STOP_WORDS and "the" in STOP_WORDS



def test_no_made_up_checkpoint_folder_on_a_cluster(monkeypatch):
    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        conf = Conf()
        sparkContext = type("C", (), {"master": "spark://host:7077", "getConf": lambda self: Conf()})()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session())


def test_given_settings_stay(spark):
    for key in ("spark.sql.shuffle.partitions", "spark.sql.session.timeZone"):
        before = spark.conf.get(key)
        session.get_spark()
        assert spark.conf.get(key) == before
    assert "SPARK_MASTER" not in os.environ


def test_percentiles_equal_the_built_in_ones(spark):
    from pulsekit.functions.order_stats import percentiles
    rows = [(k, float(v), None if v % 5 == 0 else v * 1e-6) for k, n in (("a", 101), ("b", 2), ("c", 1), (None, 40)) for v in range(-n // 2, n)]
    rows += [("a", 7.0, 0.25)] * 50 + [("d", None, None)]
    df = spark.createDataFrame(rows, "k string, x double, y double")
    wanted = {"x50": ("x", 0.5), "x25": ("x", 0.25), "y75": ("y", 0.75), "y100": ("y", 1.0)}
    got = {r["k"]: tuple(r)[1:] for r in percentiles(df, ["k"], wanted).collect()}
    want = {r["k"]: tuple(r)[1:] for r in df.groupBy("k").agg(*[F.percentile(c, q).alias(n) for n, (c, q) in wanted.items()]).collect()}
    assert got.keys() == want.keys() - {"d"}
    assert all(a == pytest.approx(b) for k in got for a, b in zip(got[k], want[k]))


def test_a_merge_writes_only_the_months_it_touches(spark, tmp_path, posts):
    base, start = str(tmp_path / "h"), {p: "1990-01-01" for p in ("instagram", "tiktok", "youtube", "facebook")}
    cols = [c for c in history.POSTS_SCHEMA.fieldNames() if c != "_ingested_at"]
    batch = posts.select(*cols).limit(200)
    history.merge_posts_into_history(spark, base, batch, "2026-01-01 00:00:00", start)
    v1 = history.versions(spark, base)[-1]
    one = batch.where(F.col("published_at").isNotNull()).orderBy("post_id").limit(1).cache()
    # the post moves to another month; its old row must go
    moved = one.withColumn("likes", F.col("likes") + 5).withColumn("published_at", F.col("published_at") + F.expr("INTERVAL 100 DAYS"))
    history.merge_posts_into_history(spark, base, moved, "2026-02-01 00:00:00", start)
    v2 = history.versions(spark, base)[-1]
    m1, m2 = (history.manifest(spark, base, v) for v in (v1, v2))
    assert sum(v == v2 for v in m2.values()) <= 2 and sum(v == v1 for v in m2.values()) >= len(m1) - 2
    got = history.read_history(spark, base)
    pid = one.first()["post_id"]
    assert got.count() == 200 and [r["likes"] for r in got.where(F.col("post_id") == pid).collect()] == [one.first()["likes"] + 5]
    assert history.read_history(spark, base, v1).count() == 200
