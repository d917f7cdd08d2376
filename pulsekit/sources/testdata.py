"""Views over the driver's parquet tables that stand in for real exports.

``posts``: one post per order.  Platform, content type, timestamps and
metrics are derived deterministically from ``orders`` / ``lineitem``;
the caption is the whole text of a ``documents`` row plus a hashtag/emoji
suffix.  ``account_events_daily``: per-day account metrics from ``events``.
Both equal the SQL in ``pulsekit.plans.oracle`` row for row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsekit.functions import exprs as X

POST_COLUMNS = [
    "post_id", "platform", "published_at", "content_type", "title", "permalink",
    "duration_sec", "reach", "views", "likes", "comments", "shares", "saves",
    "followers_gained", "link_clicks", "watch_time_sec", "avg_watch_sec",
    "engagement_total", "engagement_rate",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _title(text: F.Column, post: F.Column) -> F.Column:
    """A post's caption: its document's whole text and a suffix by key."""
    suffix = X.map_lit({0: " #seoul", 1: " #서울 #Seoul", 2: " #Χαρά", 3: " 🙏"})
    return F.concat(text, F.coalesce(F.element_at(suffix, (post % 7).cast("int")), F.lit("")))


def raw_posts(spark: SparkSession, sf_dir: str, captions: bool = True) -> DataFrame:
    """The unified post table, before weights.

    Without ``captions``, the column ``doc_key`` stands in place of ``title``: whole texts are not read.
    """
    # Dealt out by key while rows are narrow: the lines join on that key, and the captions
    # that come later lie in as many partitions, however few splits the file has.
    n_parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority").repartition(n_parts, "o_orderkey")
    # Pre-aggregate lineitem per order before the join (partial + final agg).
    li = (table(spark, sf_dir, "lineitem")
          .groupBy("l_orderkey")
          .agg(F.count(F.lit(1)).alias("n_lines"),
               F.sum("l_quantity").alias("qty"),
               F.sum(F.when(F.col("l_returnflag") == "R", 1).otherwise(0)).alias("n_ret"),
               F.sum(F.when(F.col("l_linestatus") == "F", 1).otherwise(0)).alias("n_fin")))
    docs = table(spark, sf_dir, "documents").select("doc_id", *["text"] * captions)
    n_docs = docs.select(F.count(F.lit(1))).scalar()   # one-row scalar subquery

    k = F.col("o_orderkey")
    platform = (F.when(k.isNull(), None)
                .when(F.col("o_custkey") % 4 == 0, "instagram")
                .when(F.col("o_custkey") % 4 == 1, "youtube")
                .when(F.col("o_custkey") % 4 == 2, "facebook")
                .otherwise("tiktok"))
    b = (orders.join(li, orders.o_orderkey == li.l_orderkey, "left")
         .select(
             k, k.cast("string").alias("post_id"), platform.alias("platform"),
             F.col("o_orderdate").alias("od"),
             F.substring("o_orderpriority", 1, 1).alias("pr"),
             F.when(k % 97 == 0, F.lit(0).cast("long"))
              .otherwise(F.floor(F.col("o_totalprice") / 100).cast("long")).alias("reach"),
             F.coalesce("qty", F.lit(0)).cast("long").alias("likes"),
             F.coalesce("n_lines", F.lit(0)).cast("long").alias("comments"),
             F.coalesce("n_ret", F.lit(0)).cast("long").alias("shares"),
             F.coalesce("n_fin", F.lit(0)).cast("long").alias("saves"),
             (k % n_docs).alias("doc_key")))
    hours = F.make_dt_interval(F.lit(0), (k % 24).cast("int"), (k % 60).cast("int"))
    published = (F.when(k % 101 == 0, F.lit(None).cast("timestamp_ntz"))
                 .when(F.col("platform") == "tiktok", F.col("od") - F.expr("INTERVAL 9 HOURS"))
                 .otherwise(F.col("od") + hours))
    ctype = X.map_lit({"1": "short_video", "2": "long_video", "3": "image", "4": "carousel"})
    eng = F.col("likes") + F.col("comments") + F.col("shares") + F.col("saves")
    return (b.join(docs, b.doc_key == docs.doc_id, "inner")
            .select(
                "post_id", "platform",
                published.alias("published_at"),
                F.coalesce(F.element_at(ctype, F.col("pr")), F.lit("story")).alias("content_type"),
                _title(F.col("text"), k).alias("title") if captions else "doc_key",
                F.concat(F.lit("https://example.com/p/"), F.col("post_id")).alias("permalink"),
                ((k % 5) * 15).cast("long").alias("duration_sec"),
                "reach", F.col("reach").alias("views"), "likes", "comments", "shares", "saves",
                (k % 11).cast("long").alias("followers_gained"),
                (k % 3).cast("long").alias("link_clicks"),
                ((k % 5) * 10 * F.col("likes")).cast("long").alias("watch_time_sec"),
                ((k % 5) * 2.5).cast("double").alias("avg_watch_sec"),
                eng.alias("engagement_total"),
                F.when(F.col("reach") > 0, F.least(eng.cast("double") / F.col("reach"), F.lit(1.0)))
                 .otherwise(F.lit(0.0)).alias("engagement_rate")))


_CACHE: dict = {}


def bare_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prepared posts (weights + KST calendar fields) with ``doc_key`` in place of the caption, cached per session."""
    from pulsekit.operators.prepare import prepare_posts
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _CACHE:
        _CACHE[key] = prepare_posts(raw_posts(spark, sf_dir, captions=False)).persist()
    return _CACHE[key]


def posts(spark: SparkSession, sf_dir: str, cache: bool = True) -> DataFrame:
    """Prepared posts (weights + KST calendar fields); all but the captions is cached per session.

    Whole captions are many times the size of the rest, and only some queries read them: they come
    by key where they are read.  At production scale the same frame comes from the partitioned history
    snapshot (``pulsekit.sources.history``) instead of this view.
    """
    from pulsekit.operators.prepare import prepare_posts
    whole = prepare_posts(raw_posts(spark, sf_dir))
    titled = captions(spark, sf_dir) if cache else None
    return whole if titled is None else titled(bare_posts(spark, sf_dir)).select(*whole.columns)


def captions(spark: SparkSession, sf_dir: str) -> Callable[[DataFrame], DataFrame] | None:
    """What gives rows with ``doc_key`` and ``post_id`` their ``title``; None where documents repeat an id, so that a key names no one text.

    A step that reads captions for a result about posts gives them to that narrow result: texts stay where they are read.
    """
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("doc_key"), "text")
    key = (spark.sparkContext.applicationId, sf_dir, "repeated ids")
    if key not in _CACHE:
        twice = docs.where("doc_key IS NOT NULL").groupBy("doc_key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        _CACHE[key] = not twice.isEmpty()
    if _CACHE[key]:                                   # bare posts have a row per document of their key already
        return None
    return lambda rows: rows.join(docs, "doc_key").withColumn("title", _title(F.col("text"), F.col("post_id").cast("long"))).drop("text")


def account_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long daily metric series ``(platform, metric, date, value)`` from ``events``.

    Every event is used.  The account is derived from the user
    (``floor(user_id / 7) % 2`` -> instagram / tiktok); each event type plays
    one exported metric file, so a day on which a type never occurs is a gap
    that the densifying spine (A1/J2) must fill with 0.
    """
    ev = table(spark, sf_dir, "events").select("ts", "user_id", "event_type", "value")
    acct = F.when(F.floor(F.col("user_id") / 7).cast("long") % 2 == 0, "instagram").otherwise("tiktok")
    metric = X.map_lit({"view": "views", "signup": "follows", "click": "interactions",
                        "purchase": "link_clicks", "error": "visits"})
    d = ev.select(acct.alias("platform"), F.to_date("ts").alias("date"), "user_id",
                  F.element_at(metric, F.col("event_type")).alias("metric"),
                  F.when(F.col("event_type") == "view", F.floor("value")).otherwise(F.lit(1)).cast("long").alias("v"))
    per_metric = (d.where(F.col("metric").isNotNull())
                  .groupBy("platform", "metric", "date").agg(F.sum("v").alias("value")))
    reach = (d.groupBy("platform", "date")
             .agg(F.count_distinct("user_id").alias("value"))
             .select("platform", F.lit("reach").alias("metric"), "date", "value"))
    return per_metric.unionByName(reach)


def post_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A caption vector for every post: (vec_id = post id, embedding), dealt from ``embeddings`` by key."""
    e = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("_v"), "embedding")
    n = (e.agg(F.max("_v")).first()[0] or 0) + 1      # one number
    keys = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("vec_id"))
    return keys.join(e, F.pmod("vec_id", F.lit(n)) == F.col("_v")).select("vec_id", "embedding")
