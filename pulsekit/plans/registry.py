"""Query registry: name -> (spark, sf_dir) -> DataFrame.

Every entry reads the driver's tables (or data Spark derives from them)
in full; the matching DuckDB text lives in ``pulsekit.plans.oracle.SQL``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pulsekit.operators import growth, kpi, scoring, temporal
from pulsekit.sources.testdata import bare_posts, posts

Query = Callable[[SparkSession, str], DataFrame]


def _on_posts(fn, captions: bool = False) -> Query:
    """A query over the posts; only those that name ``captions`` read whole texts."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn((posts if captions else bare_posts)(spark, sf_dir))
    run.__name__ = getattr(fn, "__name__", "query")
    return run


QUERIES: dict[str, Query] = {
    "platform_overview": _on_posts(kpi.platform_overview),
    "top_post_per_platform": _on_posts(kpi.top_post_per_platform),
    "wow_change": _on_posts(kpi.wow_change),
    "content_performance": _on_posts(kpi.content_performance),
    "platform_content_ranking": _on_posts(kpi.platform_content_ranking),
    "engagement_composition": _on_posts(kpi.engagement_composition),
    "engagement_mix_platform": _on_posts(kpi.engagement_mix_platform),
    "cross_platform_averages": _on_posts(kpi.cross_platform_averages),
    "content_platform_fit": _on_posts(kpi.content_platform_fit),
    "meta": _on_posts(kpi.meta),
    "content_unweighted": _on_posts(kpi.content_unweighted),
    "mix_unpivot": _on_posts(kpi.mix_unpivot),
    "cross_platform_table": _on_posts(lambda p: kpi.cross_platform_table(kpi.platform_overview(p))),
    # temporal
    "hourly_profile": _on_posts(temporal.hourly_profile),
    "daily_profile": _on_posts(temporal.daily_profile),
    "best_times_platform": _on_posts(temporal.best_times_platform),
    "heatmap_pivot": _on_posts(temporal.heatmap_pivot),
    "weekly_schedule": _on_posts(temporal.weekly_schedule),
    "schedule_days": _on_posts(temporal.schedule_days),
    "top5_slots": _on_posts(temporal.top5_slots),
    "avoid_slots": _on_posts(temporal.avoid_slots),
    "next_best_time": _on_posts(temporal.next_best_time),
    # growth
    "weekly_rollup": _on_posts(growth.weekly_rollup),
    "weekly_growth": _on_posts(growth.weekly_growth),
    "trajectory": _on_posts(growth.trajectory),
    "platform_growth": _on_posts(growth.platform_growth),
    "trend_label": _on_posts(growth.trend_label),
    "weekly_series_monday": _on_posts(growth.weekly_series_monday),
    "forecast_params": _on_posts(growth.forecast_params_view),
    "stat_forecast": _on_posts(growth.stat_forecast),
    "forecast_summary": _on_posts(growth.forecast_summary),
    "health": _on_posts(growth.health),
    "weekly_dense_90d": _on_posts(growth.weekly_dense_90d),
    "seasonal_index": _on_posts(growth.seasonal_index),
    # scoring
    "viral_posts": _on_posts(scoring.viral_posts),
    "underperformers": _on_posts(scoring.underperformers),
    "scored_posts": _on_posts(scoring.scored_posts_view),
    "scores_by_type": _on_posts(scoring.scores_by_type),
    "scores_by_platform": _on_posts(scoring.scores_by_platform),
    "top_scored": _on_posts(scoring.top_scored),
    "expected_performance": _on_posts(scoring.expected_performance),
}


# ---------------------------------------------------------------------------
# Account daily (A1–A9, J2, J3, F5, F6) over the events-derived series
# ---------------------------------------------------------------------------
from pyspark.sql import Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from pulsekit.functions import exprs as X  # noqa: E402

from pulsekit.operators import account, history  # noqa: E402
from pulsekit.sources.testdata import account_series, captions, post_embeddings, raw_posts, table  # noqa: E402


def _daily(spark, sf_dir):
    return account.account_daily(account_series(spark, sf_dir))


def _export_windows(spark, sf_dir):
    """Two overlapping weekly-style exports of the same account series: the
    first up to 7 days past the midpoint of the event span, the second from
    the midpoint on.  Together they cover every event."""
    s = account_series(spark, sf_dir)
    span = s.select(F.struct(F.min("date").alias("lo"), F.max("date").alias("hi"))).scalar()
    mid = F.date_add(span.getField("lo"), (F.datediff(span.getField("hi"), span.getField("lo")) / 2).cast("int"))
    first = s.where(F.col("date") < F.date_add(mid, 7))
    second = s.where(F.col("date") >= mid)
    return account.daily_dense(first), account.daily_dense(second)


def _upsert_daily(spark, sf_dir):
    a, b = _export_windows(spark, sf_dir)
    return history.upsert_daily(a, b)


# Platform start dates matching the span of the test tables (the reference's
# own dates, 2025/2026, post-date every order in them).
TEST_PLATFORM_START = {"instagram": "1996-01-01", "tiktok": "1997-06-01",
                       "youtube": "1995-01-01", "facebook": "1995-01-01"}


def _upsert_posts(spark, sf_dir):
    p = raw_posts(spark, sf_dir)
    now = p.select(F.max("published_at")).scalar()
    hist = p.where(F.col("published_at").isNull() | (F.col("published_at") < now - F.expr("INTERVAL 30 DAYS")))
    new = (p.where(F.col("published_at") >= now - F.expr("INTERVAL 120 DAYS"))
           .withColumns({"likes": F.col("likes") + 1, "engagement_total": F.col("engagement_total") + 1}))
    new = history.sanitize_metrics(new)
    m = history.upsert_posts(hist, new, ingested_at="2026-01-01 00:00:00")
    return m.select("post_id", "platform", "likes", "engagement_total", F.round("engagement_rate", 6).alias("engagement_rate"),
                    F.date_format("_ingested_at", "yyyy-MM-dd HH:mm:ss").alias("ingested_at"))


def _cleanup_posts(spark, sf_dir):
    c = history.cleanup(raw_posts(spark, sf_dir), TEST_PLATFORM_START)
    return c.select("post_id", "platform", "engagement_total", F.round("engagement_rate", 6).alias("engagement_rate"),
                    F.length("title").alias("title_chars"))


def _cleanup_negative(spark, sf_dir):
    """F2 on metrics shifted below zero: counts are clipped, lost followers are not."""
    p = raw_posts(spark, sf_dir).withColumns({
        "likes": F.col("likes") - 60, "reach": F.col("reach") - 400, "engagement_total": F.col("engagement_total") - 60,
        "followers_gained": F.col("followers_gained") - 5, "link_clicks": F.col("link_clicks") - 1})
    c = history.sanitize_metrics(p)
    return c.select("post_id", "platform", "likes", "reach", "engagement_total", "followers_gained", "link_clicks",
                    F.round("engagement_rate", 6).alias("engagement_rate"))


def _union_missing(spark, sf_dir):
    p = raw_posts(spark, sf_dir)
    base = ["post_id", "platform", "reach", "likes", "comments"]
    frames = [p.where(F.col("platform") == "instagram").select(*base, "shares", "saves"),
              p.where(F.col("platform") == "youtube").select(*base, "watch_time_sec"),
              p.where(F.col("platform") == "facebook").select(*base, "shares", "link_clicks"),
              p.where(F.col("platform") == "tiktok").select(*base, "shares")]
    return history.union_missing(frames, fill_zero=["shares", "saves", "watch_time_sec", "link_clicks"])


QUERIES.update({
    "account_daily_dense": lambda s, d: account.daily_dense(account_series(s, d)),
    "account_rate": lambda s, d: _daily(s, d).select("platform", "date", "engagement_rate_daily"),
    "rolling_7d": lambda s, d: _daily(s, d).select("platform", "date", *[f"{c}_7d_avg" for c in account.ROLLING]),
    "week_columns": lambda s, d: _daily(s, d).select("platform", "date", "week", "year_week"),
    "trim_nonzero": lambda s, d: account.trim_nonzero(account.clip_90d(_daily(s, d))).select(
        "platform", "date", "reach", "views", "follows", "follower_count"),
    "account_kpis": lambda s, d: account.account_kpis(_daily(s, d)),
    "followers_fallback": lambda s, d: account.followers_fallback(posts(s, d), _daily(s, d)),
    "combine_first": lambda s, d: account.combine_first(
        _daily(s, d).select("platform", "date", "views", "reach", "follows", "follower_count"), ["instagram", "tiktok"]),
    "hourly_activity": lambda s, d: account.hourly_activity(table(s, d, "events")),
    "upsert_daily": _upsert_daily,
    "upsert_posts": _upsert_posts,
    "cleanup_posts": _cleanup_posts,
    "cleanup_negative": _cleanup_negative,
    "union_missing_cols": _union_missing,
})


# ---------------------------------------------------------------------------
# Text and trend analytics
# ---------------------------------------------------------------------------
from pulsekit.operators import text, trends  # noqa: E402


def _post_features(p):
    return text.post_features(p).select(
        "post_id", "platform", "content_type", "hour", "day_of_week", "is_weekend", "caption_length",
        "hashtag_count", "has_emoji", "is_multilingual", "duration_sec",
        F.round("engagement_rate", 6).alias("engagement_rate"), "weight")


QUERIES.update({
    "post_features": _on_posts(_post_features, captions=True),
    "term_lift": _on_posts(text.term_lift, captions=True),
    "driver_corr": _on_posts(text.driver_corr, captions=True),
    "driver_lift": _on_posts(text.driver_lift, captions=True),
    "hashtag_perf": _on_posts(text.hashtag_perf, captions=True),
    "content_fatigue": _on_posts(trends.content_fatigue),
    "posting_cadence": _on_posts(trends.posting_cadence),
    "cadence_summary": _on_posts(trends.cadence_summary),
    "momentum": _on_posts(trends.momentum),
})


# ---------------------------------------------------------------------------
# Similar-post prediction (J5 / M18) over the embeddings table
# ---------------------------------------------------------------------------
from pulsekit.operators import similarity  # noqa: E402


def _emb(fn, captions=False):
    def run(spark, sf_dir):
        return fn((posts if captions else bare_posts)(spark, sf_dir), post_embeddings(spark, sf_dir))
    return run


QUERIES.update({
    "similar_posts": _emb(similarity.similar_posts),
    "similar_ranked": _emb(similarity.similar_ranked),
    "similar_summary": _emb(similarity.similar_summary),
    "similar_recent": _emb(similarity.similar_recent),
})


# ---------------------------------------------------------------------------
# Models (M3–M8, M16, M17, M20, M21) — rows-only checks except the status table
# ---------------------------------------------------------------------------
from pulsekit.operators import ml  # noqa: E402


def _topics(spark, sf_dir):
    titled, e = captions(spark, sf_dir), post_embeddings(spark, sf_dir)
    return ml.topics(posts(spark, sf_dir), e) if titled is None else ml.topics(bare_posts(spark, sf_dir), e, titled=titled)


QUERIES.update({
    "caption_pca": _emb(lambda p, e: ml.caption_pca(p, e).select(
        "platform", "post_id", F.size("pca").alias("n_components"), "explained_variance")),
    "feature_importance": _emb(ml.feature_importance, captions=True),
    "feature_rollup": _emb(lambda p, e: ml.feature_rollup(ml.feature_importance(p, e)), captions=True),
    "engagement_predictor": _emb(ml.engagement_predictor, captions=True),
    "root_cause": _emb(ml.root_cause, captions=True),
    "content_tiers": _on_posts(ml.content_tiers),
    "isolation_outliers": _on_posts(ml.isolation_outliers),
    "topics": _topics,
    "hashtag_clusters": _emb(ml.hashtag_clusters, captions=True),
    "ml_suite_status": _on_posts(ml.ml_suite_status),
})


# ---------------------------------------------------------------------------
# Ingestion paths driven from the test tables (N1–N11, N5 DST rule, N6)
# ---------------------------------------------------------------------------
from pulsekit.sources import greek, normalize  # noqa: E402


def _ingest_roundtrip(spark, sf_dir):
    """Every post rendered as a vendor export, then normalised back."""
    exp = normalize.render_instagram_export(raw_posts(spark, sf_dir))
    u = normalize.normalize_export(exp, "instagram")
    return u.select("post_id", "platform", "content_type",
                    F.date_format("published_at", "yyyy-MM-dd HH:mm:ss").alias("published_at"),
                    "reach", "views", "likes", "comments", "shares", "saves", "followers_gained",
                    "engagement_total", F.round("engagement_rate", 6).alias("engagement_rate"),
                    F.length("title").alias("title_chars"))


def _greek_dates(spark, sf_dir):
    """Each platform's posting days as a TikTok-style file of year-less
    Greek dates in file order, parsed back with year inference."""
    p = posts(spark, sf_dir).where(F.col("published_at").isNotNull())
    days = p.select("platform", F.to_date(X.kst("published_at")).alias("d")).distinct()
    w = Window.partitionBy("platform").orderBy("d")
    rows = (days.withColumn("row_no", F.row_number().over(w))
            .withColumn("_asof", F.max("d").over(Window.partitionBy("platform")))
            .select(F.col("platform").alias("file"), "row_no", greek.render_greek_date(F.col("d")).alias("value"), "_asof"))
    out = greek.parse_greek_dates(rows, F.col("_asof"))
    return out.select("file", "row_no", "value", "date")


QUERIES.update({
    "ingest_roundtrip": _ingest_roundtrip,
    "greek_dates": _greek_dates,
})


# ---------------------------------------------------------------------------
# Insight tables
# ---------------------------------------------------------------------------
from pulsekit.operators import insights  # noqa: E402

QUERIES.update({
    "recommendations": _on_posts(insights.recommendations),
    "pulse": _on_posts(insights.pulse),
    "key_numbers": _on_posts(insights.key_numbers),
    "summary_lists": _on_posts(insights.summary_lists, captions=True),
})


# ---------------------------------------------------------------------------
# File parsers over texts rendered from the tables (S4, S5, S14, S15, N15, N16,
# N18), the TikTok-style account table (A5), tag rows (J8), scoring bundle (X11)
# ---------------------------------------------------------------------------
from pulsekit.sources import exports, landing  # noqa: E402

SERIES_METRICS = ["follows", "interactions", "link_clicks", "reach", "views", "visits"]


def _preamble_series(spark, sf_dir):
    """Every daily series as a file with preamble, parsed back."""
    rows = account_series(spark, sf_dir)
    line = F.concat(F.lit('"'), F.date_format("date", "yyyy-MM-dd"), F.lit('T00:00:00","'), F.col("value").cast("string"), F.lit('"'))
    files = (rows.groupBy("platform", "metric").agg(F.array_sort(F.collect_list(line)).alias("v"))   # a day per line
             .select("metric", F.concat_ws("/", "platform", "metric").alias("path"), F.concat(
                 F.lit('sep=,\n"Title"\n"Date","Primary"\n'), F.array_join("v", "\n")).alias("text")))
    out = [exports.parse_preamble_series(files.where(F.col("metric") == m).select("path", "text"), m) for m in SERIES_METRICS]
    return history.union_missing(out)


def _audience_sections(spark, sf_dir):
    """Customers per country, segment and age band, rendered as one audience file per region."""
    c = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    c = c.select("n_regionkey", "n_name", "c_mktsegment", F.concat(F.lit("band "), (F.col("c_custkey") % 4).cast("string")).alias("age"),
                 (F.col("c_custkey") % 3 == 0).alias("man"))

    def listed(col, title):
        n = c.groupBy("n_regionkey", F.col(col).alias("k")).agg(F.count(F.lit(1)).alias("n"))
        v = n.groupBy("n_regionkey").agg(F.array_sort(F.collect_list(F.struct("k", "n"))).alias("v"))
        pick = lambda f: F.array_join(F.transform("v", lambda x: F.concat(F.lit('"'), x[f].cast("string"), F.lit('"'))), ",")
        return v.select("n_regionkey", F.concat(F.lit(title + "\n"), pick("k"), F.lit("\n"), pick("n"), F.lit("\n")).alias(title))

    ages = c.groupBy("n_regionkey", "age").agg(F.count_if(~F.col("man")).alias("w"), F.count_if("man").alias("m"))
    ages = ages.groupBy("n_regionkey").agg(F.array_sort(F.collect_list(F.concat_ws(",", "age", F.col("w").cast("string"), F.col("m").cast("string")))).alias("v"))
    ages = ages.select("n_regionkey", F.concat(F.lit("Age & gender\n,Women,Men\n"), F.array_join("v", "\n"), F.lit("\nend")).alias("ages"))
    files = (listed("n_name", "Top countries").join(listed("c_mktsegment", "Top cities"), "n_regionkey").join(ages, "n_regionkey")
             .select(F.col("n_regionkey").cast("string").alias("path"), F.concat("Top countries", "Top cities", "ages").alias("text")))
    return exports.parse_audience(files)


#: File name and first lines of the landing files that orders stand for, by order key modulo 5.
LANDING_CASES = [
    ("Overview.csv", "Date,Video Views,Profile Views,Likes\n1,2,3,4"),
    ("Feb-01-2026_Feb-07-2026_9.csv", "Post ID,Publish time,Reach\n1,2,3"),
    ("random.csv", "a,b\n1,2"),
    ("notes.txt", "Gender,Distribution\nx,0.5"),
    ("FollowerHistory.csv", "Date,Followers,Difference in followers from previous day\n1,2,3"),
]


def _landing_files(spark, sf_dir):
    case = F.element_at(F.array(*[F.struct(F.lit(n).alias("file_name"), F.lit(h).alias("head")) for n, h in LANDING_CASES]),
                        (F.col("o_orderkey") % 5 + 1).cast("int"))
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("landing/"), F.lpad(F.col("o_orderkey").cast("string"), 12, "0")).alias("path"), case["file_name"].alias("file_name"),
        F.col("o_totalprice").cast("long").alias("length"), F.col("o_orderdate").alias("modificationTime"), case["head"].alias("head"))


def _landing_classes(spark, sf_dir):
    return landing.classify_files(_landing_files(spark, sf_dir), "tiktok").select("path", "target", "score", "status", "ambiguous")


def _landing_checks(spark, sf_dir):
    return landing.validate_batch(_landing_files(spark, sf_dir), "tiktok", max_bytes=300_000).select(
        "path", "correct_name", F.col("error").isNull().alias("ok"), "target_path", "batch_ok")


def _country_shares(spark, sf_dir):
    """Customers per country as display rows: name by code, share in percent, escaped text."""
    c = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    per = c.groupBy("n_name").agg(F.count(F.lit(1)).alias("n"))
    total = per.select(F.sum("n")).scalar()
    return per.select("n_name", greek.country_name(F.upper(F.substring("n_name", 1, 2))).alias("country"),
                      X.distribution_pct(F.col("n") / total).alias("share_pct"),
                      X.safe_text(F.concat(F.lit('<b "'), F.col("n_name"), F.lit('"> & more'))).alias("shown"))


def _tiktok_daily(spark, sf_dir):
    named = X.map_lit({"interactions": "likes", "link_clicks": "comments", "reach": "shares", "views": "views",
                       "follows": "follows", "visits": "visits"})
    s = account_series(spark, sf_dir).withColumn("metric", F.element_at(named, F.col("metric")))
    return account.tiktok_daily(s).select("platform", "date", "likes", "comments", "shares", "interactions",
                                          "views_7d_avg", "follows_7d_avg", "visits_7d_avg")


def _scoring_bundle(p):
    b = scoring.score_content(p)
    a = b["content_type_scores"].select(F.lit("type").alias("kind"), F.col("content_type").alias("name"), "avg_score", "best_score", "count")
    c = b["platform_scores"].select(F.lit("platform").alias("kind"), F.col("platform").alias("name"), "avg_score", "best_score", "count")
    return a.unionByName(c)


QUERIES.update({
    "preamble_series": _preamble_series,
    "audience_sections": _audience_sections,
    "landing_classes": _landing_classes,
    "landing_checks": _landing_checks,
    "country_shares": _country_shares,
    "tiktok_daily": _tiktok_daily,
    "hashtag_rows": _on_posts(text.hashtag_posts, captions=True),
    "scoring_bundle": _on_posts(_scoring_bundle),
})


# ---------------------------------------------------------------------------
# Files on disk: posts written as vendor CSV and scanned back in splits (S1, S3,
# N3), and the post history through two merges
# ---------------------------------------------------------------------------
import uuid  # noqa: E402
from functools import reduce  # noqa: E402

from pulsekit.session import ensure_checkpoint_dir, shuffles_deleted, stored  # noqa: E402
from pulsekit.sources import history as store  # noqa: E402


#: CSV written before it is read back, about.
DELIVERY_BYTES = 3 << 30


def _scratch(spark, name: str) -> str:
    """A new folder among the shared checkpoints."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _csv_export_scan(spark, sf_dir):
    """Every post as a row of quoted CSV, captions with their line breaks, read back as a platform's exports.

    Exports arrive and go in deliveries of about DELIVERY_BYTES: the files of one are deleted when its posts are taken in, so
    that scratch space is bounded by a delivery and not by all captions of all posts.
    """
    titled = captions(spark, sf_dir)
    p = raw_posts(spark, sf_dir) if titled is None else bare_posts(spark, sf_dir)
    length = table(spark, sf_dir, "documents").agg(F.avg(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-int(p.count() * (length + 400)) // DELIVERY_BYTES))
    taken = []
    for i in range(n):
        root = _scratch(spark, "exports")
        some = p if n == 1 else p.where(F.pmod(F.xxhash64("post_id"), F.lit(n)) == i)
        with shuffles_deleted(spark):
            (normalize.render_instagram_export(some if titled is None else titled(some)).write.option("header", True).option("quoteAll", True)
             .option("escape", '"').option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(root))
        u = exports.ingest_platform(spark, root, "instagram")
        if u is not None:
            taken.append(stored(u.select(
                "post_id", "platform", "content_type", F.date_format("published_at", "yyyy-MM-dd HH:mm:ss").alias("published_at"),
                "reach", "views", "likes", "comments", "shares", "saves", "followers_gained",
                "engagement_total", F.round("engagement_rate", 6).alias("engagement_rate"), F.length("title").alias("title_chars"))))
        path = spark._jvm.org.apache.hadoop.fs.Path(root)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    return reduce(lambda a, b: a.unionByName(b), taken)


def _history_store(spark, sf_dir):
    """All posts merged into an empty history, then every fifth with a like more and every tenth in another month; read back."""
    base, start = _scratch(spark, "history"), {p: "1970-01-01" for p in ("instagram", "tiktok", "youtube", "facebook")}
    p = raw_posts(spark, sf_dir)
    store.merge_posts_into_history(spark, base, p, "2026-01-01 00:00:00", start)
    key = F.col("post_id").cast("long")
    later = p.where(key % 5 == 0).withColumns({
        "likes": F.col("likes") + 1, "engagement_total": F.col("engagement_total") + 1,
        "published_at": F.when(key % 10 == 0, F.col("published_at") + F.expr("INTERVAL 40 DAYS")).otherwise(F.col("published_at"))})
    store.merge_posts_into_history(spark, base, later, "2026-02-01 00:00:00", start)
    h = store.read_history(spark, base)
    return h.select("post_id", "platform", F.date_format("published_at", "yyyy-MM-dd HH:mm:ss").alias("published_at"), "likes", "engagement_total",
                    F.round("engagement_rate", 6).alias("engagement_rate"), F.date_format("_ingested_at", "yyyy-MM-dd").alias("ingested"))


QUERIES.update({
    "csv_export_scan": _csv_export_scan,
    "history_store": _history_store,
    "seasonal_forecast": _on_posts(growth.seasonal_forecast),
})
