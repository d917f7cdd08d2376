"""C1–C14 — the KPI engine: platform overview, content performance,
engagement composition and cross-platform tables.

All grouped work is one partial+final HashAggregate per grain; windows only
ever run over already-aggregated (tiny) results, never over raw posts keyed
by the ≤4-valued ``platform`` column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulsekit.functions import exprs as X
from pulsekit.functions.order_stats import percentiles

LONG_MAX = 9223372036854775807


def scalar_max_ts(posts: DataFrame, col: str = "published_at"):
    return posts.select(F.max(col)).scalar()


def top_post_key():
    """min_by key = engagement desc, newest first (nulls last), post_id asc."""
    return F.struct((-F.col("engagement_total")).alias("e"),
                    F.coalesce(-X.epoch_micros(F.col("published_at")), F.lit(LONG_MAX)).alias("t"),
                    F.col("post_id").alias("p"))


def period_flags(posts: DataFrame):
    """trailing 7-day windows anchored at the data's max timestamp."""
    now = scalar_max_ts(posts)
    ts = F.col("published_at")
    this_week = ts >= now - F.expr("INTERVAL 7 DAYS")
    last_week = (ts >= now - F.expr("INTERVAL 14 DAYS")) & (ts < now - F.expr("INTERVAL 7 DAYS"))
    return this_week, last_week


def platform_overview(posts: DataFrame) -> DataFrame:
    """C1 (with C2 weighted mean, C3 week-over-week, C4 top post, F3 periods)."""
    tw, lw = period_flags(posts)

    def s_if(cond, c):
        return F.sum(F.when(cond, F.col(c)).otherwise(F.lit(0)))

    agg = posts.groupBy("platform").agg(
        F.count(F.lit(1)).alias("total_posts"),
        F.sum(F.when(tw, 1).otherwise(0)).cast("long").alias("posts_this_week"),
        F.sum("reach").alias("total_reach"),
        F.sum("engagement_total").alias("total_engagement"),
        X.wavg("engagement_rate").alias("_wr"),
        F.sum("followers_gained").alias("total_followers_gained"),
        s_if(tw, "reach").alias("_reach_tw"), s_if(lw, "reach").alias("_reach_lw"),
        s_if(tw, "engagement_total").alias("_eng_tw"), s_if(lw, "engagement_total").alias("_eng_lw"),
        F.min_by(F.struct("post_id", "engagement_total", "reach", "content_type"), top_post_key()).alias("_top"),
    )
    med = percentiles(posts, ["platform"], {"_median": ("engagement_rate", 0.5)}).withColumnRenamed("platform", "_p")
    agg = agg.join(med, F.col("platform").eqNullSafe(F.col("_p")), "left")
    bench = X.benchmark(F.col("platform"))
    return agg.select(
        "platform", "total_posts", "posts_this_week", "total_reach", "total_engagement",
        F.round("_wr", 4).alias("avg_engagement_rate"),
        F.round("_median", 4).alias("median_engagement_rate"),
        bench.alias("benchmark_engagement"),
        F.round(F.col("_wr") - bench, 4).alias("vs_benchmark"),
        "total_followers_gained",
        X.wow_change(F.col("_reach_tw"), F.col("_reach_lw")).alias("wow_reach_change"),
        X.wow_change(F.col("_eng_tw"), F.col("_eng_lw")).alias("wow_engagement_change"),
        F.col("_top.post_id").alias("top_post_id"),
        F.col("_top.engagement_total").alias("top_post_engagement"),
        F.col("_top.reach").alias("top_post_reach"),
        F.col("_top.content_type").alias("top_post_type"),
    )


def top_post_per_platform(posts: DataFrame) -> DataFrame:
    """C4 on its own: the platform's most engaging post (first on ties)."""
    return (posts.groupBy("platform")
            .agg(F.min_by(F.struct("post_id", "engagement_total", "reach", "content_type",
                                   "published_at", "permalink"), top_post_key()).alias("t"))
            .select("platform", F.col("t.post_id").alias("post_id"),
                    F.col("t.engagement_total").alias("engagement"),
                    F.col("t.reach").alias("reach"), F.col("t.content_type").alias("content_type"),
                    F.date_format("t.published_at", "yyyy-MM-dd HH:mm:ss").alias("published_at"),
                    F.col("t.permalink").alias("permalink")))


def wow_change(posts: DataFrame) -> DataFrame:
    """C3/F3 over all platforms together and per platform, in one pass
    (GROUPING SETS -> one Expand + HashAggregate)."""
    tw, lw = period_flags(posts)
    p = posts.select(
        "platform",
        F.when(tw, F.col("reach")).otherwise(0).alias("r_tw"), F.when(lw, F.col("reach")).otherwise(0).alias("r_lw"),
        F.when(tw, F.col("engagement_total")).otherwise(0).alias("e_tw"),
        F.when(lw, F.col("engagement_total")).otherwise(0).alias("e_lw"),
        F.when(tw, 1).otherwise(0).alias("n_tw"), F.when(lw, 1).otherwise(0).alias("n_lw"))
    g = p.rollup("platform").agg(
        F.grouping("platform").alias("_g"),
        F.sum("r_tw").alias("reach_this_week"), F.sum("r_lw").alias("reach_last_week"),
        F.sum("e_tw").alias("engagement_this_week"), F.sum("e_lw").alias("engagement_last_week"),
        F.sum("n_tw").cast("long").alias("posts_this_week"), F.sum("n_lw").cast("long").alias("posts_last_week"))
    return g.select(
        F.when(F.col("_g") == 1, F.lit("ALL")).otherwise(F.col("platform")).alias("scope"),
        "reach_this_week", "reach_last_week", "engagement_this_week", "engagement_last_week",
        "posts_this_week", "posts_last_week",
        X.wow_change(F.col("reach_this_week"), F.col("reach_last_week")).alias("wow_reach_change"),
        X.wow_change(F.col("engagement_this_week"), F.col("engagement_last_week")).alias("wow_engagement_change"))


def content_performance(posts: DataFrame, min_posts: int = X.MIN_POSTS) -> DataFrame:
    """Per content type (>= min_posts) weighted means + ranking."""
    g = (posts.groupBy("content_type")
         .agg(F.count(F.lit(1)).alias("count"),
              X.trunc_long(X.wavg("reach")).alias("avg_reach"),
              X.trunc_long(X.wavg("engagement_total")).alias("avg_engagement"),
              F.round(X.wavg("engagement_rate"), 4).alias("avg_engagement_rate"),
              X.trunc_long(X.wavg("likes")).alias("avg_likes"),
              X.trunc_long(X.wavg("comments")).alias("avg_comments"),
              X.trunc_long(X.wavg("shares")).alias("avg_shares"),
              X.trunc_long(X.wavg("saves")).alias("avg_saves"),
              F.sum("reach").alias("total_reach"),
              F.array_join(F.array_sort(F.collect_set("platform")), ",").alias("platforms"))
         .where(F.col("count") >= min_posts))
    w = Window.orderBy(F.col("avg_engagement_rate").desc(), F.col("content_type"))
    return g.withColumn("rank", F.row_number().over(w))


def platform_content_ranking(posts: DataFrame, min_posts: int = max(2, X.MIN_POSTS // 2)) -> DataFrame:
    """Per platform, content types with >= 2 posts ranked by weighted rate."""
    g = (posts.groupBy("platform", "content_type")
         .agg(F.round(X.wavg("engagement_rate"), 4).alias("engagement_rate"),
              F.count(F.lit(1)).alias("count"),
              X.trunc_long(X.wavg("engagement_total")).alias("avg_engagement"))
         .where(F.col("count") >= min_posts))
    w = Window.partitionBy("platform").orderBy(F.col("engagement_rate").desc(), F.col("content_type"))
    return g.withColumn("rank", F.row_number().over(w))


def engagement_composition(posts: DataFrame) -> DataFrame:
    """Global totals, shares of the grand total, quality score, ratios."""
    t = posts.agg(F.sum("likes").alias("likes"), F.sum("comments").alias("comments"),
                  F.sum("shares").alias("shares"), F.sum("saves").alias("saves"),
                  F.sum("reach").alias("_reach"))
    gt = F.col("likes") + F.col("comments") + F.col("shares") + F.col("saves")
    gt1 = F.when(gt != 0, gt).otherwise(F.lit(1))
    q = sum(F.col(k) * w for k, w in X.QUALITY_WEIGHTS.items())
    return t.select(
        "likes", "comments", "shares", "saves",
        F.round(F.col("likes") / gt1, 4).alias("likes_share"),
        F.round(F.col("comments") / gt1, 4).alias("comments_share"),
        F.round(F.col("shares") / gt1, 4).alias("shares_share"),
        F.round(F.col("saves") / gt1, 4).alias("saves_share"),
        F.round(q / F.when(F.col("_reach") != 0, F.col("_reach")).otherwise(F.lit(1)), 6).alias("quality_score"),
        F.round(F.col("comments") / F.when(F.col("likes") != 0, F.col("likes")).otherwise(F.lit(1)), 4).alias("conversation_ratio"),
        F.round(F.col("shares") / gt1, 4).alias("virality_ratio"))


def engagement_mix_platform(posts: DataFrame) -> DataFrame:
    """The four interaction shares per platform."""
    g = posts.groupBy("platform").agg(
        *[F.sum(c).alias(c) for c in ("likes", "comments", "shares", "saves", "engagement_total")])
    den = F.when(F.col("engagement_total") != 0, F.col("engagement_total")).otherwise(F.lit(1))
    return g.select("platform", *[F.round(F.col(c) / den, 4).alias(f"{c}_pct")
                                  for c in ("likes", "comments", "shares", "saves")])


def _n_platforms(posts: DataFrame):
    return posts.select(F.count_distinct("platform")).scalar()


def cross_platform_averages(posts: DataFrame) -> DataFrame:
    """Per-platform weighted averages + dominant type (mode, lowest on
    ties); only when the data has >= 2 platforms."""
    g = posts.groupBy("platform").agg(
        X.trunc_long(X.wavg("reach")).alias("avg_reach"),
        F.round(X.wavg("engagement_rate"), 4).alias("avg_engagement_rate"),
        X.trunc_long(X.wavg("likes")).alias("avg_likes"),
        X.trunc_long(X.wavg("comments")).alias("avg_comments"),
        X.trunc_long(X.wavg("shares")).alias("avg_shares"),
        F.mode("content_type", deterministic=True).alias("dominant_content_type"))
    return g.where(_n_platforms(posts) >= 2)


def content_platform_fit(posts: DataFrame, min_posts: int = X.MIN_POSTS) -> DataFrame:
    """Per content type (>= 5 posts) the platforms with >= 2 posts, when
    at least two qualify; best platform by rounded weighted rate."""
    per = (posts.groupBy("content_type", "platform")
           .agg(F.count(F.lit(1)).alias("count"),
                F.round(X.wavg("engagement_rate"), 4).alias("avg_engagement_rate"),
                X.trunc_long(X.wavg("reach")).alias("avg_reach")))
    type_n = per.groupBy("content_type").agg(F.sum("count").alias("_type_posts"))
    ok = per.where(F.col("count") >= 2)
    w = Window.partitionBy("content_type")
    best = F.min_by("platform", F.struct(-F.col("avg_engagement_rate"), F.col("platform"))).over(w)
    return (ok.join(type_n, "content_type")
            .where(F.col("_type_posts") >= min_posts)
            .withColumn("n_platforms", F.count(F.lit(1)).over(w))
            .where(F.col("n_platforms") >= 2)
            .withColumn("best_platform", best)
            .withColumn("best_rate", F.max("avg_engagement_rate").over(w))
            .drop("_type_posts"))


def meta(posts: DataFrame) -> DataFrame:
    """C11: row count, platform set, first/last timestamp."""
    return posts.agg(
        F.count(F.lit(1)).alias("total_posts"),
        F.count_distinct("platform").alias("n_platforms"),
        F.array_join(F.array_sort(F.collect_set("platform")), ",").alias("platforms"),
        F.date_format(F.min("published_at"), "yyyy-MM-dd HH:mm:ss").alias("earliest"),
        F.date_format(F.max("published_at"), "yyyy-MM-dd HH:mm:ss").alias("latest"))


def content_unweighted(posts: DataFrame) -> DataFrame:
    """Unweighted mean rate and count per (platform, content type)."""
    return (posts.groupBy("platform", "content_type")
            .agg(F.round(F.avg("engagement_rate"), 4).alias("mean_engagement_rate"),
                 F.count(F.lit(1)).alias("count")))


def mix_unpivot(posts: DataFrame) -> DataFrame:
    """Per-platform interaction totals in long form, zero metrics dropped."""
    g = posts.groupBy("platform").agg(*[F.sum(c).alias(c) for c in ("likes", "comments", "shares", "saves")])
    return (g.unpivot("platform", ["likes", "comments", "shares", "saves"], "metric", "total")
            .where(F.col("total") > 0))


def cross_platform_table(overview: DataFrame) -> DataFrame:
    """C14: comparison table selected from the platform overview."""
    return overview.select("platform", "total_posts", "total_reach", "total_engagement",
                           "avg_engagement_rate", "vs_benchmark", "total_followers_gained")
