"""T1–T9 — when to post: hour/day profiles, heatmap, weekly schedule,
slots to avoid, next best time.

Grouping is by (scope, day, hour) — at most 7×24 groups per scope — so the
partial aggregation collapses posts map-side before any shuffle; ranking
windows then run over those few rows only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulsekit.functions import exprs as X



def _day_ix(c):
    return F.element_at(X.map_lit({d: i for i, d in enumerate(X.DAY_NAMES)}), c)


def timed_platforms(posts: DataFrame) -> DataFrame:
    """platforms that carry a time of day (more than one distinct hour)."""
    return (posts.where(F.col("published_at").isNotNull())
            .groupBy("platform").agg(F.count_distinct("hour").alias("_nh"))
            .where(F.col("_nh") > 1).select("platform"))


def valid_timed(posts: DataFrame) -> DataFrame:
    """Dated posts of platforms with real posting times (F7 + J6 semi join).

    The right side is one row per platform (a bounded dimension), so it is
    broadcast and the semi join never shuffles the posts.
    """
    return (posts.where(F.col("published_at").isNotNull())
            .join(F.broadcast(timed_platforms(posts)), "platform", "left_semi"))


def _profile(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(
        F.round(X.wavg("engagement_rate"), 4).alias("avg_engagement"),
        F.round(X.wavg("reach"), 4).alias("avg_reach"),
        F.count(F.lit(1)).cast("double").alias("post_count"))


def hourly_profile(posts: DataFrame) -> DataFrame:
    """Weighted rate / reach and count per KST hour, ranked (top 3 = best hours)."""
    g = _profile(valid_timed(posts), "hour")
    return g.withColumn("rank", F.row_number().over(Window.orderBy(F.col("avg_engagement").desc(), "hour")))


def daily_profile(posts: DataFrame) -> DataFrame:
    """The same per KST weekday (Monday..Sunday order breaks ties)."""
    g = _profile(valid_timed(posts), "day_of_week").withColumn("day_ix", _day_ix(F.col("day_of_week")))
    return g.withColumn("rank", F.row_number().over(Window.orderBy(F.col("avg_engagement").desc(), "day_ix")))


def best_times_platform(posts: DataFrame, min_posts: int = X.MIN_POSTS,
                        n_hours: int = 3, n_days: int = 2) -> DataFrame:
    """Per platform (>= 5 timed posts) the best 3 hours and 2 days."""
    v = valid_timed(posts)
    big = v.groupBy("platform").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= min_posts).select("platform")
    v = v.join(F.broadcast(big), "platform", "left_semi")
    h = (v.groupBy("platform", "hour").agg(X.wavg("engagement_rate").alias("score"))
         .select("platform", F.lit("hour").alias("kind"), F.col("hour").cast("string").alias("slot"), "score",
                 F.lpad(F.col("hour").cast("string"), 2, "0").alias("_tie")))
    d = (v.groupBy("platform", "day_of_week").agg(X.wavg("engagement_rate").alias("score"))
         .select("platform", F.lit("day").alias("kind"), F.col("day_of_week").alias("slot"), "score",
                 F.col("day_of_week").alias("_tie")))
    both = h.unionByName(d)
    w = Window.partitionBy("platform", "kind").orderBy(F.col("score").desc(), "_tie")
    r = both.withColumn("rank", F.row_number().over(w))
    return (r.where(((F.col("kind") == "hour") & (F.col("rank") <= n_hours))
                    | ((F.col("kind") == "day") & (F.col("rank") <= n_days)))
            .select("platform", "kind", "slot", "rank", F.round("score", 6).alias("score")))


def heatmap_pivot(posts: DataFrame) -> DataFrame:
    """T4: day × hour pivot of the weighted rate (null where no posts)."""
    cell = (valid_timed(posts).groupBy("day_of_week", "hour")
            .agg(F.round(X.wavg("engagement_rate"), 4).alias("r")))
    p = cell.groupBy("day_of_week").pivot("hour", list(range(24))).agg(F.first("r"))
    return p.select("day_of_week", *[F.col(str(h)).alias(f"h{h:02d}") for h in range(24)])


# ---------------------------------------------------------------------------
# The posting-time model
# ---------------------------------------------------------------------------
def _scoped(posts: DataFrame, min_posts: int) -> DataFrame:
    """Dated posts tagged with every scope they belong to ('ALL' and their
    platform), restricted to scopes with >= min_posts posts."""
    d = posts.where(F.col("published_at").isNotNull())
    s = d.withColumn("scope", F.explode(F.array(F.lit("ALL"), F.col("platform"))))
    ok = s.groupBy("scope").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= min_posts).select("scope")
    return s.join(F.broadcast(ok), "scope", "left_semi")


def _slot_scores(posts: DataFrame, min_posts: int = 10) -> DataFrame:
    """Per (scope, day, hour) with >= 2 posts: the confidence-weighted score
    c·local + (1−c)·global, c = min(n/20, 1); global = weighted mean rate
    over all dated posts of all platforms."""
    dated = posts.where(F.col("published_at").isNotNull())
    gmean = dated.select(F.sum(F.col("engagement_rate") * F.col("weight")) / F.sum("weight")).scalar()
    s = _scoped(posts, min_posts)
    g = (s.groupBy("scope", "dow", "day_of_week", "hour")
         .agg(F.count(F.lit(1)).alias("sample_size"),
              (F.sum(F.col("engagement_rate") * F.col("weight")) / F.sum("weight")).alias("_local")))
    c = F.least(F.col("sample_size") / 20.0, F.lit(1.0))
    return (g.where(F.col("sample_size") >= 2)
            .withColumn("_score", c * F.col("_local") + (F.lit(1.0) - c) * gmean))


def weekly_schedule(posts: DataFrame, min_posts: int = 10, top_k: int = 3) -> DataFrame:
    """Top 3 hours per (scope, day) by confidence-weighted score."""
    g = _slot_scores(posts, min_posts)
    w = Window.partitionBy("scope", "dow").orderBy(F.col("_score").desc(), "hour")
    return (g.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top_k)
            .select("scope", F.col("day_of_week").alias("day"), "dow", "rank", "hour",
                    F.format_string("%02d:00", F.col("hour")).alias("time"),
                    F.round("_score", 4).alias("score"), "sample_size"))


def schedule_days(posts: DataFrame, min_posts: int = 10) -> DataFrame:
    """T5 day level: for every scope and weekday, whether to post, the day's
    mean rate and count, confidence, and how many slots qualified."""
    s = _scoped(posts, min_posts)
    days = (s.groupBy("scope", "dow", "day_of_week")
            .agg(F.round(F.avg("engagement_rate"), 4).alias("avg_engagement"),
                 F.count(F.lit(1)).alias("post_count")))
    slots = (_slot_scores(posts, min_posts).groupBy("scope", "dow")
             .agg(F.least(F.count(F.lit(1)), F.lit(3)).alias("n_best_hours")))
    scopes = s.select("scope").distinct()
    spine = scopes.withColumn("dow", F.explode(F.sequence(F.lit(0), F.lit(6))))
    out = (spine.join(days, ["scope", "dow"], "left").join(slots, ["scope", "dow"], "left"))
    n = F.col("post_count")
    return out.select(
        "scope", F.element_at(F.array(*[F.lit(d) for d in X.DAY_NAMES]), F.col("dow") + 1).alias("day"), "dow",
        n.isNotNull().alias("recommend_posting"),
        "avg_engagement", F.coalesce(n, F.lit(0)).alias("post_count"),
        F.when(n.isNull(), F.lit(None)).when(F.col("n_best_hours").isNull(), F.lit("low"))
         .when(n >= 10, "high").when(n >= 5, "medium").otherwise("low").alias("confidence"),
        F.coalesce("n_best_hours", F.lit(0)).alias("n_best_hours"))


def top5_slots(posts: DataFrame, min_posts: int = 10, n: int = 5) -> DataFrame:
    """Best n slots per scope over the per-day top 3 (day order, then
    in-day rank, break ties on the rounded score)."""
    sch = weekly_schedule(posts, min_posts)
    w = Window.partitionBy("scope").orderBy(F.col("score").desc(), "dow", F.col("rank"))
    return (sch.withColumn("slot_rank", F.row_number().over(w)).where(F.col("slot_rank") <= n)
            .select("scope", "slot_rank", "day", "dow", "hour", "time", "score"))


def avoid_slots(posts: DataFrame, min_posts: int = 10, n: int = 5) -> DataFrame:
    """Slots with >= 3 posts whose mean rate is below half the scope mean;
    the n lowest per scope."""
    s = _scoped(posts, min_posts)
    smean = s.groupBy("scope").agg(F.avg("engagement_rate").alias("_m"))
    g = (s.groupBy("scope", "dow", "day_of_week", "hour")
         .agg(F.count(F.lit(1)).alias("_n"), F.avg("engagement_rate").alias("_r"))
         .where(F.col("_n") >= 3)
         .join(F.broadcast(smean), "scope")
         .where(F.col("_r") < F.col("_m") * 0.5)
         .withColumn("avg_engagement_rate", F.round("_r", 4)))
    w = Window.partitionBy("scope").orderBy("avg_engagement_rate", "dow", "hour")
    return (g.withColumn("slot_rank", F.row_number().over(w)).where(F.col("slot_rank") <= n)
            .select("scope", "slot_rank", F.col("day_of_week").alias("day"), "hour",
                    F.format_string("%02d:00", F.col("hour")).alias("time"), "avg_engagement_rate"))


def next_best_time(posts: DataFrame, min_posts: int = 10, now_tz: str = "UTC") -> DataFrame:
    """The first top-5 slot on or after "now" (= max timestamp).

    ``now_tz='UTC'`` reproduces the reference, which reads the weekday and
    hour of "now" in UTC while slots are KST; ``'KST'`` compares in KST.
    Same-day slots must be later than the current hour; fallback: best slot.
    """
    now = posts.select(F.max("published_at")).scalar()
    now_l = X.kst(now) if now_tz.upper() == "KST" else now
    now_dow, now_hour = X.dow_index(now_l), F.hour(now_l)
    t5 = top5_slots(posts, min_posts)
    ahead = F.pmod(F.col("dow") - now_dow, F.lit(7))
    cand = (t5.withColumn("days_from_now", ahead.cast("int"))
            .withColumn("_ok", ~((F.col("days_from_now") == 0) & (F.col("hour") <= now_hour))))
    w = Window.partitionBy("scope").orderBy(F.col("_ok").desc(), F.when(F.col("_ok"), F.col("days_from_now")),
                                            F.col("slot_rank"))
    picked = cand.withColumn("_r", F.row_number().over(w)).where(F.col("_r") == 1)
    return picked.select("scope", "day", "time", "score",
                         F.when(F.col("_ok"), F.col("days_from_now")).alias("days_from_now"))
