"""A1–A9, J2, J3, F5, F6 — account-level daily analytics.

Input is the long series ``(platform, metric, date, value)``.  Work is keyed
by account (``platform``) and calendar day, so every shuffle is bounded by
accounts × days; windows are partitioned by account.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulsekit.functions import exprs as X

DAILY_METRICS = ["follows", "interactions", "link_clicks", "views", "visits", "reach"]
ROLLING = ["follows", "reach", "views", "interactions", "visits"]
DATA_COLS = ["reach", "views", "follows", "interactions", "visits", "follower_count"]


def date_spine(keys: DataFrame, key: str = "platform", lo: str = "_lo", hi: str = "_hi") -> DataFrame:
    """J2 helper: one row per (key, day) between lo and hi inclusive."""
    return keys.select(key, F.explode(F.sequence(F.col(lo), F.col(hi), F.expr("INTERVAL 1 DAY"))).alias("date"))


def daily_dense(series: DataFrame, metrics: list[str] = DAILY_METRICS) -> DataFrame:
    """A1 + J2: pivot the long series to one column per metric (fixed list,
    so the pivot needs no extra distinct job) and densify the calendar from
    the first to the last day of each account, missing days -> 0."""
    wide = series.groupBy("platform", "date").pivot("metric", metrics).agg(F.sum("value"))
    span = series.groupBy("platform").agg(F.min("date").alias("_lo"), F.max("date").alias("_hi"))
    spine = date_spine(span)
    out = spine.join(wide, ["platform", "date"], "left")
    return out.select("platform", "date", *[F.coalesce(F.col(m), F.lit(0)).cast("long").alias(m) for m in metrics])


def with_follower_count(daily: DataFrame) -> DataFrame:
    """Running follower total from daily follows (the follower-history export)."""
    w = Window.partitionBy("platform").orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    return daily.withColumn("follower_count", F.sum("follows").over(w))


def with_rate(daily: DataFrame) -> DataFrame:
    """A2: interactions / reach (4 dp), 0 when reach <= 0."""
    return daily.withColumn("engagement_rate_daily", F.when(F.col("reach") > 0, F.round(
        F.col("interactions") / F.col("reach"), 4)).otherwise(F.lit(0.0)))


def with_rolling(daily: DataFrame, cols: list[str] = ROLLING) -> DataFrame:
    """A3: 7-row trailing mean (min 1 row), half-even to 1 dp, per account."""
    w = Window.partitionBy("platform").orderBy("date").rowsBetween(-6, 0)
    out = daily
    for c in cols:
        if c in daily.columns:
            out = out.withColumn(f"{c}_7d_avg", F.bround(F.avg(c).over(w), 1))
    return out


def with_week_columns(daily: DataFrame) -> DataFrame:
    """A4: ISO week number and ``%Y-W%U`` key of the day."""
    ts = F.col("date").cast("timestamp_ntz")
    return daily.withColumn("week", X.iso_week(ts)).withColumn("year_week", X.year_week_sunday(ts))


def account_daily(series: DataFrame) -> DataFrame:
    """The full account daily table (A1–A4 + follower count)."""
    return with_week_columns(with_rolling(with_rate(with_follower_count(daily_dense(series)))))


def clip_90d(daily: DataFrame, days: int = 90) -> DataFrame:
    """rows within ``days`` of each account's last day."""
    last = daily.groupBy("platform").agg(F.max("date").alias("_last"))
    return (daily.join(last, "platform")
            .where(F.col("date") >= F.date_sub("_last", days)).drop("_last"))


def trim_nonzero(daily: DataFrame, cols: list[str] = DATA_COLS) -> DataFrame:
    """keep each account's days between the first and last day on which
    any data column with a positive total is non-zero."""
    cols = [c for c in cols if c in daily.columns]
    sums = daily.groupBy("platform").agg(*[F.sum(c).alias(f"_s_{c}") for c in cols])
    d = daily.join(sums, "platform")
    any_nz = F.lit(False)
    for c in cols:
        any_nz = any_nz | ((F.col(f"_s_{c}") > 0) & (F.col(c) != 0))
    d = d.withColumn("_nz", any_nz)
    b = d.groupBy("platform").agg(F.min(F.when(F.col("_nz"), F.col("date"))).alias("_a"),
                                  F.max(F.when(F.col("_nz"), F.col("date"))).alias("_b"))
    return (d.join(b, "platform")
            .where(F.col("_a").isNull() | F.col("date").between(F.col("_a"), F.col("_b")))
            .drop("_a", "_b", "_nz", *[f"_s_{c}" for c in cols]))


def account_kpis(daily: DataFrame, window_days: int | None = None) -> DataFrame:
    """Per account the sum of each metric and the last non-zero
    follower count.  ``window_days=None`` sums the whole table (the
    reference's behaviour despite its 'last 90 days' label)."""
    d = clip_90d(daily, window_days) if window_days else daily
    sums = [F.sum(c).alias(f"total_{c}") for c in ["reach", "views", "follows", "interactions", "visits", "link_clicks"]
            if c in daily.columns]
    return d.groupBy("platform").agg(
        *sums,
        F.max_by(F.when(F.col("follower_count") > 0, F.col("follower_count")),
                 F.when(F.col("follower_count") > 0, F.col("date"))).alias("follower_count"),
        F.count(F.lit(1)).alias("days"))


def account_tables(series: DataFrame) -> dict[str, DataFrame]:
    """The account tables of all platforms that ``series`` (platform, metric, date, value) holds: the full daily table, its last
    90 days without empty ends, the KPIs, and the TikTok table."""
    daily = account_daily(series)
    return {"account_daily": daily, "account_recent": clip_90d(trim_nonzero(daily)), "account_kpis": account_kpis(daily), "tiktok_account": tiktok_daily(series)}


def followers_fallback(posts: DataFrame, daily: DataFrame) -> DataFrame:
    """Post-level followers gained per platform, else the daily follows
    total when the post-level sum is 0."""
    p = posts.groupBy("platform").agg(F.sum("followers_gained").alias("post_followers"))
    d = daily.groupBy("platform").agg(F.sum("follows").alias("daily_follows"))
    j = p.join(d, "platform", "full_outer")
    return j.select("platform",
                    F.when(F.coalesce("post_followers", F.lit(0)) > 0, F.col("post_followers"))
                    .when(F.col("daily_follows").isNotNull(), F.col("daily_follows"))
                    .otherwise(F.coalesce("post_followers", F.lit(0))).alias("followers_gained"),
                    F.when(F.coalesce("post_followers", F.lit(0)) > 0, "posts")
                    .when(F.col("daily_follows").isNotNull(), "account_daily").otherwise("posts").alias("source"))


def combine_first(daily: DataFrame, priority: list[str], cols: list[str] | None = None) -> DataFrame:
    """One row per date across accounts; each column takes the first
    non-null value in ``priority`` order (full-outer coalesce).  Expressed as
    one group-by on date with ``min_by(value, rank)`` over non-null values,
    which is a full outer join of any number of accounts in one shuffle."""
    cols = cols or [c for c in daily.columns if c not in ("platform", "date")]
    rank = F.array_position(F.array(*[F.lit(p) for p in priority]), F.col("platform"))
    d = daily.withColumn("_rk", F.when(rank > 0, rank).otherwise(F.lit(len(priority) + 1)))
    return d.groupBy("date").agg(*[F.min_by(F.col(c), F.when(F.col(c).isNotNull(), F.col("_rk"))).alias(c)
                                   for c in cols])


def hourly_activity(events: DataFrame) -> DataFrame:
    """Active users per (account, day, hour) -> mean per hour (half-even,
    0 dp); ``peak_rank`` 1..3 marks the top-3 hours (earlier hour on ties);
    hours whose mean rounds to 0 are dropped from the active-hours map."""
    acct = F.when(F.floor(F.col("user_id") / 7).cast("long") % 2 == 0, "instagram").otherwise("tiktok")
    per = (events.groupBy(acct.alias("platform"), F.to_date("ts").alias("date"), F.hour("ts").alias("hour"))
           .agg(F.count_distinct("user_id").alias("active")))
    h = per.groupBy("platform", "hour").agg(F.bround(F.avg("active"), 0).cast("long").alias("avg_active"))
    w = Window.partitionBy("platform").orderBy(F.col("avg_active").desc(), "hour")
    r = h.withColumn("_r", F.row_number().over(w))
    return (r.select("platform", "hour", "avg_active",
                     F.when(F.col("_r") <= 3, F.col("_r")).alias("peak_rank"))
            .where((F.col("avg_active") > 0) | F.col("peak_rank").isNotNull()))


TIKTOK_METRICS = ["views", "visits", "likes", "comments", "shares", "total_viewers", "new_viewers",
                  "returning_viewers", "follower_count", "follows"]


def tiktok_daily(series: DataFrame) -> DataFrame:
    """A5: the TikTok-style account table from its per-file series
    (overview, viewers, follower history): pivot the metrics present, derive
    interactions = likes + comments + shares only when all three series
    exist for the account, densify the calendar, 7-day means of views,
    follows, interactions and visits."""
    present = (series.groupBy("platform")
               .agg(F.collect_set("metric").alias("_m"))
               .select("platform", (F.array_contains("_m", "likes") & F.array_contains("_m", "comments")
                                    & F.array_contains("_m", "shares")).alias("_has_inter")))
    d = daily_dense(series, TIKTOK_METRICS).join(present, "platform")
    d = d.withColumn("interactions", F.when(F.col("_has_inter"), F.col("likes") + F.col("comments") + F.col("shares"))
                     ).drop("_has_inter")
    w = Window.partitionBy("platform").orderBy("date").rowsBetween(-6, 0)
    for c in ["views", "follows", "interactions", "visits"]:
        d = d.withColumn(f"{c}_7d_avg", F.bround(F.avg(c).over(w), 1))
    return d
