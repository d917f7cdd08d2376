"""M13–M15 — content fatigue, posting cadence and momentum (per platform).

Order statistics that the reference takes from a sorted frame (the older
half of a content type's posts) are computed without sorting a whole group
in one task: a per-day histogram finds the day holding the split point and
only that day's rows are ranked.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulsekit.functions import exprs as X
from pulsekit.functions.messages import TEXT
from pulsekit.session import cut_lineage

SEVERITY_ORDER = {"high": 0, "medium": 1, "none": 2, "positive": 3}


def _dated_platforms(posts: DataFrame, min_posts: int) -> DataFrame:
    d = posts.where(F.col("published_at").isNotNull())
    ok = d.groupBy("platform").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= min_posts).select("platform")
    return d.join(F.broadcast(ok), "platform", "left_semi")


def mark_first_k(df: DataFrame, keys: list[str], info: DataFrame, k_col: str = "_k",
                 ts: str = "published_at", tie: str = "post_id", hist: DataFrame | None = None) -> DataFrame:
    """Add ``_first`` = row is among the first ``k`` of its group by (ts, tie).

    ``info`` holds one row per group with ``k``.  Day counts -> running
    totals (calendar-bounded) locate the boundary day; only rows of that day
    are ranked, so no task ever sorts a whole (possibly huge) group.
    ``hist`` may give the day counts (keys, _day, _c).
    """
    day = F.to_date(ts)
    if hist is None:
        hist = df.groupBy(*keys, day.alias("_day")).agg(F.count(F.lit(1)).alias("_c"))
    else:
        hist = hist.select(*keys, "_day", "_c")
    wc = Window.partitionBy(*keys).orderBy("_day").rowsBetween(Window.unboundedPreceding, 0)
    hist = hist.withColumn("_cum", F.sum("_c").over(wc)).join(F.broadcast(info.select(*keys, k_col)), keys)
    bd = (hist.where(F.col("_cum") >= F.col(k_col))
          .groupBy(*keys).agg(F.min_by(F.struct("_day", (F.col("_cum") - F.col("_c")).alias("_prev")), "_day").alias("b")))
    bd = bd.select(*keys, F.col("b._day").alias("_bday"), F.col("b._prev").alias("_bprev"))
    j = df.join(F.broadcast(info.select(*keys, k_col)), keys).join(F.broadcast(bd), keys, "left")
    on_bday = F.to_date(ts) == F.col("_bday")
    rest = j.where(~on_bday | F.col("_bday").isNull()).withColumn(
        "_first", (F.col(k_col) > 0) & F.col("_bday").isNotNull() & (F.to_date(ts) < F.col("_bday")))
    w = Window.partitionBy(*keys).orderBy(ts, tie)
    edge = (j.where(on_bday).withColumn("_r", F.row_number().over(w))
            .withColumn("_first", F.col("_r") <= F.col(k_col) - F.col("_bprev")).drop("_r"))
    return rest.unionByName(edge).drop("_bday", "_bprev")


def content_fatigue(posts: DataFrame, min_posts: int = 15, min_type: int = 5) -> DataFrame:
    """Per (platform, content type) with >= 5 posts: weighted OLS slope
    of the rate on days since the type's first post (×30 = monthly change),
    trend/severity labels and older-half vs recent-half means (split n//2)."""
    keys = ["platform", "content_type"]
    dated = posts.where(F.col("published_at").isNotNull()).select(*keys, "post_id", "published_at", "engagement_rate", "weight")
    # counts per day once: platforms, types and split days all follow from them
    hist = cut_lineage(dated.groupBy(*keys, F.to_date("published_at").alias("_day")).agg(F.count(F.lit(1)).alias("_c"), F.min("published_at").alias("_t")))
    ok = hist.groupBy("platform").agg(F.sum("_c").alias("_n")).where(F.col("_n") >= min_posts).select("platform")
    info = (hist.join(F.broadcast(ok), "platform", "left_semi").groupBy(*keys).agg(F.sum("_c").alias("post_count"), F.min("_t").alias("_t0"))
            .where(F.col("post_count") >= min_type)
            .withColumn("_k", F.floor(F.col("post_count") / 2).cast("long")))
    info = cut_lineage(info)
    m = mark_first_k(dated, keys, info, hist=hist)          # only the types of ``info`` stay
    m = m.join(F.broadcast(info.select(*keys, "_t0")), keys)
    x = X.ntz_days(F.col("published_at"), F.col("_t0"))
    y, w = F.col("engagement_rate"), F.col("weight")
    g = m.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("post_count"),
        F.sum(w).alias("sw"), F.sum(w * x).alias("swx"), F.sum(w * y).alias("swy"),
        F.sum(w * x * x).alias("swxx"), F.sum(w * x * y).alias("swxy"),
        F.avg(F.when(F.col("_first"), y)).alias("_older"), F.avg(F.when(~F.col("_first"), y)).alias("_recent"))
    num = F.col("swxy") - F.col("swx") * F.col("swy") / F.col("sw")
    den = F.col("swxx") - F.col("swx") * F.col("swx") / F.col("sw")
    slope = F.when(den == 0, F.lit(0.0)).otherwise(num / den)
    mc = slope * 30
    trend = F.when(mc < -0.01, "declining").when(mc > 0.01, "growing").otherwise("stable")
    sev = (F.when(mc < -0.01, F.when(mc < -0.03, "high").otherwise("medium"))
           .when(mc > 0.01, "positive").otherwise("none"))
    out = g.select(*keys, "post_count", trend.alias("trend"), sev.alias("severity"),
                   F.round(mc * 100, 2).alias("monthly_change_pct"),
                   F.round("_older", 4).alias("older_avg_rate"), F.round("_recent", 4).alias("recent_avg_rate"),
                   F.when(F.col("_older") > 0, F.round((F.col("_recent") / F.col("_older") - 1) * 100, 1))
                   .otherwise(F.lit(0.0)).alias("change_pct"))
    return out.withColumn("severity_rank", F.element_at(X.map_lit(SEVERITY_ORDER), F.col("severity")))


def _utc_weeks(d: DataFrame) -> DataFrame:
    return d.withColumn("week_start", X.week_start_monday(F.col("published_at")))


def posting_cadence(posts: DataFrame, min_posts: int = 15, min_weeks: int = 4) -> DataFrame:
    """M14 table: weeks grouped by their post count (UTC Monday weeks)."""
    d = _utc_weeks(_dated_platforms(posts, min_posts))
    wk = d.groupBy("platform", "week_start").agg(
        F.count("post_id").alias("post_count"), F.avg("engagement_rate").alias("avg_engagement"),
        F.sum("reach").alias("total_reach"), F.sum("engagement_total").alias("total_engagement"))
    ok = wk.groupBy("platform").agg(F.count(F.lit(1)).alias("_w")).where(F.col("_w") >= min_weeks).select("platform")
    wk = wk.join(F.broadcast(ok), "platform", "left_semi")
    return wk.groupBy("platform", F.col("post_count").alias("posts_per_week")).agg(
        F.count(F.lit(1)).alias("weeks_observed"),
        F.round(F.avg("avg_engagement"), 4).alias("avg_engagement_rate"),
        F.avg("total_reach").cast("long").alias("avg_total_reach"),
        F.avg("total_engagement").cast("long").alias("avg_total_engagement"))


def cadence_summary(posts: DataFrame, min_posts: int = 15, min_weeks: int = 4) -> DataFrame:
    """M14 verdict: best weekly count for rate / reach among counts seen in
    >= 2 weeks (else all), current = mean of the last 4 weeks, advice text."""
    cad = posting_cadence(posts, min_posts, min_weeks)
    rel = cad.groupBy("platform").agg(F.max((F.col("weeks_observed") >= 2).cast("int")).alias("_has_rel"))
    c = cad.join(F.broadcast(rel), "platform").where((F.col("_has_rel") == 0) | (F.col("weeks_observed") >= 2))
    best = c.groupBy("platform").agg(
        F.min_by("posts_per_week", F.struct(-F.col("avg_engagement_rate"), F.col("posts_per_week"))).alias("optimal_for_engagement"),
        F.max("avg_engagement_rate").alias("optimal_engagement_rate"),
        F.min_by("posts_per_week", F.struct(-F.col("avg_total_reach"), F.col("posts_per_week"))).alias("optimal_for_reach"),
        F.max("avg_total_reach").alias("optimal_total_reach"))
    d = _utc_weeks(_dated_platforms(posts, min_posts))
    wk = d.groupBy("platform", "week_start").agg(F.count("post_id").alias("n"))
    w = Window.partitionBy("platform").orderBy(F.col("week_start").desc())
    cur = (wk.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= 4)
           .groupBy("platform").agg(F.bround(F.avg("n"), 1).alias("current_cadence")))
    j = best.join(cur, "platform")
    cur0 = F.bround("current_cadence", 0).cast("long")
    diff = F.col("optimal_for_engagement") - F.col("current_cadence")
    rec = (F.when(F.abs(diff) < 0.5, F.format_string(
        TEXT["your_current_pace_week_is"], cur0, F.col("optimal_for_engagement")))
        .when(diff > 0, F.format_string(TEXT["consider_posting_more_week_is"],
                                        F.col("optimal_for_engagement"), cur0))
        .otherwise(F.format_string(
            TEXT["consider_posting_less_week_is"],
            F.col("optimal_for_engagement"), cur0)))
    return j.select("platform", "optimal_for_engagement", "optimal_engagement_rate", "optimal_for_reach",
                    "optimal_total_reach", "current_cadence", rec.alias("recommendation"))


def momentum(posts: DataFrame, min_posts: int = 10) -> DataFrame:
    """0–100 momentum from last-30-day vs previous-30-day engagement,
    reach and quality ratios plus posting consistency of the last 4 weeks."""
    d = _dated_platforms(posts, min_posts)
    now = d.groupBy("platform").agg(F.max("published_at").alias("_now"))
    d = d.join(F.broadcast(now), "platform")
    ts = F.col("published_at")
    last = ts >= F.col("_now") - F.expr("INTERVAL 30 DAYS")
    prev = (ts >= F.col("_now") - F.expr("INTERVAL 60 DAYS")) & (ts < F.col("_now") - F.expr("INTERVAL 30 DAYS"))
    q = F.col("shares") + F.col("saves") + F.col("comments")
    g = d.groupBy("platform").agg(
        F.sum(last.cast("int")).alias("recent_30d_posts"), F.sum(prev.cast("int")).alias("prev_30d_posts"),
        F.avg(F.when(last, F.col("engagement_rate"))).alias("_re"), F.avg(F.when(prev, F.col("engagement_rate"))).alias("_pe"),
        F.avg(F.when(last, F.col("reach"))).alias("_rr"), F.avg(F.when(prev, F.col("reach"))).alias("_pr"),
        F.avg(F.when(last, q)).alias("_rq"), F.avg(F.when(prev, q)).alias("_pq"))
    wk = _utc_weeks(d).groupBy("platform", "week_start").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("platform").orderBy(F.col("week_start").desc())
    cons = (wk.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= 4)
            .groupBy("platform").agg(F.count(F.lit(1)).alias("_nw"), F.stddev_samp("n").alias("_sd"),
                                     F.avg("n").alias("_m"), F.min("n").alias("_min")))
    allw = wk.groupBy("platform").agg(F.count(F.lit(1)).alias("_weeks"))
    j = g.join(cons, "platform").join(allw, "platform")
    both = (F.col("recent_30d_posts") >= 3) & (F.col("prev_30d_posts") >= 3)

    def ratio_score(r, p):
        ratio = F.when(F.col(p) > 0, F.col(r) / F.col(p)).otherwise(F.lit(1.0))
        return F.when(both, F.least(F.lit(25.0), F.greatest(F.lit(0.0), (ratio - 0.5) * 50))).otherwise(F.lit(12.5))
    consistency = F.lit(1.0) - F.when(F.col("_m") > 0, F.col("_sd") / F.col("_m")).otherwise(F.lit(1.0))
    cs = F.greatest(F.lit(0.0), F.least(F.lit(25.0), consistency * 25))
    cs = F.when(F.col("_min") > 0, F.least(F.lit(25.0), cs + 5)).otherwise(cs)
    cs = F.when(F.col("_weeks") >= 4, cs).otherwise(F.lit(10.0))
    j = j.select("platform", "recent_30d_posts", "prev_30d_posts", "_re", "_pe",
                 ratio_score("_re", "_pe").alias("e"), cs.alias("c"),
                 ratio_score("_rr", "_pr").alias("r"), ratio_score("_rq", "_pq").alias("qs"))
    total = F.bround(F.col("e") + F.col("c") + F.col("r") + F.col("qs"), 1)
    verdict = (F.when(total >= 75, TEXT["strong_momentum_your_content_strategy"])
               .when(total >= 55, TEXT["good_momentum_steady_growth_look"])
               .when(total >= 35, TEXT["moderate_momentum_stable_but_not"])
               .when(total >= 20, TEXT["low_momentum_engagement_or_reach"])
               .otherwise(TEXT["warning_multiple_signals_declining_review"]))
    return j.select("platform", total.alias("total_score"), verdict.alias("verdict"),
                    F.bround("e", 1).alias("engagement_trend"), F.bround("c", 1).alias("posting_consistency"),
                    F.bround("r", 1).alias("reach_growth"), F.bround("qs", 1).alias("content_quality"),
                    "recent_30d_posts", "prev_30d_posts",
                    F.coalesce(F.round("_re", 4), F.lit(0.0)).alias("recent_avg_engagement"),
                    F.coalesce(F.round("_pe", 4), F.lit(0.0)).alias("prev_avg_engagement"))
