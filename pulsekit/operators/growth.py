"""G1–G12 — weekly roll-ups, growth rates, trend labels and the statistical
forecast.

Posts are reduced to one row per (scope, week) first (partial aggregation,
so skew in any platform is absorbed map-side); all windows and regressions
then run over those calendar-bounded rows.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulsekit.functions import exprs as X


def _dated(posts: DataFrame) -> DataFrame:
    return posts.where(F.col("published_at").isNotNull() & (F.col("year_week") != "Unknown"))


def weekly_rollup(posts: DataFrame) -> DataFrame:
    """G1: per ``%Y-W%U`` KST week: sums, count, unweighted mean rate (4 dp)."""
    return (_dated(posts).groupBy("year_week")
            .agg(F.sum("reach").alias("total_reach"),
                 F.sum("engagement_total").alias("total_engagement"),
                 F.sum("followers_gained").alias("total_followers"),
                 F.count("post_id").alias("post_count"),
                 F.round(F.avg("engagement_rate"), 4).alias("avg_engagement_rate")))


def _pct_change(c: str, order: str, part: list[str] | None = None) -> F.Column:
    w = Window.partitionBy(*part).orderBy(order) if part else Window.orderBy(order)
    prev = F.lag(c).over(w)
    r = F.col(c) / prev - 1.0
    # first row, 0/0 and x/0 (inf) all become 0
    return F.round(F.when(prev.isNull() | (prev == 0), F.lit(0.0)).otherwise(r), 4)


def weekly_growth(posts: DataFrame) -> DataFrame:
    """Growth vs the previous *present* week; first/inf/NaN -> 0."""
    wk = weekly_rollup(posts)
    return wk.select("year_week", "total_reach", "total_engagement", "total_followers",
                     _pct_change("total_reach", "year_week").alias("reach_growth"),
                     _pct_change("total_engagement", "year_week").alias("engagement_growth"),
                     _pct_change("total_followers", "year_week").alias("followers_growth"))


def trend_label_agg(x: str, y: str) -> F.Column:
    """G4 over the rows of a group (x = position, y = value)."""
    cnt = F.count(y)
    sd = F.stddev_pop(y)
    slope = F.regr_slope(y, x)
    mean = F.avg(y)
    m = F.when(F.abs(mean) < 1e-10, F.lit(1.0)).otherwise(F.abs(mean))
    norm = slope / m
    return (F.when(cnt < 2, F.lit("insufficient_data"))
            .when(sd < 1e-10, F.lit("stable"))
            .when(norm > 0.05, F.lit("growing"))
            .when(norm < -0.05, F.lit("declining"))
            .otherwise(F.lit("stable")))


def _last_n(df: DataFrame, order: str, n: int, part: list[str] | None = None) -> DataFrame:
    """Last n rows by ``order`` with their position 0..n-1 (oldest first)."""
    w = Window.partitionBy(*part).orderBy(F.col(order).desc()) if part else Window.orderBy(F.col(order).desc())
    r = df.withColumn("_rd", F.row_number().over(w)).where(F.col("_rd") <= n)
    cnt = F.count(F.lit(1)).over(Window.partitionBy(*part)) if part else F.count(F.lit(1)).over(Window.partitionBy())
    return r.withColumn("_x", (cnt - F.col("_rd")).cast("double"))


def trajectory(posts: DataFrame, n: int = 4) -> DataFrame:
    """Averages over the last 4 present weeks (+ G4 trend labels)."""
    last = _last_n(weekly_rollup(posts), "year_week", n)
    return last.agg(
        F.coalesce(F.avg("total_reach").cast("long"), F.lit(0)).alias("avg_weekly_reach"),
        F.coalesce(F.avg("total_engagement").cast("long"), F.lit(0)).alias("avg_weekly_engagement"),
        F.coalesce(F.avg("total_followers").cast("long"), F.lit(0)).alias("avg_weekly_followers"),
        F.coalesce(F.bround(F.avg("post_count"), 1), F.lit(0.0)).alias("avg_weekly_posts"),
        trend_label_agg("_x", "total_reach").alias("reach_trend"),
        trend_label_agg("_x", "total_engagement").alias("engagement_trend"),
        trend_label_agg("_x", "total_followers").alias("follower_trend"))


def platform_growth(posts: DataFrame, n: int = 4) -> DataFrame:
    """Per platform with >= 2 weeks: latest week's reach, trend of the
    last 4 weeks, followers gained over all weeks."""
    pw = (_dated(posts).groupBy("platform", "year_week")
          .agg(F.sum("reach").alias("reach"), F.sum("followers_gained").alias("followers")))
    tot = pw.groupBy("platform").agg(F.count(F.lit(1)).alias("n_weeks"),
                                      F.sum("followers").alias("total_followers_gained"),
                                      F.max_by("reach", "year_week").alias("latest_week_reach"))
    tr = (_last_n(pw, "year_week", n, ["platform"]).groupBy("platform")
          .agg(trend_label_agg("_x", "reach").alias("reach_trend")))
    return (tot.where(F.col("n_weeks") >= 2).join(tr, "platform")
            .select("platform", "latest_week_reach", "reach_trend", "total_followers_gained", "n_weeks"))


def trend_label(posts: DataFrame) -> DataFrame:
    """G4 applied to every weekly metric over the full present-week series."""
    wk = weekly_rollup(posts)
    x = F.row_number().over(Window.orderBy("year_week")).cast("double") - 1
    wk = wk.withColumn("_x", x)
    long = wk.unpivot(["_x"], ["total_reach", "total_engagement", "total_followers", "post_count"],
                      "metric", "value").withColumn("value", F.col("value").cast("double"))
    return long.groupBy("metric").agg(trend_label_agg("_x", "value").alias("trend"),
                                      F.count(F.lit(1)).alias("n_weeks"))


# ---------------------------------------------------------------------------
# G6–G11 forecasting
# ---------------------------------------------------------------------------
def weekly_series_monday(posts: DataFrame, scope_col: str | None = None) -> DataFrame:
    """Monday-start KST weeks (present weeks only)."""
    d = posts.where(F.col("published_at").isNotNull())
    keys = ([scope_col] if scope_col else []) + [X.week_start_monday(X.kst("published_at")).alias("week_start")]
    return (d.groupBy(*keys)
            .agg(F.sum("reach").alias("total_reach"), F.sum("engagement_total").alias("total_engagement"),
                 F.sum("followers_gained").alias("total_followers"), F.count("post_id").alias("post_count"),
                 F.round(F.avg("engagement_rate"), 4).alias("avg_engagement_rate")))


METRICS = {"reach": "total_reach", "engagement": "total_engagement", "followers": "total_followers"}


def _forecast_scopes(posts: DataFrame, min_posts: int = 7) -> DataFrame:
    """Weekly metric series for 'ALL' and every platform with >= 7 dated posts."""
    d = posts.where(F.col("published_at").isNotNull())
    s = d.withColumn("scope", F.explode(F.array(F.lit("ALL"), F.col("platform"))))
    ok = s.groupBy("scope").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= min_posts).select("scope")
    wk = weekly_series_monday(s.join(F.broadcast(ok), "scope", "left_semi"), "scope")
    return wk.select("scope", "week_start", F.explode(F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col(c).cast("double").alias("y")) for m, c in METRICS.items()])).alias("m")
    ).select("scope", "week_start", "m.metric", "m.y")


def forecast_params(posts: DataFrame, min_weeks: int = 4, min_posts: int = 7) -> DataFrame:
    """G7/G8 fitted parameters per (scope, metric): OLS over week index
    0..n-1 (slope 0 when n < 3), 4-week moving average, direction."""
    long = _forecast_scopes(posts, min_posts)
    part = ["scope", "metric"]
    w = Window.partitionBy(*part).orderBy("week_start")
    long = (long.withColumn("_x", (F.row_number().over(w) - 1).cast("double"))
            .withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(*part))))
    last4 = F.when(F.col("_x") >= F.col("_n") - 4, F.col("y"))
    g = long.groupBy(*part).agg(
        F.count(F.lit(1)).alias("historical_weeks"),
        F.regr_slope("y", "_x").alias("_slope"), F.regr_intercept("y", "_x").alias("_icpt"),
        F.avg("y").alias("_mean"), F.avg(last4).alias("_ma"),
        F.max("week_start").alias("last_week"))
    slope = F.when(F.col("historical_weeks") >= 3, F.coalesce(F.col("_slope"), F.lit(0.0))).otherwise(F.lit(0.0))
    icpt = F.when(F.col("historical_weeks") >= 3, F.coalesce(F.col("_icpt"), F.col("_mean"))).otherwise(F.col("_mean"))
    ma1 = F.when(F.col("moving_avg") != 0, F.col("moving_avg")).otherwise(F.lit(1.0))
    return (g.where(F.col("historical_weeks") >= min_weeks)
            .select(*part, "historical_weeks", "last_week",
                    slope.alias("slope"), icpt.alias("intercept"), F.col("_ma").alias("moving_avg"))
            .withColumn("current_weekly_avg", F.bround("moving_avg", 0).cast("long"))
            .withColumn("trend_direction", F.when(F.col("slope") > 0, "up").when(F.col("slope") < 0, "down").otherwise("flat"))
            .withColumn("weekly_change_rate", F.round(F.col("slope") / ma1, 4)))


def forecast_params_view(posts: DataFrame) -> DataFrame:
    """G7 parameters with floats rounded to 4 dp for display / comparison."""
    return forecast_params(posts).select(
        "scope", "metric", "historical_weeks", "last_week",
        F.round("slope", 4).alias("slope"), F.round("intercept", 4).alias("intercept"),
        F.round("moving_avg", 4).alias("moving_avg"), "current_weekly_avg", "trend_direction", "weekly_change_rate")


def stat_forecast(posts: DataFrame, horizon_days: int = 28, confidence: float = 0.80) -> DataFrame:
    """Future weeks i = 1..h/7: max(0, .6·(slope·(n+i)+b) + .4·MA) with
    ±(1-confidence) bounds; half-even rounding as in Python ``round``."""
    p = forecast_params(posts)
    weeks = horizon_days // 7
    lo, hi = 1 - (1 - confidence), 1 + (1 - confidence)
    f = p.withColumn("i", F.explode(F.sequence(F.lit(1), F.lit(max(weeks, 1))))).where(F.col("i") <= weeks)
    blended = F.greatest(F.lit(0.0), 0.6 * (F.col("slope") * (F.col("historical_weeks") + F.col("i")) + F.col("intercept"))
                         + 0.4 * F.col("moving_avg"))
    return f.select("scope", "metric", "i",
                    F.date_add("last_week", F.col("i") * 7).alias("week"),
                    F.bround(blended, 0).cast("long").alias("predicted"),
                    F.bround(blended * lo, 0).cast("long").alias("lower_bound"),
                    F.bround(blended * hi, 0).cast("long").alias("upper_bound"))


def forecast_summary(posts: DataFrame, horizon_days: int = 28) -> DataFrame:
    """One sentence per (scope, metric) from the last forecast week."""
    p = forecast_params(posts)
    fc = stat_forecast(posts, horizon_days)
    last = fc.groupBy("scope", "metric").agg(F.max_by("predicted", "i").alias("final"), F.count(F.lit(1)).alias("k"))
    j = p.join(last, ["scope", "metric"], "left")
    avg1 = F.when(F.col("moving_avg") != 0, F.col("moving_avg")).otherwise(F.lit(1.0))
    change = (F.col("final") - F.col("moving_avg")) / avg1 * 100
    direction = F.when(change > 5, "increase").when(change < -5, "decrease").otherwise("remain stable")
    text = F.when(F.col("final").isNull(), F.lit("Insufficient data for forecast.")).otherwise(F.format_string(
        "Weekly %s is expected to %s over the next %d weeks. Current avg: %s, Projected: %s (%s%%).",
        F.col("metric"), direction, F.col("k"), F.format_number(F.col("moving_avg"), 0),
        F.format_number(F.col("final").cast("double"), 0),
        F.concat(F.when(change >= 0, "+").otherwise(""), F.format_string("%.1f", change))))
    return j.select("scope", "metric", text.alias("summary"))


def health(posts: DataFrame) -> DataFrame:
    """Mean of +1/0/−1 trend signs over reach, engagement, followers."""
    p = forecast_params(posts)
    g = p.groupBy("scope").agg(F.avg(F.signum("slope")).alias("_s"))
    return g.select("scope",
                    F.when(F.col("_s") > 0.5, "strong_growth").when(F.col("_s") > -0.5, "stable")
                    .otherwise("needs_attention").alias("status"),
                    F.round("_s", 2).alias("signal_score"))


def seasonal_index(posts: DataFrame, min_weeks: int = 52) -> DataFrame:
    """G11 (re-aimed): week-of-year seasonal index = mean(y at that week of
    year) / overall mean, per (scope, metric), once >= 52 weeks exist."""
    long = _forecast_scopes(posts)
    n = long.groupBy("scope", "metric").agg(F.count(F.lit(1)).alias("_n"), F.avg("y").alias("_m"))
    woy = long.withColumn("woy", F.weekofyear("week_start")).groupBy("scope", "metric", "woy").agg(F.avg("y").alias("_wm"))
    return (woy.join(n, ["scope", "metric"]).where(F.col("_n") >= min_weeks)
            .select("scope", "metric", "woy",
                    F.round(F.col("_wm") / F.when(F.col("_m") != 0, F.col("_m")), 4).alias("seasonal_index")))


#: Days of a year, and standard errors of an 80 % interval.
YEAR, ERRORS_80 = 365.25, 1.2815515655446004


def _wave(day: F.Column) -> tuple[F.Column, F.Column]:
    """Cosine and sine of a date's place in the year."""
    angle = 2 * math.pi * F.datediff(day, F.lit("1970-01-01").cast("date")) / YEAR
    return F.cos(angle), F.sin(angle)


def seasonal_forecast(posts: DataFrame, horizon_days: int = 28, min_weeks: int = 52) -> DataFrame:
    """G11 (re-aimed): y = a + b * week + p * cos + q * sin of the place in the year, fitted by least squares per (scope, metric)
    with at least ``min_weeks`` weeks, and its values in the weeks ahead with an 80 % interval from the residuals.

    The normal equations are covariances, summed per group by partial aggregates, and their three unknowns are
    solved in columns; no group meets in one task.
    """
    c, s = _wave(F.col("week_start"))
    start = F.lit("1970-01-05").cast("date")              # a Monday: week numbers without a sort
    long = _forecast_scopes(posts).withColumns({"t": (F.datediff("week_start", start) / 7).cast("double"), "c": c, "s": s})
    names = ["t", "c", "s"]
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i:]] + [(a, "y") for a in names]
    g = long.groupBy("scope", "metric").agg(
        F.count(F.lit(1)).alias("historical_weeks"), F.max("week_start").alias("last_week"), *[F.avg(x).alias(f"m_{x}") for x in [*names, "y"]],
        *[F.covar_pop(a, b).alias(f"{a}{b}") for a, b in pairs]).where(F.col("historical_weeks") >= min_weeks)
    v = {(a, b): F.col(f"{a}{b}") for a, b in pairs} | {(b, a): F.col(f"{a}{b}") for a, b in pairs}

    def det(columns: list[str]) -> F.Column:
        (a1, a2, a3), (b1, b2, b3), (c1, c2, c3) = [[v[r, k] for r in names] for k in columns]
        return a1 * (b2 * c3 - b3 * c2) - b1 * (a2 * c3 - a3 * c2) + c1 * (a2 * b3 - a3 * b2)
    whole = det(names)
    g = g.withColumns({f"k_{x}": det(["y" if n == x else n for n in names]) / F.when(whole != 0, whole) for x in names}).where(F.col("k_t").isNotNull())
    fit = g.withColumn("k_1", F.col("m_y") - F.col("k_t") * F.col("m_t") - F.col("k_c") * F.col("m_c") - F.col("k_s") * F.col("m_s"))
    fit = fit.select("scope", "metric", "historical_weeks", "last_week", "k_1", "k_t", "k_c", "k_s")

    def value(t, c, s):
        return F.col("k_1") + F.col("k_t") * t + F.col("k_c") * c + F.col("k_s") * s
    off = F.col("y") - value(F.col("t"), F.col("c"), F.col("s"))
    spread = long.join(fit.drop("historical_weeks", "last_week"), ["scope", "metric"]).groupBy("scope", "metric").agg(F.sqrt(F.avg(off * off)).alias("spread"))
    ahead = (fit.join(spread, ["scope", "metric"]).withColumn("i", F.explode(F.sequence(F.lit(1), F.lit(max(horizon_days // 7, 1)))))
             .where(F.col("i") <= horizon_days // 7).withColumn("week", F.date_add("last_week", F.col("i") * 7)))
    c, s = _wave(F.col("week"))
    ahead = ahead.withColumns({"_c": c, "_s": s, "_t": (F.datediff("week", start) / 7).cast("double")})
    y = value(F.col("_t"), F.col("_c"), F.col("_s"))
    whole_number = lambda x: F.bround(F.greatest(F.lit(0.0), x), 0).cast("long")
    return ahead.select("scope", "metric", "i", "week", "historical_weeks", whole_number(y).alias("predicted"),
                        whole_number(y - ERRORS_80 * F.col("spread")).alias("lower_bound"), whole_number(y + ERRORS_80 * F.col("spread")).alias("upper_bound"),
                        F.round(F.col("k_t"), 4).alias("weekly_trend"),
                        F.round(F.col("k_c") * F.col("_c") + F.col("k_s") * F.col("_s"), 2).alias("seasonal_part"))


def weekly_dense_90d(posts: DataFrame) -> DataFrame:
    """Per platform, calendar weeks ending Sunday (KST) with empty weeks
    present as 0, clipped to the 90 days before the last week."""
    d = posts.where(F.col("published_at").isNotNull())
    loc = X.kst("published_at")
    wk_end = F.date_add(F.to_date(loc), (6 - X.dow_index(loc)).cast("int"))
    agg = d.groupBy("platform", wk_end.alias("week_end")).agg(F.sum("reach").alias("reach"),
                                                              F.sum("engagement_total").alias("engagement"))
    span = agg.groupBy("platform").agg(F.min("week_end").alias("_a"), F.max("week_end").alias("_b"))
    spine = span.select("platform", "_b", F.explode(F.sequence("_a", "_b", F.expr("INTERVAL 7 DAYS"))).alias("week_end"))
    spine = spine.where(F.col("week_end") >= F.date_sub("_b", 90))
    out = spine.join(agg, ["platform", "week_end"], "left").select(
        "platform", "week_end", F.coalesce("reach", F.lit(0)).alias("reach"),
        F.coalesce("engagement", F.lit(0)).alias("engagement"))
    ok = out.groupBy("platform").agg(F.count(F.lit(1)).alias("_k")).where(F.col("_k") >= 2).select("platform")
    return out.join(F.broadcast(ok), "platform", "left_semi")
