"""X1–X11 — rule-based anomalies and the composite content score.

Scalar statistics (per-platform means, global min/max) are small aggregates
joined back by broadcast (bounded by the number of platforms / one row), so
scoring is a single map-side projection over the posts.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulsekit.functions import exprs as X
from pulsekit.functions.order_stats import percentiles
from pulsekit.session import cut_lineage
from pulsekit.operators.kpi import LONG_MAX


def _newest_first_key() -> list:
    return X.tie_key_newest_first()


def _platform_means(posts: DataFrame, min_posts: int) -> DataFrame:
    return (posts.groupBy("platform")
            .agg(F.count(F.lit(1)).alias("_n"), F.avg("engagement_total").alias("_me"), F.avg("reach").alias("_mr"))
            .where((F.col("_n") >= min_posts) & F.col("_me").isNotNull() & (F.col("_me") != 0)))


def viral_posts(posts: DataFrame, min_posts: int = X.MIN_POSTS, mult: float = X.VIRAL_MULTIPLIER,
                top_n: int = X.TOP_N) -> DataFrame:
    """Engagement >= 2.5 × platform mean; the first 5 in table order
    (newest first), not the 5 largest.  The threshold filter runs before the
    ranking window, so only candidate rows are shuffled."""
    m = F.broadcast(_platform_means(posts, min_posts))
    c = posts.join(m, "platform").where(F.col("engagement_total") >= F.col("_me") * mult)
    w = Window.partitionBy("platform").orderBy(*_newest_first_key())
    return (c.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= top_n)
            .select("platform", "post_id", "content_type", F.col("engagement_total").alias("engagement"), "reach",
                    F.round(F.col("engagement_total") / F.col("_me"), 1).alias("multiplier"),
                    F.date_format("published_at", "yyyy-MM-dd HH:mm:ss").alias("published_at"), "permalink"))


def underperformers(posts: DataFrame, min_posts: int = X.MIN_POSTS, flop: float = X.UNDERPERFORM_THRESHOLD,
                    top_n: int = X.TOP_N) -> DataFrame:
    """Engagement <= 0.3 × mean and reach >= 0.5 × mean reach (mean reach
    > 0); first 5 in table order."""
    m = F.broadcast(_platform_means(posts, min_posts).where(F.col("_mr") > 0))
    c = posts.join(m, "platform").where((F.col("engagement_total") <= F.col("_me") * flop)
                                        & (F.col("reach") >= F.col("_mr") * 0.5))
    w = Window.partitionBy("platform").orderBy(*_newest_first_key())
    return (c.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= top_n)
            .select("platform", "post_id", "content_type", F.col("engagement_total").alias("engagement"), "reach",
                    F.round("engagement_rate", 4).alias("engagement_rate"),
                    F.date_format("published_at", "yyyy-MM-dd HH:mm:ss").alias("published_at")))


def _minmax(df: DataFrame, cols: dict[str, F.Column]) -> DataFrame:
    """Min-max normalise each expression over all rows (constant -> 0.5).
    All mins/maxes come from one scalar subquery (one scan, one row); no
    un-partitioned window.  Built as two projections to keep analysis cheap."""
    raw = df.select("*", *[e.alias(f"_raw_{n}") for n, e in cols.items()])
    stats = raw.select(F.struct(*[F.struct(F.min(f"_raw_{n}").alias("lo"), F.max(f"_raw_{n}").alias("hi")).alias(n)
                                  for n in cols])).scalar()
    outs = []
    for name in cols:
        lo, hi = stats.getField(name).getField("lo"), stats.getField(name).getField("hi")
        r = F.col(f"_raw_{name}")
        outs.append(F.when(hi == lo, F.lit(0.5)).otherwise((r - lo) / (hi - lo)).alias(name))
    return raw.select(*df.columns, *outs)


def scored_posts(posts: DataFrame, min_posts: int = 3) -> DataFrame:
    """Dimension scores, composite 0–100 (1 dp) and grade.
    Fewer than 3 posts in total -> nothing is scored."""
    q = sum(F.col(k).cast("double") * float(w) for k, w in X.SCORE_QUALITY_WEIGHTS.items())
    s = _minmax(posts, {
        "reach_score": F.col("reach").cast("double"),
        "engagement_score": F.col("engagement_total").cast("double"),
        "quality_score": q,
        "efficiency_score": F.col("engagement_rate"),
        "growth_score": F.col("followers_gained").cast("double"),
    })
    cw = X.COMPOSITE_WEIGHTS
    comp = (F.col("reach_score") * cw["reach"] + F.col("engagement_score") * cw["engagement"]
            + F.col("quality_score") * cw["quality"] + F.col("efficiency_score") * cw["efficiency"]
            + F.col("growth_score") * cw["growth"]) * 100
    n = posts.select(F.count(F.lit(1))).scalar()
    s = s.withColumn("composite_score", F.round(comp, 1)).withColumn("grade", X.grade(F.col("composite_score")))
    return s.where(n >= min_posts)


def scored_posts_view(posts: DataFrame) -> DataFrame:
    """Oracle-friendly projection of X5/X6."""
    return scored_posts(posts).select(
        "post_id", "platform", "content_type",
        *[F.round(c, 6).alias(c) for c in ("reach_score", "engagement_score", "quality_score",
                                           "efficiency_score", "growth_score")],
        "composite_score", "grade")


def scores_by_type(posts: DataFrame, scored: DataFrame | None = None) -> DataFrame:
    """Composite score mean/median/max/min/count per content type (1 dp)."""
    s = scored_posts(posts) if scored is None else scored
    return s.groupBy("content_type").agg(
        F.round(F.avg("composite_score"), 1).alias("avg_score"),
        # scores have one decimal from 0 to 100, so a group keeps at most 1001 values
        F.round(F.percentile("composite_score", 0.5), 1).alias("median_score"),
        F.round(F.max("composite_score"), 1).alias("best_score"),
        F.round(F.min("composite_score"), 1).alias("worst_score"),
        F.count("composite_score").alias("count"))


def scores_by_platform(posts: DataFrame, scored: DataFrame | None = None) -> DataFrame:
    """Composite score mean/max/count per platform (1 dp)."""
    s = scored_posts(posts) if scored is None else scored
    return s.groupBy("platform").agg(
        F.round(F.avg("composite_score"), 1).alias("avg_score"),
        F.round(F.max("composite_score"), 1).alias("best_score"),
        F.count("composite_score").alias("count"))


def top_scored(posts: DataFrame, n: int = 10, scored: DataFrame | None = None) -> DataFrame:
    """The n best-scored posts (newest first on ties) with rank.
    ``orderBy(...).limit(n)`` plans as TakeOrderedAndProject: a per-partition
    top-n, never a global sort."""
    s = scored_posts(posts) if scored is None else scored
    top = s.orderBy(F.col("composite_score").desc(), *_newest_first_key()).limit(n)
    w = Window.orderBy(F.col("composite_score").desc(), *_newest_first_key())
    return top.select(F.row_number().over(w).alias("rank"), "post_id", "platform", "content_type",
                      F.col("composite_score").alias("score"), "grade", "reach",
                      F.col("engagement_total").alias("engagement"),
                      F.date_format("published_at", "yyyy-MM-dd HH:mm:ss").alias("published_at"), "permalink")


def expected_performance(posts: DataFrame, min_match: int = 3) -> DataFrame:
    """For every (content type, platform) seen, medians of its own posts,
    falling back to the whole platform when it has < 3 posts.  Both grains
    are one aggregate each; the request rows pick one by support."""
    wanted = {"reach_med": ("reach", 0.5), "eng_med": ("engagement_total", 0.5), "rate_med": ("engagement_rate", 0.5),
              "likes_med": ("likes", 0.5), "comments_med": ("comments", 0.5), "shares_med": ("shares", 0.5),
              "reach_q1": ("reach", 0.25), "reach_q3": ("reach", 0.75)}

    def stats(keys):
        n = posts.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
        q = percentiles(posts, keys, wanted).withColumnsRenamed({k: f"_{k}" for k in keys})
        same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
        return n.join(q, reduce(lambda a, b: a & b, same), "left").drop(*[f"_{k}" for k in keys])
    pair = stats(["content_type", "platform"])
    plat = stats(["platform"])
    cols = ["n", "reach_med", "eng_med", "rate_med", "likes_med", "comments_med", "shares_med", "reach_q1", "reach_q3"]
    j = pair.join(F.broadcast(plat.select("platform", *[F.col(c).alias("p_" + c) for c in cols])), "platform")
    use_pair = F.col("n") >= min_match

    def pick(c):
        return F.when(use_pair, F.col(c)).otherwise(F.col("p_" + c))
    n = pick("n")
    out = j.select(
        "content_type", "platform",
        pick("reach_med").cast("long").alias("expected_reach"),
        pick("eng_med").cast("long").alias("expected_engagement"),
        F.round(pick("rate_med"), 4).alias("expected_engagement_rate"),
        pick("likes_med").cast("long").alias("expected_likes"),
        pick("comments_med").cast("long").alias("expected_comments"),
        pick("shares_med").cast("long").alias("expected_shares"),
        pick("reach_q3").cast("long").alias("optimistic_reach"),
        pick("reach_q1").cast("long").alias("pessimistic_reach"),
        F.when(n >= 20, "high").when(n >= 10, "medium").otherwise("low").alias("confidence"),
        n.alias("based_on_posts"),
        F.when(use_pair, "content_type").otherwise("platform").alias("basis"))
    return out.where(F.col("based_on_posts") >= min_match)


def score_content(posts: DataFrame, n: int = 10) -> dict[str, DataFrame]:
    """X11: the scoring bundle (top posts, by type, by platform) over one
    scored frame, materialised without captions."""
    s = cut_lineage(scored_posts(posts).drop("title"))
    return {"top_posts": top_scored(posts, n, s), "content_type_scores": scores_by_type(posts, s),
            "platform_scores": scores_by_platform(posts, s)}
