"""Convenience entry points mirroring the reference's library functions.

Each returns a dict of result DataFrames (lazy; nothing is collected)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsekit.operators import growth, kpi, ml, scoring, temporal, text, trends
from pulsekit.operators.prepare import prepare_posts


def prepare(posts: DataFrame) -> DataFrame:
    """Add weights and calendar fields when a raw unified post table is given."""
    return posts if "weight" in posts.columns else prepare_posts(posts)


def analyze(posts: DataFrame) -> dict[str, DataFrame]:
    """Core analysis (platform overview, content, engagement, temporal,
    growth, anomalies, cross-platform, recommendations)."""
    from pulsekit.operators import insights
    p = prepare(posts)
    return {
        "meta": kpi.meta(p), "platform_overview": kpi.platform_overview(p),
        "content_performance": kpi.content_performance(p), "platform_rankings": kpi.platform_content_ranking(p),
        "engagement": kpi.engagement_composition(p), "engagement_by_platform": kpi.engagement_mix_platform(p),
        "hourly": temporal.hourly_profile(p), "daily": temporal.daily_profile(p),
        "platform_timing": temporal.best_times_platform(p), "heatmap": temporal.heatmap_pivot(p),
        "weekly": growth.weekly_growth(p), "trajectory": growth.trajectory(p),
        "platform_growth": growth.platform_growth(p),
        "viral": scoring.viral_posts(p), "underperformers": scoring.underperformers(p),
        "platform_averages": kpi.cross_platform_averages(p), "content_platform_fit": kpi.content_platform_fit(p),
        "recommendations": insights.recommendations(p),
    }


def score_content(posts: DataFrame) -> dict[str, DataFrame]:
    return scoring.score_content(prepare(posts))


def forecast_growth(posts: DataFrame, horizon_days: int = 0) -> dict[str, DataFrame]:
    p = prepare(posts)
    return {"params": growth.forecast_params_view(p), "forecast": growth.stat_forecast(p, horizon_days),
            "summary": growth.forecast_summary(p, horizon_days), "health": growth.health(p)}


def get_optimal_times(posts: DataFrame, platform: str | None = None) -> dict[str, DataFrame]:
    """The optimal schedule for all platforms ('ALL') or one platform."""
    p = prepare(posts)
    scope = F.lit(platform or "ALL")
    return {"weekly_schedule": temporal.weekly_schedule(p).where(F.col("scope") == scope),
            "days": temporal.schedule_days(p).where(F.col("scope") == scope),
            "top_5_slots": temporal.top5_slots(p).where(F.col("scope") == scope),
            "avoid_times": temporal.avoid_slots(p).where(F.col("scope") == scope),
            "next_best_time": temporal.next_best_time(p).where(F.col("scope") == scope)}


def run_ml(posts: DataFrame, platform: str, embeddings: DataFrame | None = None) -> dict[str, DataFrame]:
    """The per-platform model suite for one platform."""
    p = prepare(posts).where(F.col("platform") == platform)
    out = {"status": ml.ml_suite_status(p), "feature_importance": ml.feature_importance(p, embeddings),
           "engagement_prediction": ml.engagement_predictor(p, embeddings), "content_clusters": ml.content_tiers(p),
           "anomalies": ml.isolation_outliers(p), "caption_analysis": text.term_lift(p),
           "engagement_drivers_corr": text.driver_corr(p), "engagement_drivers_lift": text.driver_lift(p),
           "content_fatigue": trends.content_fatigue(p), "posting_cadence": trends.cadence_summary(p),
           "momentum_score": trends.momentum(p), "root_cause": ml.root_cause(p, embeddings)}
    if embeddings is not None:
        from pulsekit.operators import similarity
        out.update({"topic_discovery": ml.topics(p, embeddings),
                    "similar_posts": similarity.similar_summary(p, embeddings),
                    "hashtag_clusters": ml.hashtag_clusters(p, embeddings)})
    return out
