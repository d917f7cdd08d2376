"""R6 — the weekly report job: posts -> every result table -> sinks.

``posts`` is written once as Parquet in the shared checkpoint folder (executor
loss does not replay the ingest, and each table reads its own columns); the
independent result tables are then computed as concurrent Spark jobs from a
small driver thread pool and written one sink per table.
"""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from pulsekit.operators import account, growth, insights, kpi, ml, scoring, similarity, temporal, text, trends
from pulsekit.session import ensure_checkpoint_dir
from pulsekit.sources.history import summary_document, write_results

REPORT_TABLES = {
    "platform_overview": kpi.platform_overview,
    "content_performance": kpi.content_performance,
    "platform_content_ranking": kpi.platform_content_ranking,
    "engagement_composition": kpi.engagement_composition,
    "engagement_mix_platform": kpi.engagement_mix_platform,
    "cross_platform_averages": kpi.cross_platform_averages,
    "content_platform_fit": kpi.content_platform_fit,
    "hourly_profile": temporal.hourly_profile,
    "daily_profile": temporal.daily_profile,
    "heatmap": temporal.heatmap_pivot,
    "weekly_schedule": temporal.weekly_schedule,
    "top5_slots": temporal.top5_slots,
    "avoid_slots": temporal.avoid_slots,
    "next_best_time": temporal.next_best_time,
    "weekly_growth": growth.weekly_growth,
    "trajectory": growth.trajectory,
    "platform_growth": growth.platform_growth,
    "forecast": growth.stat_forecast,
    "seasonal_forecast": growth.seasonal_forecast,
    "health": growth.health,
    "viral_posts": scoring.viral_posts,
    "underperformers": scoring.underperformers,
    "scores_by_type": scoring.scores_by_type,
    "scores_by_platform": scoring.scores_by_platform,
    "top_scored": scoring.top_scored,
    "expected_performance": scoring.expected_performance,
    "term_lift": text.term_lift,
    "hashtag_perf": text.hashtag_perf,
    "content_fatigue": trends.content_fatigue,
    "posting_cadence": trends.cadence_summary,
    "momentum": trends.momentum,
    "recommendations": insights.recommendations,
    "pulse": insights.pulse,
    "key_numbers": insights.key_numbers,
    "summary_lists": insights.summary_lists,
    "driver_corr": text.driver_corr,
    "driver_lift": text.driver_lift,
}


#: Tables over posts and their caption vectors; fits and searches run for all platforms together.
MODEL_TABLES = {
    "ml_suite_status": lambda p, e: ml.ml_suite_status(p),
    "feature_importance": ml.feature_importance,
    "engagement_predictor": ml.engagement_predictor,
    "root_cause": ml.root_cause,
    "content_tiers": lambda p, e: ml.content_tiers(p),
    "isolation_outliers": lambda p, e: ml.isolation_outliers(p),
    "topics": ml.topics,
    "hashtag_clusters": ml.hashtag_clusters,
    "similar_summary": similarity.similar_summary,
    "similar_ranked": similarity.similar_ranked,
    "similar_recent": similarity.similar_recent,
}


def snapshot(posts: DataFrame) -> DataFrame:
    """``posts`` as Parquet in the shared folder: the tables then read only their columns."""
    spark = posts.sparkSession
    at = f"{ensure_checkpoint_dir(spark)}/report-{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
    posts.write.parquet(at)
    return spark.read.schema(posts.schema).parquet(at)


def weekly_report(spark: SparkSession, posts: DataFrame, out_dir: str | None = None,
                  tables: dict | None = None, parallel: int = 4, series: DataFrame | None = None,
                  embeddings: DataFrame | None = None, models: dict | None = None) -> dict[str, DataFrame]:
    """Build every result table from ``posts``; write them when ``out_dir``
    is given (one JSON sink per table + ``summary``).

    With ``series`` (daily account metrics) the account tables join in, with ``embeddings`` (caption
    vectors) the model and similarity tables.
    """
    base = snapshot(posts)
    fns = tables or REPORT_TABLES
    results = {name: fn(base) for name, fn in fns.items()}
    if series is not None:
        results |= account.account_tables(snapshot(series))
    if embeddings is not None:
        vectors = snapshot(embeddings)
        results |= {name: fn(base, vectors) for name, fn in (models or MODEL_TABLES).items()}
    if out_dir:
        def write(item):
            name, df = item
            return write_results({name: df}, out_dir)
        with ThreadPoolExecutor(max_workers=parallel) as ex:
            list(ex.map(write, results.items()))
        doc = summary_document(kpi.meta(base), results["health"], results["recommendations"])
        write_results({"summary": doc}, out_dir, fmt="text")
    return results
