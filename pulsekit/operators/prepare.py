"""N13/N14 — recency weights and KST calendar fields on the post table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsekit.functions import exprs as X


def with_recency_weight(df: DataFrame, ts_col: str = "published_at", reference=None) -> DataFrame:
    """Weight 1.0/0.3/0.1 by age against ``reference`` (default: the max
    timestamp in the data, never the wall clock).  All-null dates -> 1.0.

    The anchor is a one-row scalar subquery: computed once, inlined as a
    literal, no join or un-partitioned window.
    """
    ref = F.lit(reference).cast("timestamp_ntz") if reference is not None else \
        df.select(F.max(ts_col)).scalar()
    w = F.when(ref.isNull(), F.lit(1.0)).otherwise(X.recency_weight(F.col(ts_col), ref))
    return df.withColumn("weight", w)


def with_calendar(df: DataFrame, ts_col: str = "published_at") -> DataFrame:
    """KST day name, hour, ISO week, ``%Y-W%U`` key, ``yyyy-MM`` month.
    Null timestamps -> 'Unknown' / 0.  One projection."""
    local = X.kst(F.col(ts_col))
    return df.select(
        "*", local.alias("ts_kst"),
        F.coalesce(X.day_name(local), F.lit("Unknown")).alias("day_of_week"),
        X.dow_index(local).alias("dow"),
        F.coalesce(F.hour(local), F.lit(0)).alias("hour"),
        F.coalesce(X.iso_week(local), F.lit(0)).alias("week"),
        F.coalesce(X.year_week_sunday(local), F.lit("Unknown")).alias("year_week"),
        F.coalesce(F.date_format(local, "yyyy-MM"), F.lit("Unknown")).alias("month"))


def prepare_posts(df: DataFrame) -> DataFrame:
    return with_calendar(with_recency_weight(df))
