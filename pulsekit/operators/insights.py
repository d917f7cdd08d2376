"""R1–R3 — rule tables: recommendations, executive pulse, key numbers.

Each rule is a ``select`` over an already-aggregated result table (a few
rows per platform), unioned and ordered by (priority, rule, platform); no
rule touches raw posts again.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulsekit.functions import exprs as X
from pulsekit.functions.messages import TEXT
from pulsekit.operators import growth, kpi, scoring, temporal
from pulsekit.session import cut_lineage, cut_lineages

PRIORITY = {"high": 0, "medium": 1, "low": 2}


def _pct1(x: F.Column) -> F.Column:
    """``{x:.1%}`` on a value first rounded to 0.1 %."""
    return F.concat(F.format_string("%.1f", F.round(x * 100, 1)), F.lit("%"))


def _rec(df: DataFrame, rule_ix: int, priority: str, category: str, message: F.Column,
         platform: F.Column | None = None) -> DataFrame:
    return df.select(F.lit(rule_ix).alias("rule_ix"), (platform if platform is not None else F.lit(None).cast("string")).alias("platform"),
                     F.lit(priority).alias("priority"), F.lit(PRIORITY[priority]).alias("priority_rank"),
                     F.lit(category).alias("category"), message.alias("message"))


def recommendations(posts: DataFrame, min_posts: int = 10) -> DataFrame:
    """The reference's rule set over C6, T1, T2, C7, C1, G5 and X1."""
    pname = X.platform_name(F.col("platform"))
    rules = []
    # small result tables that several rules read
    pcr, top3, ov, pg, dp, ec, vp, totals = cut_lineages(
        kpi.platform_content_ranking(posts).where(F.col("rank") == 1), temporal.hourly_profile(posts).where(F.col("rank") <= 3),
        kpi.platform_overview(posts), growth.platform_growth(posts), temporal.daily_profile(posts).where((F.col("rank") == 1) & (F.col("post_count") >= 3)),
        kpi.engagement_composition(posts).where(F.col("conversation_ratio") < 0.05),
        scoring.viral_posts(posts).groupBy("platform").agg(
            F.array_join(F.array_sort(F.collect_set(X.content_label(F.col("content_type")))), ", ").alias("_types")),
        posts.groupBy("platform").agg(F.count(F.lit(1)).alias("n")))
    n_posts = totals.select(F.coalesce(F.sum("n"), F.lit(0))).scalar()
    one = totals.select(F.lit(1).alias("_one")).limit(1)
    enough = n_posts >= min_posts
    # 1. best content type per platform
    rules.append(_rec(pcr, 1, "high", "content", F.format_string(
        TEXT["on_your_best_content_type"],
        pname, X.content_label(F.col("content_type")), _pct1(F.col("engagement_rate")), F.col("count")), F.col("platform")))
    # 2-4. best hour: the top hour if it has >= 3 posts, else the first of
    # the top-3 hours with >= 3 posts, else a low-priority note
    first_ok = top3.where(F.col("post_count") >= 3).select(F.min("rank")).scalar()
    rules.append(_rec(top3.where((F.col("rank") == 1) & (F.col("post_count") >= 3)), 2, "high", "timing",
                      F.format_string(TEXT["your_best_posting_hour_is"], F.col("hour"), F.col("post_count"))))
    rules.append(_rec(top3.where((F.col("rank") == first_ok) & (first_ok > 1)), 3, "medium", "timing",
                      F.format_string(TEXT["hour_kst_shows_strong_engagement"], F.col("hour"), F.col("post_count"))))
    rules.append(_rec(top3.where((F.col("rank") == 1) & first_ok.isNull()), 4, "low", "timing",
                      F.lit(TEXT["not_enough_data_per_time"])))
    # 5. best day
    rules.append(_rec(dp, 5, "medium", "timing", F.format_string(
        TEXT["best_performing_day_is_consider"], F.col("day_of_week"))))
    # 6. conversation ratio
    rules.append(_rec(ec, 6, "medium", "engagement", F.lit(
        TEXT["comments_to_likes_ratio_is"])))
    # 7/8. benchmark gap
    rules.append(_rec(ov.where(F.col("vs_benchmark") < -0.02), 7, "medium", "platform", F.format_string(
        TEXT["engagement_is_below_industry_benchmark"], pname), F.col("platform")))
    rules.append(_rec(ov.where(F.col("vs_benchmark") > 0.02), 8, "low", "platform", F.format_string(
        TEXT["is_outperforming_industry_benchmark_by"], pname, _pct1(F.col("vs_benchmark"))),
        F.col("platform")))
    # 9/10. reach trend per platform
    rules.append(_rec(pg.where(F.col("reach_trend") == "declining"), 9, "high", "growth", F.format_string(
        TEXT["reach_is_declining_consider_boosting"],
        pname), F.col("platform")))
    rules.append(_rec(pg.where(F.col("reach_trend") == "growing"), 10, "low", "growth", F.format_string(
        TEXT["reach_is_growing_keep_up"], pname), F.col("platform")))
    # 11. viral formats per platform
    rules.append(_rec(vp, 11, "high", "content", F.format_string(
        TEXT["viral_content_on_create_more"], pname, F.col("_types")), F.col("platform")))
    # 12. methodology note
    nplat = totals.select(F.count("platform")).scalar()
    rules.append(_rec(one.where(nplat > 1), 12, "low", "methodology", F.lit(
        TEXT["note_instagram_engagement_rate_uses"])))
    body = reduce(DataFrame.unionByName, rules).where(enough)
    warn = _rec(one.where(~enough), 0, "high", "data", F.lit(
        TEXT["not_enough_data_for_deep"]))
    out = body.unionByName(warn)
    w = Window.orderBy("priority_rank", "rule_ix", F.col("platform").asc_nulls_first())
    return out.withColumn("rank", F.row_number().over(w))


def pulse(posts: DataFrame) -> DataFrame:
    """R2: good / bad signal counts (benchmark gap, reach trend, momentum
    >= 60 / < 35) -> good / bad / ok, plus the top viral multiplier."""
    ov = kpi.platform_overview(posts).select(
        "platform", (F.col("vs_benchmark") > 0).cast("int").alias("g"), (F.col("vs_benchmark") < -0.02).cast("int").alias("b"))
    pg = growth.platform_growth(posts).select(
        "platform", (F.col("reach_trend") == "growing").cast("int").alias("g"),
        (F.col("reach_trend") == "declining").cast("int").alias("b"))
    from pulsekit.operators import trends
    mo = trends.momentum(posts).select(
        "platform", (F.col("total_score") >= 60).cast("int").alias("g"), (F.col("total_score") < 35).cast("int").alias("b"))
    s = ov.unionByName(pg).unionByName(mo).agg(F.coalesce(F.sum("g"), F.lit(0)).alias("signals_good"),
                                              F.coalesce(F.sum("b"), F.lit(0)).alias("signals_bad"))
    vmax = scoring.viral_posts(posts).select(F.max("multiplier")).scalar()
    g, b = F.col("signals_good"), F.col("signals_bad")
    cls = F.when((g >= 2) & (g > b * 3), "good").when((b >= 2) & (b >= g), "bad").otherwise("ok")
    text = (F.when(cls == "good", TEXT["things_are_looking_great_our"])
            .when(cls == "bad", TEXT["there_are_some_areas_that"])
            .otherwise(TEXT["our_social_media_presence_is"]))
    text = F.when(vmax.isNotNull(), F.concat(text, F.format_string(
        TEXT["we_had_a_standout_post"], vmax.cast("string")))).otherwise(text)
    return s.select(g.cast("long").alias("signals_good"), b.cast("long").alias("signals_bad"),
                    cls.alias("pulse_class"), text.alias("pulse_text"))


def key_numbers(posts: DataFrame) -> DataFrame:
    """The key-number lines (posts, reach per platform, interactions,
    followers, week-over-week highlights beyond ±10 %)."""
    ov = cut_lineage(kpi.platform_overview(posts))           # a row per platform, read by every line
    tot = ov.agg(F.sum("total_posts").alias("p"), F.sum("total_engagement").alias("e"),
                 F.sum("total_followers_gained").alias("f"))
    pname = X.platform_name(F.col("platform"))

    def fmt(c):
        return F.format_number(F.col(c).cast("double"), 0)
    lines = [
        tot.select(F.lit(1).alias("ix"), F.lit(None).cast("string").alias("platform"),
                   F.format_string(TEXT["we_ve_published_posts_in"], fmt("p")).alias("text")),
        ov.select(F.lit(2).alias("ix"), "platform", F.when(F.col("platform") == "tiktok", F.format_string(
            "%s: %s video views", pname, fmt("total_reach"))).otherwise(F.format_string(
                "%s: reached %s people", pname, fmt("total_reach"))).alias("text")),
        tot.select(F.lit(3).alias("ix"), F.lit(None).cast("string").alias("platform"), F.format_string(
            TEXT["we_received_interactions_likes_comments"], fmt("e")).alias("text")),
        tot.where(F.col("f") > 0).select(F.lit(4).alias("ix"), F.lit(None).cast("string").alias("platform"),
                                         F.format_string(TEXT["we_gained_new_followers_across"], fmt("f")).alias("text")),
        ov.where(F.col("wow_reach_change") > 0.1).select(F.lit(5).alias("ix"), "platform", F.format_string(
            TEXT["reach_grew_compared_to_last"], pname,
            F.round(F.col("wow_reach_change") * 100, 0).cast("int")).alias("text")),
        ov.where(F.col("wow_reach_change") < -0.1).select(F.lit(5).alias("ix"), "platform", F.format_string(
            TEXT["reach_dropped_compared_to_last"], pname,
            F.round(F.abs(F.col("wow_reach_change")) * 100, 0).cast("int")).alias("text")),
    ]
    return reduce(DataFrame.unionByName, lines)


def summary_lists(posts: DataFrame) -> DataFrame:
    """R4: 'what's working' (max 6), 'needs attention' (max 5) and 'this
    week's actions' (max 4) as ranked rows (list, ix, text).  Items follow
    the reference's order; platforms are taken in name order; viral items
    name the post id instead of a caption excerpt."""
    from pulsekit.operators import text as T_
    from pulsekit.operators import trends
    pname = X.platform_name(F.col("platform"))
    ctitle = F.initcap(F.regexp_replace(F.col("content_type"), "_", " "))
    # Each input is a small result table used several times below: compute
    # it once and keep it in the shared checkpoint folder (short plans).
    hp, dp, pcr, dl, vp, pg, fat, ov, ec, cad = cut_lineages(
        temporal.hourly_profile(posts).where(F.col("rank") == 1), temporal.daily_profile(posts).where(F.col("rank") == 1),
        kpi.platform_content_ranking(posts).where(F.col("rank") == 1), T_.driver_lift(posts), scoring.viral_posts(posts),
        growth.platform_growth(posts), trends.content_fatigue(posts), kpi.platform_overview(posts),
        kpi.engagement_composition(posts), trends.cadence_summary(posts))

    def item(df, lst, ix, txt, sub=None):
        return df.select(F.lit(lst).alias("list"), F.lit(ix).alias("ix"),
                         (sub if sub is not None else F.lit(None).cast("string")).alias("sub_key"), txt.alias("text"))
    work = [
        item(pcr, "working", 1, F.format_string(TEXT["posts_on_get_the_best"],
                                                ctitle, pname, F.col("count")), F.col("platform")),
        item(hp.where(F.col("post_count") >= 3), "working", 2,
             F.format_string(TEXT["posting_around_kst_gets_the"], F.col("hour"))),
        item(dp.where(F.col("post_count") >= 3), "working", 3,
             F.format_string(TEXT["is_our_best_performing_day"], F.col("day_of_week"))),
        item(dl.where((F.col("factor") == "is_multilingual") & (F.col("lift") > 0.1)), "working", 4,
             F.format_string(TEXT["multilingual_captions_korean_english_boost"], pname),
             F.concat(F.col("platform"), F.lit("1"))),
        item(dl.where((F.col("factor") == "has_emoji") & (F.col("lift") > 0.1)), "working", 4,
             F.format_string(TEXT["using_emojis_increases_engagement_on"], pname), F.concat(F.col("platform"), F.lit("2"))),
        item(vp.withColumn("_v", F.row_number().over(Window.orderBy(F.col("multiplier").desc(), "platform", "post_id")))
             .where(F.col("_v") <= 2), "working", 5,
             F.format_string(TEXT["our_post_went_viral_on"], F.col("post_id"), pname,
                             F.col("multiplier").cast("string")), F.lpad(F.col("_v").cast("string"), 3, "0")),
    ]
    attn = [
        item(pg.where(F.col("reach_trend") == "declining"), "attention", 1, F.format_string(
            TEXT["reach_has_been_declining_recently"], pname),
            F.col("platform")),
        item(fat.where(F.col("trend") == "declining"), "attention", 2, F.format_string(
            TEXT["our_audience_may_be_getting"], ctitle, pname),
            F.concat_ws("|", "platform", "severity_rank", "content_type")),
        item(ec.where(F.col("conversation_ratio") < 0.05), "attention", 3, F.lit(
            TEXT["we_re_getting_lots_of"])),
        item(ov.where(F.col("vs_benchmark") < -0.02), "attention", 4, F.format_string(
            TEXT["engagement_is_below_the_industry"], pname),
            F.col("platform")),
    ]
    first_plat = pcr.select(F.min("platform")).scalar()
    has_attn = reduce(DataFrame.unionByName, attn).select(F.count(F.lit(1))).scalar() > 0
    cad_first = cad.where(F.col("platform") == cad.select(F.min("platform")).scalar())
    grow = fat.where(F.col("trend") == "growing")
    grow_first = grow.where(F.col("platform") == grow.select(F.min("platform")).scalar())
    grow_first = grow_first.where(F.col("content_type") == grow_first.select(F.min("content_type")).scalar())
    acts = [
        item(pcr.where(F.col("platform") == first_plat), "actions", 1, F.format_string(
            TEXT["create_more_content_on_it"], ctitle, pname)),
        item(hp, "actions", 2, F.format_string(TEXT["schedule_your_most_important_post"], F.col("hour"))),
        item(cad_first.where(F.col("optimal_for_engagement") > F.col("current_cadence") + 1), "actions", 3,
             F.format_string(TEXT["try_posting_times_per_week"], F.col("optimal_for_engagement"),
                             pname, F.bround("current_cadence", 0).cast("long"))),
        item(grow_first.where(has_attn), "actions", 4, F.format_string(
            TEXT["content_is_gaining_momentum_on"], ctitle, pname)),
    ]
    a = reduce(DataFrame.unionByName, acts)
    n_acts = a.select(F.count(F.lit(1))).scalar()
    a = a.unionByName(item(a.sparkSession.range(1).where(n_acts == 0), "actions", 9, F.lit(
        TEXT["keep_posting_consistently_your_data"])))
    allr = reduce(DataFrame.unionByName, work + attn).unionByName(a)
    w = Window.partitionBy("list").orderBy("ix", F.col("sub_key").asc_nulls_first())
    cap = F.element_at(X.map_lit({"working": 6, "attention": 5, "actions": 4}), F.col("list"))
    return (allr.withColumn("pos", F.row_number().over(w)).where(F.col("pos") <= cap)
            .select("list", "pos", "text"))
