"""DuckDB SQL for every oracle-checkable query in the registry.

Each text runs on DuckDB against the raw parquet views (orders, lineitem,
documents, events, embeddings, ...).  ``POSTS`` reproduces the Spark
``posts`` view (raw posts + weights + KST calendar fields).
"""

from __future__ import annotations

POSTS = """
WITH li AS (
  SELECT l_orderkey, count(*) AS n_lines, sum(l_quantity) AS qty,
         sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS n_ret,
         sum(CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END) AS n_fin
  FROM lineitem GROUP BY l_orderkey),
nd AS (SELECT count(*) AS n_docs FROM documents),
b AS (
  SELECT o.o_orderkey,
    CASE o.o_custkey % 4 WHEN 0 THEN 'instagram' WHEN 1 THEN 'youtube' WHEN 2 THEN 'facebook' ELSE 'tiktok' END AS platform,
    CAST(o.o_orderdate AS TIMESTAMP) AS od, substring(o.o_orderpriority, 1, 1) AS pr,
    CASE WHEN o.o_orderkey % 97 = 0 THEN 0 ELSE CAST(floor(o.o_totalprice / 100) AS BIGINT) END AS reach,
    CAST(coalesce(li.qty, 0) AS BIGINT) AS likes, CAST(coalesce(li.n_lines, 0) AS BIGINT) AS comments,
    CAST(coalesce(li.n_ret, 0) AS BIGINT) AS shares, CAST(coalesce(li.n_fin, 0) AS BIGINT) AS saves
  FROM orders o LEFT JOIN li ON li.l_orderkey = o.o_orderkey),
raw_posts AS (
  SELECT CAST(b.o_orderkey AS VARCHAR) AS post_id, b.platform,
    CASE WHEN b.o_orderkey % 101 = 0 THEN NULL
         WHEN b.platform = 'tiktok' THEN b.od - INTERVAL '9' HOUR
         ELSE b.od + (b.o_orderkey % 24) * INTERVAL '1' HOUR + (b.o_orderkey % 60) * INTERVAL '1' MINUTE END AS published_at,
    CASE b.pr WHEN '1' THEN 'short_video' WHEN '2' THEN 'long_video' WHEN '3' THEN 'image' WHEN '4' THEN 'carousel' ELSE 'story' END AS content_type,
    concat(d.text, CASE b.o_orderkey % 7 WHEN 0 THEN ' #seoul' WHEN 1 THEN ' #서울 #Seoul' WHEN 2 THEN ' #Χαρά' WHEN 3 THEN ' 🙏' ELSE '' END) AS title,
    concat('https://example.com/p/', CAST(b.o_orderkey AS VARCHAR)) AS permalink,
    CAST((b.o_orderkey % 5) * 15 AS BIGINT) AS duration_sec, b.reach, b.reach AS views, b.likes, b.comments, b.shares, b.saves,
    CAST(b.o_orderkey % 11 AS BIGINT) AS followers_gained, CAST(b.o_orderkey % 3 AS BIGINT) AS link_clicks,
    CAST((b.o_orderkey % 5) * 10 * b.likes AS BIGINT) AS watch_time_sec, CAST((b.o_orderkey % 5) * 2.5 AS DOUBLE) AS avg_watch_sec,
    b.likes + b.comments + b.shares + b.saves AS engagement_total,
    CASE WHEN b.reach > 0 THEN least(CAST(b.likes + b.comments + b.shares + b.saves AS DOUBLE) / b.reach, 1.0) ELSE 0.0 END AS engagement_rate
  FROM b CROSS JOIN nd JOIN documents d ON d.doc_id = b.o_orderkey % nd.n_docs),
mx AS (SELECT max(published_at) AS now_ts FROM raw_posts),
p0 AS (
  SELECT r.*, r.published_at + INTERVAL 9 HOUR AS ts_kst,
    CASE WHEN mx.now_ts IS NULL THEN 1.0
         WHEN (epoch_us(mx.now_ts) - epoch_us(r.published_at)) / 86400e6 <= 90 THEN 1.0
         WHEN (epoch_us(mx.now_ts) - epoch_us(r.published_at)) / 86400e6 <= 180 THEN 0.3
         ELSE 0.1 END AS weight
  FROM raw_posts r CROSS JOIN mx),
posts AS (
  SELECT p0.*,
    coalesce(dayname(ts_kst), 'Unknown') AS day_of_week,
    CAST(isodow(ts_kst) - 1 AS INTEGER) AS dow,
    coalesce(CAST(hour(ts_kst) AS INTEGER), 0) AS hour,
    coalesce(CAST(week(ts_kst) AS INTEGER), 0) AS week,
    coalesce(strftime(ts_kst, '%Y-W%U'), 'Unknown') AS year_week,
    coalesce(strftime(ts_kst, '%Y-%m'), 'Unknown') AS month
  FROM p0)
"""

# Weighted mean with the reference's guards (0.0 when the weight sum < 1e-10).
def WAVG(v: str, w: str = "weight") -> str:
    return (f"(CASE WHEN coalesce(sum({w}), 0) >= 1e-10 THEN sum(({v}) * {w}) / sum({w}) ELSE 0.0 END)")


BENCH = ("(CASE platform WHEN 'instagram' THEN 0.02 WHEN 'youtube' THEN 0.039 "
         "WHEN 'facebook' THEN 0.014 WHEN 'tiktok' THEN 0.025 ELSE 0.03 END)")

PERIODS = """,
now_ AS (SELECT max(published_at) AS now_ts FROM posts),
pp AS (
  SELECT posts.*,
    coalesce(published_at >= now_ts - INTERVAL 7 DAY, false) AS tw,
    coalesce(published_at >= now_ts - INTERVAL 14 DAY AND published_at < now_ts - INTERVAL 7 DAY, false) AS lw
  FROM posts CROSS JOIN now_)
"""

TOP_ORDER = "engagement_total DESC, published_at DESC NULLS LAST, post_id"


def _q(body: str) -> str:
    return POSTS + body


SQL: dict[str, str] = {}

SQL["platform_overview"] = _q(PERIODS + f""",
top AS (
  SELECT platform, post_id AS top_post_id, engagement_total AS top_post_engagement,
         reach AS top_post_reach, content_type AS top_post_type
  FROM (SELECT *, row_number() OVER (PARTITION BY platform ORDER BY {TOP_ORDER}) AS rn FROM posts) WHERE rn = 1),
agg AS (
  SELECT platform, count(*) AS total_posts,
    CAST(sum(CASE WHEN tw THEN 1 ELSE 0 END) AS BIGINT) AS posts_this_week,
    CAST(sum(reach) AS BIGINT) AS total_reach, CAST(sum(engagement_total) AS BIGINT) AS total_engagement,
    {WAVG('engagement_rate')} AS wr,
    quantile_cont(engagement_rate, 0.5) AS med,
    CAST(sum(followers_gained) AS BIGINT) AS total_followers_gained,
    sum(CASE WHEN tw THEN reach ELSE 0 END) AS r_tw, sum(CASE WHEN lw THEN reach ELSE 0 END) AS r_lw,
    sum(CASE WHEN tw THEN engagement_total ELSE 0 END) AS e_tw, sum(CASE WHEN lw THEN engagement_total ELSE 0 END) AS e_lw
  FROM pp GROUP BY platform)
SELECT a.platform, total_posts, posts_this_week, total_reach, total_engagement,
  round(wr, 4) AS avg_engagement_rate, round(med, 4) AS median_engagement_rate,
  {BENCH.replace('platform', 'a.platform')} AS benchmark_engagement,
  round(wr - {BENCH.replace('platform', 'a.platform')}, 4) AS vs_benchmark,
  total_followers_gained,
  round((r_tw - r_lw) / CAST(nullif(r_lw, 0) AS DOUBLE), 4) AS wow_reach_change,
  round((e_tw - e_lw) / CAST(nullif(e_lw, 0) AS DOUBLE), 4) AS wow_engagement_change,
  top_post_id, top_post_engagement, top_post_reach, top_post_type
FROM agg a JOIN top t ON a.platform = t.platform
""")

SQL["top_post_per_platform"] = _q(f"""
SELECT platform, post_id, engagement_total AS engagement, reach, content_type,
  strftime(published_at, '%Y-%m-%d %H:%M:%S') AS published_at, permalink
FROM (SELECT *, row_number() OVER (PARTITION BY platform ORDER BY {TOP_ORDER}) AS rn FROM posts) WHERE rn = 1
""")

SQL["wow_change"] = _q(PERIODS + """,
g AS (
  SELECT CASE WHEN grouping(platform) = 1 THEN 'ALL' ELSE platform END AS scope,
    CAST(sum(CASE WHEN tw THEN reach ELSE 0 END) AS BIGINT) AS reach_this_week,
    CAST(sum(CASE WHEN lw THEN reach ELSE 0 END) AS BIGINT) AS reach_last_week,
    CAST(sum(CASE WHEN tw THEN engagement_total ELSE 0 END) AS BIGINT) AS engagement_this_week,
    CAST(sum(CASE WHEN lw THEN engagement_total ELSE 0 END) AS BIGINT) AS engagement_last_week,
    CAST(sum(CASE WHEN tw THEN 1 ELSE 0 END) AS BIGINT) AS posts_this_week,
    CAST(sum(CASE WHEN lw THEN 1 ELSE 0 END) AS BIGINT) AS posts_last_week
  FROM pp GROUP BY ROLLUP (platform))
SELECT *, round((reach_this_week - reach_last_week) / CAST(nullif(reach_last_week, 0) AS DOUBLE), 4) AS wow_reach_change,
  round((engagement_this_week - engagement_last_week) / CAST(nullif(engagement_last_week, 0) AS DOUBLE), 4) AS wow_engagement_change
FROM g
""")

SQL["content_performance"] = _q(f""",
g AS (
  SELECT content_type, count(*) AS count,
    CAST(trunc({WAVG('reach')}) AS BIGINT) AS avg_reach,
    CAST(trunc({WAVG('engagement_total')}) AS BIGINT) AS avg_engagement,
    round({WAVG('engagement_rate')}, 4) AS avg_engagement_rate,
    CAST(trunc({WAVG('likes')}) AS BIGINT) AS avg_likes,
    CAST(trunc({WAVG('comments')}) AS BIGINT) AS avg_comments,
    CAST(trunc({WAVG('shares')}) AS BIGINT) AS avg_shares,
    CAST(trunc({WAVG('saves')}) AS BIGINT) AS avg_saves,
    CAST(sum(reach) AS BIGINT) AS total_reach,
    string_agg(DISTINCT platform, ',' ORDER BY platform) AS platforms
  FROM posts GROUP BY content_type HAVING count(*) >= 5)
SELECT *, CAST(row_number() OVER (ORDER BY avg_engagement_rate DESC, content_type) AS INTEGER) AS rank FROM g
""")

SQL["platform_content_ranking"] = _q(f""",
g AS (
  SELECT platform, content_type, round({WAVG('engagement_rate')}, 4) AS engagement_rate, count(*) AS count,
    CAST(trunc({WAVG('engagement_total')}) AS BIGINT) AS avg_engagement
  FROM posts GROUP BY platform, content_type HAVING count(*) >= 2)
SELECT *, CAST(row_number() OVER (PARTITION BY platform ORDER BY engagement_rate DESC, content_type) AS INTEGER) AS rank FROM g
""")

SQL["engagement_composition"] = _q(""",
t AS (SELECT CAST(sum(likes) AS BIGINT) AS likes, CAST(sum(comments) AS BIGINT) AS comments,
             CAST(sum(shares) AS BIGINT) AS shares, CAST(sum(saves) AS BIGINT) AS saves,
             CAST(sum(reach) AS BIGINT) AS reach FROM posts),
t2 AS (SELECT *, CASE WHEN likes + comments + shares + saves <> 0 THEN likes + comments + shares + saves ELSE 1 END AS gt FROM t)
SELECT likes, comments, shares, saves,
  round(likes / CAST(gt AS DOUBLE), 4) AS likes_share, round(comments / CAST(gt AS DOUBLE), 4) AS comments_share,
  round(shares / CAST(gt AS DOUBLE), 4) AS shares_share, round(saves / CAST(gt AS DOUBLE), 4) AS saves_share,
  round((likes * 1 + comments * 3 + shares * 5 + saves * 4) / CAST(CASE WHEN reach <> 0 THEN reach ELSE 1 END AS DOUBLE), 6) AS quality_score,
  round(comments / CAST(CASE WHEN likes <> 0 THEN likes ELSE 1 END AS DOUBLE), 4) AS conversation_ratio,
  round(shares / CAST(gt AS DOUBLE), 4) AS virality_ratio
FROM t2
""")

SQL["engagement_mix_platform"] = _q(""",
g AS (SELECT platform, sum(likes) AS likes, sum(comments) AS comments, sum(shares) AS shares, sum(saves) AS saves,
             sum(engagement_total) AS et FROM posts GROUP BY platform)
SELECT platform,
  round(likes / CAST(CASE WHEN et <> 0 THEN et ELSE 1 END AS DOUBLE), 4) AS likes_pct,
  round(comments / CAST(CASE WHEN et <> 0 THEN et ELSE 1 END AS DOUBLE), 4) AS comments_pct,
  round(shares / CAST(CASE WHEN et <> 0 THEN et ELSE 1 END AS DOUBLE), 4) AS shares_pct,
  round(saves / CAST(CASE WHEN et <> 0 THEN et ELSE 1 END AS DOUBLE), 4) AS saves_pct
FROM g
""")

SQL["cross_platform_averages"] = _q(f""",
md AS (SELECT platform, content_type AS dominant_content_type FROM (
  SELECT platform, content_type, row_number() OVER (PARTITION BY platform ORDER BY count(*) DESC, content_type) AS rn
  FROM posts GROUP BY platform, content_type) WHERE rn = 1),
g AS (SELECT platform,
    CAST(trunc({WAVG('reach')}) AS BIGINT) AS avg_reach,
    round({WAVG('engagement_rate')}, 4) AS avg_engagement_rate,
    CAST(trunc({WAVG('likes')}) AS BIGINT) AS avg_likes,
    CAST(trunc({WAVG('comments')}) AS BIGINT) AS avg_comments,
    CAST(trunc({WAVG('shares')}) AS BIGINT) AS avg_shares
  FROM posts GROUP BY platform)
SELECT g.*, md.dominant_content_type FROM g JOIN md USING (platform)
WHERE (SELECT count(DISTINCT platform) FROM posts) >= 2
""")

SQL["content_platform_fit"] = _q(f""",
per AS (SELECT content_type, platform, count(*) AS count,
    round({WAVG('engagement_rate')}, 4) AS avg_engagement_rate,
    CAST(trunc({WAVG('reach')}) AS BIGINT) AS avg_reach
  FROM posts GROUP BY content_type, platform),
tn AS (SELECT content_type, sum(count) AS n FROM per GROUP BY content_type),
ok AS (SELECT per.* FROM per JOIN tn USING (content_type) WHERE per.count >= 2 AND tn.n >= 5),
ok2 AS (SELECT *, count(*) OVER (PARTITION BY content_type) AS n_platforms FROM ok)
SELECT content_type, platform, count, avg_engagement_rate, avg_reach, n_platforms,
  first_value(platform) OVER (PARTITION BY content_type ORDER BY avg_engagement_rate DESC, platform) AS best_platform,
  max(avg_engagement_rate) OVER (PARTITION BY content_type) AS best_rate
FROM ok2 WHERE n_platforms >= 2
""")

SQL["meta"] = _q("""
SELECT count(*) AS total_posts, count(DISTINCT platform) AS n_platforms,
  string_agg(DISTINCT platform, ',' ORDER BY platform) AS platforms,
  strftime(min(published_at), '%Y-%m-%d %H:%M:%S') AS earliest,
  strftime(max(published_at), '%Y-%m-%d %H:%M:%S') AS latest
FROM posts
""")

SQL["content_unweighted"] = _q("""
SELECT platform, content_type, round(avg(engagement_rate), 4) AS mean_engagement_rate, count(*) AS count
FROM posts GROUP BY platform, content_type
""")

SQL["mix_unpivot"] = _q(""",
g AS (SELECT platform, CAST(sum(likes) AS BIGINT) AS likes, CAST(sum(comments) AS BIGINT) AS comments,
             CAST(sum(shares) AS BIGINT) AS shares, CAST(sum(saves) AS BIGINT) AS saves FROM posts GROUP BY platform)
SELECT * FROM (UNPIVOT g ON likes, comments, shares, saves INTO NAME metric VALUE total) WHERE total > 0
""")

SQL["cross_platform_table"] = ("SELECT platform, total_posts, total_reach, total_engagement, avg_engagement_rate, "
                               "vs_benchmark, total_followers_gained FROM (" + SQL["platform_overview"] + ") ov")

# ---------------------------------------------------------------------------
# Temporal (T1–T8)
# ---------------------------------------------------------------------------
VALID = """,
tp AS (SELECT platform FROM posts WHERE published_at IS NOT NULL GROUP BY platform HAVING count(DISTINCT hour) > 1),
v AS (SELECT * FROM posts WHERE published_at IS NOT NULL AND platform IN (SELECT platform FROM tp))
"""
DAYS_LIST = "['Monday','Tuesday','Wednesday','Thursday','Friday','Saturday','Sunday']"

SQL["hourly_profile"] = _q(VALID + f""",
g AS (SELECT hour, round({WAVG('engagement_rate')}, 4) AS avg_engagement, round({WAVG('reach')}, 4) AS avg_reach,
             CAST(count(*) AS DOUBLE) AS post_count FROM v GROUP BY hour)
SELECT *, CAST(row_number() OVER (ORDER BY avg_engagement DESC, hour) AS INTEGER) AS rank FROM g
""")

SQL["daily_profile"] = _q(VALID + f""",
g AS (SELECT day_of_week, round({WAVG('engagement_rate')}, 4) AS avg_engagement, round({WAVG('reach')}, 4) AS avg_reach,
             CAST(count(*) AS DOUBLE) AS post_count, CAST(min(dow) AS INTEGER) AS day_ix FROM v GROUP BY day_of_week)
SELECT *, CAST(row_number() OVER (ORDER BY avg_engagement DESC, day_ix) AS INTEGER) AS rank FROM g
""")

SQL["best_times_platform"] = _q(VALID + f""",
big AS (SELECT platform FROM v GROUP BY platform HAVING count(*) >= 5),
vv AS (SELECT * FROM v WHERE platform IN (SELECT platform FROM big)),
h AS (SELECT platform, 'hour' AS kind, CAST(hour AS VARCHAR) AS slot, {WAVG('engagement_rate')} AS score,
             lpad(CAST(hour AS VARCHAR), 2, '0') AS tie FROM vv GROUP BY platform, hour),
d AS (SELECT platform, 'day' AS kind, day_of_week AS slot, {WAVG('engagement_rate')} AS score, day_of_week AS tie
      FROM vv GROUP BY platform, day_of_week),
r AS (SELECT *, row_number() OVER (PARTITION BY platform, kind ORDER BY score DESC, tie) AS rank
      FROM (SELECT * FROM h UNION ALL SELECT * FROM d))
SELECT platform, kind, slot, CAST(rank AS INTEGER) AS rank, round(score, 6) AS score FROM r
WHERE (kind = 'hour' AND rank <= 3) OR (kind = 'day' AND rank <= 2)
""")

SQL["heatmap_pivot"] = _q(VALID + f""",
cell AS (SELECT day_of_week, hour, round({WAVG('engagement_rate')}, 4) AS r FROM v GROUP BY day_of_week, hour)
SELECT day_of_week, {", ".join(f"max(CASE WHEN hour = {h} THEN r END) AS h{h:02d}" for h in range(24))}
FROM cell GROUP BY day_of_week
""")

SCOPED = """,
d AS (SELECT * FROM posts WHERE published_at IS NOT NULL),
s0 AS (SELECT 'ALL' AS scope, * FROM d UNION ALL SELECT platform AS scope, * FROM d),
ok AS (SELECT scope FROM s0 GROUP BY scope HAVING count(*) >= 10),
s AS (SELECT * FROM s0 WHERE scope IN (SELECT scope FROM ok)),
gm AS (SELECT sum(engagement_rate * weight) / sum(weight) AS gmean FROM d),
sl AS (SELECT scope, dow, day_of_week, hour, count(*) AS sample_size,
              sum(engagement_rate * weight) / sum(weight) AS loc
       FROM s GROUP BY scope, dow, day_of_week, hour HAVING count(*) >= 2),
sc AS (SELECT sl.*, least(sample_size / 20.0, 1.0) * loc + (1.0 - least(sample_size / 20.0, 1.0)) * gmean AS score0
       FROM sl CROSS JOIN gm),
ws AS (SELECT scope, day_of_week AS day, dow, CAST(row_number() OVER (PARTITION BY scope, dow ORDER BY score0 DESC, hour) AS INTEGER) AS rank,
              hour, printf('%02d:00', hour) AS time, round(score0, 4) AS score, sample_size FROM sc)
"""

SQL["weekly_schedule"] = _q(SCOPED + "SELECT * FROM ws WHERE rank <= 3")

SQL["schedule_days"] = _q(SCOPED + f""",
days AS (SELECT scope, dow, round(avg(engagement_rate), 4) AS avg_engagement, count(*) AS post_count
         FROM s GROUP BY scope, dow),
slots AS (SELECT scope, dow, least(count(*), 3) AS n_best_hours FROM sl GROUP BY scope, dow),
spine AS (SELECT scope, CAST(unnest(range(0, 7)) AS INTEGER) AS dow FROM ok)
SELECT sp.scope, {DAYS_LIST}[sp.dow + 1] AS day, sp.dow, days.post_count IS NOT NULL AS recommend_posting,
  days.avg_engagement, coalesce(days.post_count, 0) AS post_count,
  CASE WHEN days.post_count IS NULL THEN NULL WHEN slots.n_best_hours IS NULL THEN 'low'
       WHEN days.post_count >= 10 THEN 'high' WHEN days.post_count >= 5 THEN 'medium' ELSE 'low' END AS confidence,
  coalesce(slots.n_best_hours, 0) AS n_best_hours
FROM spine sp LEFT JOIN days ON sp.scope = days.scope AND sp.dow = days.dow
LEFT JOIN slots ON sp.scope = slots.scope AND sp.dow = slots.dow
""")

TOP5 = """,
t5 AS (SELECT * FROM (
  SELECT scope, CAST(row_number() OVER (PARTITION BY scope ORDER BY score DESC, dow, rank) AS INTEGER) AS slot_rank,
         day, dow, hour, time, score FROM ws WHERE rank <= 3) WHERE slot_rank <= 5)
"""

SQL["top5_slots"] = _q(SCOPED + TOP5 + "SELECT * FROM t5")

SQL["avoid_slots"] = _q(SCOPED + """,
sm AS (SELECT scope, avg(engagement_rate) AS m FROM s GROUP BY scope),
g AS (SELECT s.scope, dow, day_of_week, hour, count(*) AS n, avg(engagement_rate) AS r
      FROM s GROUP BY s.scope, dow, day_of_week, hour HAVING count(*) >= 3),
f AS (SELECT g.*, round(r, 4) AS avg_engagement_rate FROM g JOIN sm USING (scope) WHERE r < m * 0.5),
rr AS (SELECT *, CAST(row_number() OVER (PARTITION BY scope ORDER BY avg_engagement_rate, dow, hour) AS INTEGER) AS slot_rank FROM f)
SELECT scope, slot_rank, day_of_week AS day, hour, printf('%02d:00', hour) AS time, avg_engagement_rate
FROM rr WHERE slot_rank <= 5
""")

SQL["next_best_time"] = _q(SCOPED + TOP5 + """,
nw AS (SELECT max(published_at) AS now_ts FROM posts),
c AS (SELECT t5.*, CAST((((dow - (isodow(now_ts) - 1)) % 7) + 7) % 7 AS INTEGER) AS dfn, hour(now_ts) AS nh FROM t5 CROSS JOIN nw),
c2 AS (SELECT *, NOT (dfn = 0 AND hour <= nh) AS okk FROM c),
p AS (SELECT *, row_number() OVER (PARTITION BY scope ORDER BY okk DESC, CASE WHEN okk THEN dfn END, slot_rank) AS rr FROM c2)
SELECT scope, day, time, score, CASE WHEN okk THEN dfn END AS days_from_now FROM p WHERE rr = 1
""")

# ---------------------------------------------------------------------------
# Growth (G1–G12)
# ---------------------------------------------------------------------------
WEEKLY = """,
wk AS (SELECT year_week, CAST(sum(reach) AS BIGINT) AS total_reach, CAST(sum(engagement_total) AS BIGINT) AS total_engagement,
              CAST(sum(followers_gained) AS BIGINT) AS total_followers, count(post_id) AS post_count,
              round(avg(engagement_rate), 4) AS avg_engagement_rate
       FROM posts WHERE published_at IS NOT NULL AND year_week <> 'Unknown' GROUP BY year_week)
"""


def TREND(x: str, y: str) -> str:
    m = f"(CASE WHEN abs(avg({y})) < 1e-10 THEN 1.0 ELSE abs(avg({y})) END)"
    return (f"(CASE WHEN count({y}) < 2 THEN 'insufficient_data' WHEN stddev_pop({y}) < 1e-10 THEN 'stable' "
            f"WHEN regr_slope({y}, {x}) / {m} > 0.05 THEN 'growing' "
            f"WHEN regr_slope({y}, {x}) / {m} < -0.05 THEN 'declining' ELSE 'stable' END)")


def PCT(c: str) -> str:
    prev = f"lag({c}) OVER (ORDER BY year_week)"
    return f"round(CASE WHEN {prev} IS NULL OR {prev} = 0 THEN 0.0 ELSE {c} / CAST({prev} AS DOUBLE) - 1.0 END, 4)"


SQL["weekly_rollup"] = _q(WEEKLY + "SELECT * FROM wk")

SQL["weekly_growth"] = _q(WEEKLY + f"""
SELECT year_week, total_reach, total_engagement, total_followers,
  {PCT('total_reach')} AS reach_growth, {PCT('total_engagement')} AS engagement_growth,
  {PCT('total_followers')} AS followers_growth
FROM wk
""")

SQL["trajectory"] = _q(WEEKLY + f""",
l AS (SELECT *, row_number() OVER (ORDER BY year_week DESC) AS rd FROM wk),
l4 AS (SELECT *, CAST((SELECT count(*) FROM l WHERE rd <= 4) - rd AS DOUBLE) AS x FROM l WHERE rd <= 4)
SELECT CAST(coalesce(trunc(avg(total_reach)), 0) AS BIGINT) AS avg_weekly_reach,
  CAST(coalesce(trunc(avg(total_engagement)), 0) AS BIGINT) AS avg_weekly_engagement,
  CAST(coalesce(trunc(avg(total_followers)), 0) AS BIGINT) AS avg_weekly_followers,
  coalesce(round_even(avg(post_count), 1), 0.0) AS avg_weekly_posts,
  {TREND('x', 'total_reach')} AS reach_trend, {TREND('x', 'total_engagement')} AS engagement_trend,
  {TREND('x', 'total_followers')} AS follower_trend
FROM l4
""")

SQL["platform_growth"] = _q(f""",
pw AS (SELECT platform, year_week, CAST(sum(reach) AS BIGINT) AS reach, CAST(sum(followers_gained) AS BIGINT) AS followers
       FROM posts WHERE published_at IS NOT NULL AND year_week <> 'Unknown' GROUP BY platform, year_week),
tot AS (SELECT platform, count(*) AS n_weeks, CAST(sum(followers) AS BIGINT) AS total_followers_gained,
               arg_max(reach, year_week) AS latest_week_reach FROM pw GROUP BY platform),
l AS (SELECT *, row_number() OVER (PARTITION BY platform ORDER BY year_week DESC) AS rd FROM pw),
l4 AS (SELECT *, CAST(count(*) OVER (PARTITION BY platform) - rd AS DOUBLE) AS x FROM l WHERE rd <= 4),
tr AS (SELECT platform, {TREND('x', 'reach')} AS reach_trend FROM l4 GROUP BY platform)
SELECT tot.platform, latest_week_reach, reach_trend, total_followers_gained, n_weeks
FROM tot JOIN tr USING (platform) WHERE n_weeks >= 2
""")

SQL["trend_label"] = _q(WEEKLY + f""",
x AS (SELECT *, CAST(row_number() OVER (ORDER BY year_week) - 1 AS DOUBLE) AS xx FROM wk),
lg AS (SELECT xx, 'total_reach' AS metric, CAST(total_reach AS DOUBLE) AS value FROM x
       UNION ALL SELECT xx, 'total_engagement', CAST(total_engagement AS DOUBLE) FROM x
       UNION ALL SELECT xx, 'total_followers', CAST(total_followers AS DOUBLE) FROM x
       UNION ALL SELECT xx, 'post_count', CAST(post_count AS DOUBLE) FROM x)
SELECT metric, {TREND('xx', 'value')} AS trend, count(*) AS n_weeks FROM lg GROUP BY metric
""")

SQL["weekly_series_monday"] = _q("""
SELECT CAST(date_trunc('week', ts_kst) AS DATE) AS week_start, CAST(sum(reach) AS BIGINT) AS total_reach,
  CAST(sum(engagement_total) AS BIGINT) AS total_engagement, CAST(sum(followers_gained) AS BIGINT) AS total_followers,
  count(post_id) AS post_count, round(avg(engagement_rate), 4) AS avg_engagement_rate
FROM posts WHERE published_at IS NOT NULL GROUP BY 1
""")

FPARAMS = """,
d AS (SELECT * FROM posts WHERE published_at IS NOT NULL),
s0 AS (SELECT 'ALL' AS scope, * FROM d UNION ALL SELECT platform AS scope, * FROM d),
ok AS (SELECT scope FROM s0 GROUP BY scope HAVING count(*) >= 7),
wk AS (SELECT scope, CAST(date_trunc('week', ts_kst) AS DATE) AS week_start, CAST(sum(reach) AS DOUBLE) AS reach,
              CAST(sum(engagement_total) AS DOUBLE) AS engagement, CAST(sum(followers_gained) AS DOUBLE) AS followers
       FROM s0 WHERE scope IN (SELECT scope FROM ok) GROUP BY 1, 2),
lg AS (SELECT scope, week_start, 'reach' AS metric, reach AS y FROM wk
       UNION ALL SELECT scope, week_start, 'engagement', engagement FROM wk
       UNION ALL SELECT scope, week_start, 'followers', followers FROM wk),
lx AS (SELECT *, CAST(row_number() OVER (PARTITION BY scope, metric ORDER BY week_start) - 1 AS DOUBLE) AS x,
              count(*) OVER (PARTITION BY scope, metric) AS n FROM lg),
g AS (SELECT scope, metric, count(*) AS historical_weeks, regr_slope(y, x) AS sl, regr_intercept(y, x) AS ic,
             avg(y) AS mn, avg(CASE WHEN x >= n - 4 THEN y END) AS ma, max(week_start) AS last_week
      FROM lx GROUP BY scope, metric),
fp AS (SELECT scope, metric, historical_weeks, last_week,
         CASE WHEN historical_weeks >= 3 THEN coalesce(sl, 0.0) ELSE 0.0 END AS slope,
         CASE WHEN historical_weeks >= 3 THEN coalesce(ic, mn) ELSE mn END AS intercept,
         ma AS moving_avg
       FROM g WHERE historical_weeks >= 4)
"""

SQL["forecast_params"] = _q(FPARAMS + """
SELECT scope, metric, historical_weeks, last_week, round(slope, 4) AS slope, round(intercept, 4) AS intercept,
  round(moving_avg, 4) AS moving_avg, CAST(round_even(moving_avg, 0) AS BIGINT) AS current_weekly_avg,
  CASE WHEN slope > 0 THEN 'up' WHEN slope < 0 THEN 'down' ELSE 'flat' END AS trend_direction,
  round(slope / CASE WHEN moving_avg <> 0 THEN moving_avg ELSE 1.0 END, 4) AS weekly_change_rate
FROM fp
""")

FCAST = """,
fc0 AS (SELECT fp.*, CAST(unnest(range(1, 5)) AS INTEGER) AS i FROM fp),
fc AS (SELECT scope, metric, i, CAST(last_week + 7 * i AS DATE) AS week,
         greatest(0.0, 0.6 * (slope * (historical_weeks + i) + intercept) + 0.4 * moving_avg) AS b FROM fc0)
"""

SQL["stat_forecast"] = _q(FPARAMS + FCAST + """
SELECT scope, metric, i, week, CAST(round_even(b, 0) AS BIGINT) AS predicted,
  CAST(round_even(b * 0.8, 0) AS BIGINT) AS lower_bound, CAST(round_even(b * 1.2, 0) AS BIGINT) AS upper_bound
FROM fc
""")

SQL["forecast_summary"] = _q(FPARAMS + FCAST + """,
last AS (SELECT scope, metric, arg_max(CAST(round_even(b, 0) AS BIGINT), i) AS final, count(*) AS k FROM fc GROUP BY 1, 2),
j AS (SELECT fp.*, last.final, last.k,
        (last.final - fp.moving_avg) / (CASE WHEN fp.moving_avg <> 0 THEN fp.moving_avg ELSE 1.0 END) * 100 AS ch
      FROM fp LEFT JOIN last USING (scope, metric))
SELECT scope, metric, CASE WHEN final IS NULL THEN 'Insufficient data for forecast.' ELSE
  'Weekly ' || metric || ' is expected to ' ||
  (CASE WHEN ch > 5 THEN 'increase' WHEN ch < -5 THEN 'decrease' ELSE 'remain stable' END) ||
  ' over the next ' || CAST(k AS VARCHAR) || ' weeks. Current avg: ' || format('{:,.0f}', moving_avg) ||
  ', Projected: ' || format('{:,.0f}', CAST(final AS DOUBLE)) || ' (' || (CASE WHEN ch >= 0 THEN '+' ELSE '' END) ||
  printf('%.1f', ch) || '%).' END AS summary
FROM j
""")

SQL["health"] = _q(FPARAMS + """
SELECT scope, CASE WHEN avg(sign(slope)) > 0.5 THEN 'strong_growth' WHEN avg(sign(slope)) > -0.5 THEN 'stable'
  ELSE 'needs_attention' END AS status, round(avg(sign(slope)), 2) AS signal_score
FROM fp GROUP BY scope
""")

SQL["weekly_dense_90d"] = _q(""",
d AS (SELECT platform, CAST(ts_kst AS DATE) + CAST(7 - isodow(ts_kst) AS INTEGER) AS week_end, reach, engagement_total
      FROM posts WHERE published_at IS NOT NULL),
agg AS (SELECT platform, week_end, CAST(sum(reach) AS BIGINT) AS reach, CAST(sum(engagement_total) AS BIGINT) AS engagement
        FROM d GROUP BY 1, 2),
span AS (SELECT platform, min(week_end) AS a, max(week_end) AS b FROM agg GROUP BY 1),
spine AS (SELECT platform, b, CAST(unnest(generate_series(a, b, INTERVAL 7 DAY)) AS DATE) AS week_end FROM span),
o AS (SELECT s.platform, s.week_end, coalesce(agg.reach, 0) AS reach, coalesce(agg.engagement, 0) AS engagement
      FROM spine s LEFT JOIN agg ON s.platform = agg.platform AND s.week_end = agg.week_end
      WHERE s.week_end >= s.b - 90)
SELECT * FROM o WHERE platform IN (SELECT platform FROM o GROUP BY platform HAVING count(*) >= 2)
""")

# ---------------------------------------------------------------------------
# Scoring and anomalies
# ---------------------------------------------------------------------------
NEWEST = "published_at DESC NULLS LAST, platform, post_id"

SQL["viral_posts"] = _q(f""",
m AS (SELECT platform, avg(engagement_total) AS me FROM posts GROUP BY platform
      HAVING count(*) >= 5 AND avg(engagement_total) <> 0),
c AS (SELECT p.*, m.me FROM posts p JOIN m USING (platform) WHERE engagement_total >= me * 2.5),
r AS (SELECT *, row_number() OVER (PARTITION BY platform ORDER BY {NEWEST}) AS rn FROM c)
SELECT platform, post_id, content_type, engagement_total AS engagement, reach, round(engagement_total / me, 1) AS multiplier,
  strftime(published_at, '%Y-%m-%d %H:%M:%S') AS published_at, permalink FROM r WHERE rn <= 5
""")

SQL["underperformers"] = _q(f""",
m AS (SELECT platform, avg(engagement_total) AS me, avg(reach) AS mr FROM posts GROUP BY platform
      HAVING count(*) >= 5 AND avg(engagement_total) <> 0 AND avg(reach) > 0),
c AS (SELECT p.*, m.me, m.mr FROM posts p JOIN m USING (platform)
      WHERE engagement_total <= me * 0.3 AND reach >= mr * 0.5),
r AS (SELECT *, row_number() OVER (PARTITION BY platform ORDER BY {NEWEST}) AS rn FROM c)
SELECT platform, post_id, content_type, engagement_total AS engagement, reach, round(engagement_rate, 4) AS engagement_rate,
  strftime(published_at, '%Y-%m-%d %H:%M:%S') AS published_at FROM r WHERE rn <= 5
""")

SCORED = """,
raw AS (SELECT *, CAST(reach AS DOUBLE) AS r1, CAST(engagement_total AS DOUBLE) AS r2,
          CAST(likes AS DOUBLE) * 1.0 + CAST(comments AS DOUBLE) * 3.0 + CAST(shares AS DOUBLE) * 5.0
            + CAST(saves AS DOUBLE) * 4.0 + CAST(link_clicks AS DOUBLE) * 2.0 AS r3,
          engagement_rate AS r4, CAST(followers_gained AS DOUBLE) AS r5 FROM posts),
st AS (SELECT min(r1) a1, max(r1) b1, min(r2) a2, max(r2) b2, min(r3) a3, max(r3) b3, min(r4) a4, max(r4) b4,
              min(r5) a5, max(r5) b5, count(*) AS n FROM raw),
nz AS (SELECT raw.*,
  CASE WHEN b1 = a1 THEN 0.5 ELSE (r1 - a1) / (b1 - a1) END AS reach_score,
  CASE WHEN b2 = a2 THEN 0.5 ELSE (r2 - a2) / (b2 - a2) END AS engagement_score,
  CASE WHEN b3 = a3 THEN 0.5 ELSE (r3 - a3) / (b3 - a3) END AS quality_score,
  CASE WHEN b4 = a4 THEN 0.5 ELSE (r4 - a4) / (b4 - a4) END AS efficiency_score,
  CASE WHEN b5 = a5 THEN 0.5 ELSE (r5 - a5) / (b5 - a5) END AS growth_score, st.n
  FROM raw CROSS JOIN st),
sc AS (SELECT *, round((reach_score * 0.2 + engagement_score * 0.25 + quality_score * 0.25 + efficiency_score * 0.2
                        + growth_score * 0.1) * 100, 1) AS composite_score FROM nz WHERE n >= 3),
scored AS (SELECT *, CASE WHEN composite_score >= 70 THEN 'A+' WHEN composite_score >= 55 THEN 'A'
    WHEN composite_score >= 40 THEN 'B+' WHEN composite_score >= 30 THEN 'B' WHEN composite_score >= 20 THEN 'C+'
    WHEN composite_score >= 12 THEN 'C' WHEN composite_score >= 6 THEN 'D' ELSE 'F' END AS grade FROM sc)
"""

SQL["scored_posts"] = _q(SCORED + """
SELECT post_id, platform, content_type, round(reach_score, 6) AS reach_score, round(engagement_score, 6) AS engagement_score,
  round(quality_score, 6) AS quality_score, round(efficiency_score, 6) AS efficiency_score,
  round(growth_score, 6) AS growth_score, composite_score, grade FROM scored
""")

SQL["scores_by_type"] = _q(SCORED + """
SELECT content_type, round(avg(composite_score), 1) AS avg_score, round(quantile_cont(composite_score, 0.5), 1) AS median_score,
  round(max(composite_score), 1) AS best_score, round(min(composite_score), 1) AS worst_score, count(composite_score) AS count
FROM scored GROUP BY content_type
""")

SQL["scores_by_platform"] = _q(SCORED + """
SELECT platform, round(avg(composite_score), 1) AS avg_score, round(max(composite_score), 1) AS best_score,
  count(composite_score) AS count FROM scored GROUP BY platform
""")

SQL["top_scored"] = _q(SCORED + f"""
SELECT CAST(row_number() OVER (ORDER BY composite_score DESC, {NEWEST}) AS INTEGER) AS rank, post_id, platform, content_type,
  composite_score AS score, grade, reach, engagement_total AS engagement,
  strftime(published_at, '%Y-%m-%d %H:%M:%S') AS published_at, permalink
FROM scored ORDER BY composite_score DESC, {NEWEST} LIMIT 10
""")

EXP_STATS = """count(*) AS n, quantile_cont(reach, 0.5) AS reach_med, quantile_cont(engagement_total, 0.5) AS eng_med,
  quantile_cont(engagement_rate, 0.5) AS rate_med, quantile_cont(likes, 0.5) AS likes_med,
  quantile_cont(comments, 0.5) AS comments_med, quantile_cont(shares, 0.5) AS shares_med,
  quantile_cont(reach, 0.25) AS q25, quantile_cont(reach, 0.75) AS q75"""

SQL["expected_performance"] = _q(f""",
pr AS (SELECT content_type, platform, {EXP_STATS} FROM posts GROUP BY content_type, platform),
pl AS (SELECT platform, {EXP_STATS} FROM posts GROUP BY platform),
j AS (SELECT pr.content_type, pr.platform, pr.n >= 3 AS up,
        CASE WHEN pr.n >= 3 THEN pr.n ELSE pl.n END AS n,
        CASE WHEN pr.n >= 3 THEN pr.reach_med ELSE pl.reach_med END AS reach_med,
        CASE WHEN pr.n >= 3 THEN pr.eng_med ELSE pl.eng_med END AS eng_med,
        CASE WHEN pr.n >= 3 THEN pr.rate_med ELSE pl.rate_med END AS rate_med,
        CASE WHEN pr.n >= 3 THEN pr.likes_med ELSE pl.likes_med END AS likes_med,
        CASE WHEN pr.n >= 3 THEN pr.comments_med ELSE pl.comments_med END AS comments_med,
        CASE WHEN pr.n >= 3 THEN pr.shares_med ELSE pl.shares_med END AS shares_med,
        CASE WHEN pr.n >= 3 THEN pr.q25 ELSE pl.q25 END AS q25,
        CASE WHEN pr.n >= 3 THEN pr.q75 ELSE pl.q75 END AS q75
      FROM pr JOIN pl USING (platform))
SELECT content_type, platform, CAST(trunc(reach_med) AS BIGINT) AS expected_reach,
  CAST(trunc(eng_med) AS BIGINT) AS expected_engagement, round(rate_med, 4) AS expected_engagement_rate,
  CAST(trunc(likes_med) AS BIGINT) AS expected_likes, CAST(trunc(comments_med) AS BIGINT) AS expected_comments,
  CAST(trunc(shares_med) AS BIGINT) AS expected_shares, CAST(trunc(q75) AS BIGINT) AS optimistic_reach,
  CAST(trunc(q25) AS BIGINT) AS pessimistic_reach,
  CASE WHEN n >= 20 THEN 'high' WHEN n >= 10 THEN 'medium' ELSE 'low' END AS confidence,
  n AS based_on_posts, CASE WHEN up THEN 'content_type' ELSE 'platform' END AS basis
FROM j WHERE n >= 3
""")

SQL["seasonal_index"] = _q(FPARAMS.replace("fp AS (", "fp_unused AS (") + """,
nn AS (SELECT scope, metric, count(*) AS n, avg(y) AS m FROM lg GROUP BY 1, 2),
wy AS (SELECT scope, metric, CAST(week(week_start) AS INTEGER) AS woy, avg(y) AS wm FROM lg GROUP BY 1, 2, 3)
SELECT wy.scope, wy.metric, woy, round(wm / CASE WHEN m <> 0 THEN m END, 4) AS seasonal_index
FROM wy JOIN nn USING (scope, metric) WHERE n >= 52
""")

# ---------------------------------------------------------------------------
# Account daily (A1–A9, J2, J3, F5, F6), history
# ---------------------------------------------------------------------------
SERIES = """
WITH ev AS (
  SELECT CAST(ts AS DATE) AS date, user_id,
    CASE WHEN CAST(floor(user_id / 7) AS BIGINT) % 2 = 0 THEN 'instagram' ELSE 'tiktok' END AS platform,
    CASE event_type WHEN 'view' THEN 'views' WHEN 'signup' THEN 'follows' WHEN 'click' THEN 'interactions'
      WHEN 'purchase' THEN 'link_clicks' WHEN 'error' THEN 'visits' END AS metric,
    CAST(CASE WHEN event_type = 'view' THEN floor(value) ELSE 1 END AS BIGINT) AS v
  FROM events),
series AS (
  SELECT platform, metric, date, CAST(sum(v) AS BIGINT) AS value FROM ev WHERE metric IS NOT NULL GROUP BY platform, metric, date
  UNION ALL SELECT platform, 'reach', date, count(DISTINCT user_id) FROM ev GROUP BY platform, date)
"""
METRIC_COLS = ["follows", "interactions", "link_clicks", "views", "visits", "reach"]


def DENSE(src: str, name: str) -> str:
    pv = ", ".join(f"sum(CASE WHEN metric = '{m}' THEN value END) AS {m}" for m in METRIC_COLS)
    co = ", ".join(f"CAST(coalesce(w.{m}, 0) AS BIGINT) AS {m}" for m in METRIC_COLS)
    return f""",
{name}_span AS (SELECT platform, min(date) AS lo, max(date) AS hi FROM {src} GROUP BY platform),
{name}_spine AS (SELECT platform, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date FROM {name}_span),
{name}_wide AS (SELECT platform, date, {pv} FROM {src} GROUP BY platform, date),
{name} AS (SELECT s.platform, s.date, {co} FROM {name}_spine s LEFT JOIN {name}_wide w
           ON s.platform = w.platform AND s.date = w.date)
"""


ROLL = ", ".join(f"round_even(avg({c}) OVER w7, 1) AS {c}_7d_avg" for c in ["follows", "reach", "views", "interactions", "visits"])
DAILY = SERIES + DENSE("series", "dense") + f""",
daily AS (
  SELECT *, CAST(sum(follows) OVER (PARTITION BY platform ORDER BY date ROWS UNBOUNDED PRECEDING) AS BIGINT) AS follower_count,
    CASE WHEN reach > 0 THEN round(interactions / reach, 4) ELSE 0.0 END AS engagement_rate_daily,
    {ROLL}, CAST(week(date) AS INTEGER) AS week, strftime(date, '%Y-W%U') AS year_week
  FROM dense WINDOW w7 AS (PARTITION BY platform ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW))
"""

SQL["account_daily_dense"] = SERIES + DENSE("series", "dense") + "SELECT * FROM dense"
SQL["account_rate"] = DAILY + "SELECT platform, date, engagement_rate_daily FROM daily"
SQL["rolling_7d"] = DAILY + ("SELECT platform, date, follows_7d_avg, reach_7d_avg, views_7d_avg, interactions_7d_avg, "
                             "visits_7d_avg FROM daily")
SQL["week_columns"] = DAILY + "SELECT platform, date, week, year_week FROM daily"

SQL["trim_nonzero"] = DAILY + """,
c AS (SELECT daily.* FROM daily JOIN (SELECT platform, max(date) AS l FROM daily GROUP BY platform) m USING (platform)
      WHERE date >= l - 90),
sm AS (SELECT platform, sum(reach) sr, sum(views) sv, sum(follows) sf, sum(interactions) si, sum(visits) svi,
              sum(follower_count) sfc FROM c GROUP BY platform),
nz AS (SELECT c.*, (sr > 0 AND reach <> 0) OR (sv > 0 AND views <> 0) OR (sf > 0 AND follows <> 0)
                 OR (si > 0 AND interactions <> 0) OR (svi > 0 AND visits <> 0) OR (sfc > 0 AND follower_count <> 0) AS nzf
       FROM c JOIN sm USING (platform)),
b AS (SELECT platform, min(CASE WHEN nzf THEN date END) AS a, max(CASE WHEN nzf THEN date END) AS bb FROM nz GROUP BY platform)
SELECT nz.platform, date, reach, views, follows, follower_count FROM nz JOIN b USING (platform)
WHERE a IS NULL OR date BETWEEN a AND bb
"""

SQL["account_kpis"] = DAILY + """
SELECT platform, CAST(sum(reach) AS BIGINT) AS total_reach, CAST(sum(views) AS BIGINT) AS total_views,
  CAST(sum(follows) AS BIGINT) AS total_follows, CAST(sum(interactions) AS BIGINT) AS total_interactions,
  CAST(sum(visits) AS BIGINT) AS total_visits, CAST(sum(link_clicks) AS BIGINT) AS total_link_clicks,
  arg_max(follower_count, date) FILTER (WHERE follower_count > 0) AS follower_count, count(*) AS days
FROM daily GROUP BY platform
"""

SQL["followers_fallback"] = POSTS + DAILY.replace("\nWITH ev AS (", ",\nev AS (", 1) + """,
p AS (SELECT platform, CAST(sum(followers_gained) AS BIGINT) AS pf FROM posts GROUP BY platform),
dd AS (SELECT platform, CAST(sum(follows) AS BIGINT) AS df FROM daily GROUP BY platform)
SELECT coalesce(p.platform, dd.platform) AS platform,
  CASE WHEN coalesce(pf, 0) > 0 THEN pf WHEN df IS NOT NULL THEN df ELSE coalesce(pf, 0) END AS followers_gained,
  CASE WHEN coalesce(pf, 0) > 0 THEN 'posts' WHEN df IS NOT NULL THEN 'account_daily' ELSE 'posts' END AS source
FROM p FULL OUTER JOIN dd ON p.platform = dd.platform
"""

SQL["combine_first"] = DAILY + """,
r AS (SELECT *, CASE platform WHEN 'instagram' THEN 1 WHEN 'tiktok' THEN 2 ELSE 3 END AS rk FROM daily)
SELECT date, arg_min(views, rk) FILTER (WHERE views IS NOT NULL) AS views,
  arg_min(reach, rk) FILTER (WHERE reach IS NOT NULL) AS reach,
  arg_min(follows, rk) FILTER (WHERE follows IS NOT NULL) AS follows,
  arg_min(follower_count, rk) FILTER (WHERE follower_count IS NOT NULL) AS follower_count
FROM r GROUP BY date
"""

SQL["hourly_activity"] = """
WITH per AS (
  SELECT CASE WHEN CAST(floor(user_id / 7) AS BIGINT) % 2 = 0 THEN 'instagram' ELSE 'tiktok' END AS platform,
    CAST(ts AS DATE) AS date, CAST(hour(ts) AS INTEGER) AS hour, count(DISTINCT user_id) AS active
  FROM events GROUP BY 1, 2, 3),
h AS (SELECT platform, hour, CAST(round_even(avg(active), 0) AS BIGINT) AS avg_active FROM per GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY platform ORDER BY avg_active DESC, hour) AS rr FROM h)
SELECT platform, hour, avg_active, CASE WHEN rr <= 3 THEN CAST(rr AS INTEGER) END AS peak_rank FROM r
WHERE avg_active > 0 OR rr <= 3
"""

SQL["upsert_daily"] = SERIES + """,
sp AS (SELECT min(date) AS lo, max(date) AS hi FROM series),
md AS (SELECT CAST(lo + CAST(trunc(datediff('day', lo, hi) / 2) AS INTEGER) AS DATE) AS mid FROM sp),
s1 AS (SELECT series.* FROM series CROSS JOIN md WHERE date < mid + 7),
s2 AS (SELECT series.* FROM series CROSS JOIN md WHERE date >= mid)
""" + DENSE("s1", "e1") + DENSE("s2", "e2") + """,
u AS (SELECT *, 0 AS src FROM e1 UNION ALL SELECT *, 1 AS src FROM e2),
r AS (SELECT *, row_number() OVER (PARTITION BY platform, date ORDER BY src DESC) AS rn FROM u)
SELECT platform, date, follows, interactions, link_clicks, views, visits, reach FROM r WHERE rn = 1
"""

SQL["upsert_posts"] = POSTS + """,
nw AS (SELECT max(published_at) AS now_ts FROM raw_posts),
hist AS (SELECT r.*, TIMESTAMP '2020-01-01 00:00:00' AS ing, 0 AS src FROM raw_posts r CROSS JOIN nw
         WHERE published_at IS NULL OR published_at < now_ts - INTERVAL 30 DAY),
nb0 AS (SELECT r.* REPLACE (likes + 1 AS likes) FROM raw_posts r CROSS JOIN nw WHERE published_at >= now_ts - INTERVAL 120 DAY),
nb AS (SELECT nb0.* REPLACE (likes + comments + shares + saves AS engagement_total,
         least(CASE WHEN reach > 0 THEN CAST(likes + comments + shares + saves AS DOUBLE) / reach ELSE 0.0 END, 1.0) AS engagement_rate),
         TIMESTAMP '2026-01-01 00:00:00' AS ing, 1 AS src FROM nb0),
u AS (SELECT * FROM hist UNION ALL BY NAME SELECT * FROM nb),
r AS (SELECT *, row_number() OVER (PARTITION BY platform, post_id ORDER BY ing DESC, src DESC) AS rn FROM u)
SELECT post_id, platform, likes, engagement_total, round(engagement_rate, 6) AS engagement_rate,
  strftime(ing, '%Y-%m-%d %H:%M:%S') AS ingested_at FROM r WHERE rn = 1
"""

SQL["cleanup_posts"] = POSTS + """
SELECT post_id, platform, likes + comments + shares + saves AS engagement_total,
  round(least(CASE WHEN reach > 0 THEN CAST(likes + comments + shares + saves AS DOUBLE) / reach ELSE 0.0 END, 1.0), 6) AS engagement_rate,
  CAST(length(coalesce(title, '')) AS INTEGER) AS title_chars
FROM raw_posts
WHERE published_at IS NULL OR published_at >= (CASE platform WHEN 'instagram' THEN TIMESTAMP '1996-01-01'
  WHEN 'tiktok' THEN TIMESTAMP '1997-06-01' WHEN 'youtube' THEN TIMESTAMP '1995-01-01'
  WHEN 'facebook' THEN TIMESTAMP '1995-01-01' END) - INTERVAL 9 HOUR
"""

SQL["cleanup_negative"] = POSTS + """
SELECT post_id, platform, greatest(likes - 60, 0) AS likes, greatest(reach - 400, 0) AS reach,
  greatest(likes + comments + shares + saves - 60, 0) AS engagement_total, followers_gained - 5 AS followers_gained,
  link_clicks - 1 AS link_clicks,
  round(least(CASE WHEN reach > 400 THEN CAST(greatest(likes + comments + shares + saves - 60, 0) AS DOUBLE) / (reach - 400) ELSE 0.0 END, 1.0), 6) AS engagement_rate
FROM raw_posts
"""

SQL["union_missing_cols"] = POSTS + """
SELECT post_id, platform, reach, likes, comments,
  CASE WHEN platform IN ('instagram', 'facebook', 'tiktok') THEN shares ELSE 0 END AS shares,
  CASE WHEN platform = 'instagram' THEN saves ELSE 0 END AS saves,
  CASE WHEN platform = 'youtube' THEN watch_time_sec ELSE 0 END AS watch_time_sec,
  CASE WHEN platform = 'facebook' THEN link_clicks ELSE 0 END AS link_clicks
FROM raw_posts
"""

# ---------------------------------------------------------------------------
# Text and trend analytics
# ---------------------------------------------------------------------------
from pulsekit.operators.text import GREEK_STOP_WORDS, KOREAN_STOP_WORDS, NOISE_TERMS, strip_accents_py  # noqa: E402

# The English stop words.
ENGLISH_STOP_WORDS = """
    i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her hers
    herself it its itself they them their theirs themselves what which who whom this that these those am is
    are was were be been being have has had having do does did doing a an the and but if or because as until
    while of at by for with about against between into through during before after above below to from up down
    in out on off over under again further then once here there when where why how all any both each few more
    most other some such no nor not only own same so than too very s t can will just don should now i'll
    you'll he'll she'll we'll they'll i'd you'd he'd she'd we'd they'd i'm you're he's she's it's we're
    they're i've we've you've they've isn't aren't wasn't weren't haven't hasn't hadn't don't doesn't didn't
    won't wouldn't shan't shouldn't mustn't can't couldn't cannot could here's how's let's ought that's
    there's what's when's where's who's why's would
""".split()
STOP_WORDS = sorted({strip_accents_py(w) for w in [*ENGLISH_STOP_WORDS, *GREEK_STOP_WORDS, *KOREAN_STOP_WORDS]} | set(NOISE_TERMS))


def _sql_list(words) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


FEATS = """,
feat AS (SELECT post_id, platform, content_type,
  coalesce(CAST(hour(ts_kst) AS INTEGER), 0) AS hour, coalesce(CAST(isodow(ts_kst) - 1 AS INTEGER), 0) AS day_of_week,
  CASE WHEN coalesce(isodow(ts_kst) - 1, 0) >= 5 THEN 1 ELSE 0 END AS is_weekend,
  CAST(length(coalesce(title, '')) AS INTEGER) AS caption_length,
  CAST(len(regexp_extract_all(coalesce(title, ''), '#[\\p{L}\\p{N}_]+')) AS INTEGER) AS hashtag_count,
  CASE WHEN regexp_matches(coalesce(title, ''), '[\\x{1F600}-\\x{1F9FF}\\x{2600}-\\x{27BF}\\x{1F300}-\\x{1F5FF}]') THEN 1 ELSE 0 END AS has_emoji,
  CASE WHEN regexp_matches(coalesce(title, ''), '[\\x{AC00}-\\x{D7AF}]') AND regexp_matches(coalesce(title, ''), '[a-zA-Z]') THEN 1 ELSE 0 END AS is_multilingual,
  coalesce(duration_sec, 0) AS duration_sec, engagement_rate, weight, published_at
  FROM posts)
"""

SQL["post_features"] = _q(FEATS + """
SELECT post_id, platform, content_type, hour, day_of_week, is_weekend, caption_length, hashtag_count, has_emoji,
  is_multilingual, duration_sec, round(engagement_rate, 6) AS engagement_rate, weight FROM feat
""")

SQL["term_lift"] = _q(f""",
valid AS (SELECT platform, post_id, engagement_rate, lower(strip_accents(title)) AS t
          FROM posts WHERE length(coalesce(title, '')) > 10),
tot AS (SELECT platform, count(*) AS n_valid, sum(engagement_rate) AS sum_rate FROM valid GROUP BY platform HAVING count(*) >= 5),
tk AS (SELECT platform, post_id, engagement_rate, unnest(regexp_extract_all(t, '[\\p{{L}}\\p{{N}}_]{{3,}}')) AS term FROM valid),
tk2 AS (SELECT * FROM tk WHERE term NOT IN ({_sql_list(STOP_WORDS)})),
tf AS (SELECT platform, term, count(*) AS tf FROM tk2 GROUP BY platform, term),
dq AS (SELECT platform, term, count(*) AS posts_with_term, sum(engagement_rate) AS sw
       FROM (SELECT DISTINCT platform, post_id, engagement_rate, term FROM tk2) GROUP BY platform, term),
cand AS (SELECT dq.*, tf.tf FROM dq JOIN tf USING (platform, term) WHERE posts_with_term >= 2),
top AS (SELECT *, CAST(row_number() OVER (PARTITION BY platform ORDER BY tf DESC, term) AS INTEGER) AS tf_rank FROM cand),
j AS (SELECT top.*, tot.n_valid, tot.sum_rate, sw / posts_with_term AS wm,
        (sum_rate - sw) / CASE WHEN n_valid - posts_with_term > 0 THEN n_valid - posts_with_term END AS wom
      FROM top JOIN tot USING (platform) WHERE tf_rank <= 50),
r AS (SELECT platform, term, posts_with_term, tf, tf_rank, round(wm, 4) AS avg_engagement_with,
        round(wom, 4) AS avg_engagement_without, round(CASE WHEN wom > 0 THEN wm / wom - 1 ELSE 0.0 END, 4) AS engagement_lift FROM j)
SELECT *, CAST(row_number() OVER (PARTITION BY platform ORDER BY engagement_lift DESC, term) AS INTEGER) AS lift_rank,
  CAST(row_number() OVER (PARTITION BY platform ORDER BY engagement_lift ASC, term) AS INTEGER) AS low_rank,
  starts_with(term, '#') AS is_hashtag
FROM r
""")

SQL["driver_corr"] = _q(FEATS + """,
n AS (SELECT platform, count(*) AS n FROM feat GROUP BY platform),
rk AS (SELECT feat.*, n.n, row_number() OVER (PARTITION BY feat.platform ORDER BY engagement_rate DESC,
         published_at DESC NULLS LAST, feat.platform, post_id) AS r FROM feat JOIN n USING (platform)),
topk AS (SELECT platform, quantile_cont(caption_length, 0.5) AS ol, quantile_cont(hashtag_count, 0.5) AS ot
         FROM rk WHERE r <= least(5, CAST(floor(n / 3) AS BIGINT)) GROUP BY platform),
g AS (SELECT platform, count(*) AS n, corr(CAST(caption_length AS DOUBLE), engagement_rate) AS cl,
        corr(CAST(hashtag_count AS DOUBLE), engagement_rate) AS ct, sum(hashtag_count) AS tags FROM feat GROUP BY platform)
SELECT g.platform, round(cl, 4) AS length_correlation,
  CASE WHEN cl > 0.1 THEN 'longer is better' WHEN cl < -0.1 THEN 'shorter is better' ELSE 'no strong effect' END AS length_direction,
  printf('%d-%d characters', CAST(trunc(ol * 0.7) AS BIGINT), CAST(trunc(ol * 1.3) AS BIGINT)) AS optimal_range,
  CASE WHEN tags > 0 THEN round(ct, 4) END AS hashtag_correlation,
  CASE WHEN tags > 0 THEN CASE WHEN ct > 0.1 THEN 'more is better' WHEN ct < -0.1 THEN 'fewer is better' ELSE 'no strong effect' END END AS hashtag_direction,
  CASE WHEN tags > 0 THEN CAST(trunc(ot) AS BIGINT) END AS optimal_hashtags
FROM g LEFT JOIN topk USING (platform) WHERE g.n >= 10
""")

SQL["driver_lift"] = _q(FEATS + """,
lg AS (SELECT platform, engagement_rate, weight, 'is_multilingual' AS factor, is_multilingual AS "on" FROM feat
       UNION ALL SELECT platform, engagement_rate, weight, 'has_emoji', has_emoji FROM feat
       UNION ALL SELECT platform, engagement_rate, weight, 'is_weekend', is_weekend FROM feat),
g AS (SELECT platform, factor, CAST(sum("on") AS BIGINT) AS n_on, CAST(sum(1 - "on") AS BIGINT) AS n_off,
        sum(CASE WHEN "on" = 1 THEN engagement_rate * weight END) / sum(CASE WHEN "on" = 1 THEN weight END) AS wi,
        sum(CASE WHEN "on" = 0 THEN engagement_rate * weight END) / sum(CASE WHEN "on" = 0 THEN weight END) AS wo
      FROM lg GROUP BY platform, factor)
SELECT platform, factor, n_on, n_off, round(wi, 4) AS with_avg, round(wo, 4) AS without_avg,
  round(CASE WHEN wo > 0 THEN wi / wo - 1 ELSE 0.0 END, 4) AS lift,
  CASE WHEN factor = 'is_weekend' THEN (CASE WHEN wi > wo * 1.05 THEN 'weekend' WHEN wo > wi * 1.05 THEN 'weekday' ELSE 'no difference' END)
       WHEN factor = 'is_multilingual' THEN (CASE WHEN wi > wo * 1.1 THEN 'Multilingual captions perform better'
         WHEN wo > wi * 1.1 THEN 'Single-language captions perform better' ELSE 'No significant difference' END) END AS label
FROM g WHERE n_on >= 2 AND n_off >= 2
""")

SQL["hashtag_perf"] = _q(""",
tg AS (SELECT platform, engagement_rate, unnest(regexp_extract_all(coalesce(title, ''), '#([\\p{L}\\p{N}_]{2,})', 1)) AS tag FROM posts),
g AS (SELECT platform, '#' || lower(tag) AS tag, count(*) AS post_count, round(avg(engagement_rate), 4) AS avg_engagement
      FROM tg GROUP BY platform, '#' || lower(tag) HAVING count(*) >= 2),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY platform ORDER BY avg_engagement DESC, tag) AS INTEGER) AS rank FROM g)
SELECT * FROM r WHERE rank <= 10
""")

DATED15 = """,
dd AS (SELECT * FROM posts WHERE published_at IS NOT NULL),
dp AS (SELECT * FROM dd WHERE platform IN (SELECT platform FROM dd GROUP BY platform HAVING count(*) >= {n}))
"""

SQL["content_fatigue"] = _q(DATED15.format(n=15) + """,
info AS (SELECT platform, content_type, count(*) AS n, min(published_at) AS t0 FROM dp GROUP BY 1, 2 HAVING count(*) >= 5),
m AS (SELECT dp.*, info.t0, info.n,
        row_number() OVER (PARTITION BY dp.platform, dp.content_type ORDER BY published_at, post_id) <= info.n // 2 AS first_half,
        (epoch_us(published_at) - epoch_us(info.t0)) / 86400e6 AS x
      FROM dp JOIN info USING (platform, content_type)),
g AS (SELECT platform, content_type, count(*) AS post_count, sum(weight) AS sw, sum(weight * x) AS swx,
        sum(weight * engagement_rate) AS swy, sum(weight * x * x) AS swxx, sum(weight * x * engagement_rate) AS swxy,
        avg(CASE WHEN first_half THEN engagement_rate END) AS older, avg(CASE WHEN NOT first_half THEN engagement_rate END) AS recent
      FROM m GROUP BY 1, 2),
s AS (SELECT *, CASE WHEN (swxx - swx * swx / sw) = 0 THEN 0.0 ELSE (swxy - swx * swy / sw) / (swxx - swx * swx / sw) END * 30 AS mc FROM g),
o AS (SELECT platform, content_type, post_count,
  CASE WHEN mc < -0.01 THEN 'declining' WHEN mc > 0.01 THEN 'growing' ELSE 'stable' END AS trend,
  CASE WHEN mc < -0.01 THEN (CASE WHEN mc < -0.03 THEN 'high' ELSE 'medium' END) WHEN mc > 0.01 THEN 'positive' ELSE 'none' END AS severity,
  round(mc * 100, 2) AS monthly_change_pct, round(older, 4) AS older_avg_rate, round(recent, 4) AS recent_avg_rate,
  CASE WHEN older > 0 THEN round((recent / older - 1) * 100, 1) ELSE 0.0 END AS change_pct FROM s)
SELECT *, CAST(CASE severity WHEN 'high' THEN 0 WHEN 'medium' THEN 1 WHEN 'none' THEN 2 WHEN 'positive' THEN 3 END AS INTEGER) AS severity_rank FROM o
""")

CADENCE = DATED15.format(n=15) + """,
wk AS (SELECT platform, CAST(date_trunc('week', published_at) AS DATE) AS week_start, count(post_id) AS post_count,
         avg(engagement_rate) AS avg_engagement, sum(reach) AS total_reach, sum(engagement_total) AS total_engagement
       FROM dp GROUP BY 1, 2),
wk2 AS (SELECT * FROM wk WHERE platform IN (SELECT platform FROM wk GROUP BY platform HAVING count(*) >= 4)),
cad AS (SELECT platform, post_count AS posts_per_week, count(*) AS weeks_observed,
          round(avg(avg_engagement), 4) AS avg_engagement_rate, CAST(trunc(avg(total_reach)) AS BIGINT) AS avg_total_reach,
          CAST(trunc(avg(total_engagement)) AS BIGINT) AS avg_total_engagement FROM wk2 GROUP BY 1, 2)
"""

SQL["posting_cadence"] = _q(CADENCE + "SELECT * FROM cad")

SQL["cadence_summary"] = _q(CADENCE + """,
rel AS (SELECT platform, max(CASE WHEN weeks_observed >= 2 THEN 1 ELSE 0 END) AS hr FROM cad GROUP BY platform),
c AS (SELECT cad.* FROM cad JOIN rel USING (platform) WHERE hr = 0 OR weeks_observed >= 2),
bst AS (SELECT platform,
        arg_min(posts_per_week, (-avg_engagement_rate, posts_per_week)) AS optimal_for_engagement,
        max(avg_engagement_rate) AS optimal_engagement_rate,
        arg_min(posts_per_week, (-avg_total_reach, posts_per_week)) AS optimal_for_reach,
        max(avg_total_reach) AS optimal_total_reach FROM c GROUP BY platform),
l AS (SELECT platform, post_count AS n, row_number() OVER (PARTITION BY platform ORDER BY week_start DESC) AS r FROM wk),
cur AS (SELECT platform, round_even(avg(n), 1) AS current_cadence FROM l WHERE r <= 4 GROUP BY platform)
SELECT bst.*, current_cadence,
  CASE WHEN abs(optimal_for_engagement - current_cadence) < 0.5 THEN
         printf('Your current pace (~%d/week) is close to optimal (%d/week). Maintain it.', CAST(round_even(current_cadence, 0) AS BIGINT), optimal_for_engagement)
       WHEN optimal_for_engagement - current_cadence > 0 THEN
         printf('Consider posting more: %d/week is optimal, you''re averaging %d/week.', optimal_for_engagement, CAST(round_even(current_cadence, 0) AS BIGINT))
       ELSE printf('Consider posting less: %d/week is optimal, you''re averaging %d/week. Quality over quantity.', optimal_for_engagement, CAST(round_even(current_cadence, 0) AS BIGINT))
  END AS recommendation
FROM bst JOIN cur USING (platform)
""")

SQL["momentum"] = _q(DATED15.format(n=10) + """,
nw AS (SELECT platform, max(published_at) AS nt FROM dp GROUP BY platform),
d2 AS (SELECT dp.*, published_at >= nt - INTERVAL 30 DAY AS l,
         published_at >= nt - INTERVAL 60 DAY AND published_at < nt - INTERVAL 30 DAY AS p,
         shares + saves + comments AS q FROM dp JOIN nw USING (platform)),
g AS (SELECT platform, CAST(sum(CASE WHEN l THEN 1 ELSE 0 END) AS BIGINT) AS recent_30d_posts,
        CAST(sum(CASE WHEN p THEN 1 ELSE 0 END) AS BIGINT) AS prev_30d_posts,
        avg(CASE WHEN l THEN engagement_rate END) AS re, avg(CASE WHEN p THEN engagement_rate END) AS pe,
        avg(CASE WHEN l THEN reach END) AS rr, avg(CASE WHEN p THEN reach END) AS pr,
        avg(CASE WHEN l THEN q END) AS rq, avg(CASE WHEN p THEN q END) AS pq FROM d2 GROUP BY platform),
wk AS (SELECT platform, date_trunc('week', published_at) AS w, count(*) AS n FROM dp GROUP BY 1, 2),
l4 AS (SELECT platform, count(*) AS nw4, stddev_samp(n) AS sd, avg(n) AS m, min(n) AS mn FROM (
         SELECT *, row_number() OVER (PARTITION BY platform ORDER BY w DESC) AS r FROM wk) WHERE r <= 4 GROUP BY platform),
aw AS (SELECT platform, count(*) AS weeks FROM wk GROUP BY platform),
j AS (SELECT g.*, l4.*, aw.weeks, recent_30d_posts >= 3 AND prev_30d_posts >= 3 AS both_ok
      FROM g JOIN l4 USING (platform) JOIN aw USING (platform)),
s AS (SELECT platform, recent_30d_posts, prev_30d_posts, re, pe,
  CASE WHEN both_ok THEN least(25.0, greatest(0.0, ((CASE WHEN pe > 0 THEN re / pe ELSE 1.0 END) - 0.5) * 50)) ELSE 12.5 END AS e,
  CASE WHEN weeks >= 4 THEN (CASE WHEN mn > 0 THEN least(25.0, greatest(0.0, least(25.0, (1.0 - CASE WHEN m > 0 THEN sd / m ELSE 1.0 END) * 25)) + 5)
        ELSE greatest(0.0, least(25.0, (1.0 - CASE WHEN m > 0 THEN sd / m ELSE 1.0 END) * 25)) END) ELSE 10.0 END AS c,
  CASE WHEN both_ok THEN least(25.0, greatest(0.0, ((CASE WHEN pr > 0 THEN rr / pr ELSE 1.0 END) - 0.5) * 50)) ELSE 12.5 END AS r,
  CASE WHEN both_ok THEN least(25.0, greatest(0.0, ((CASE WHEN pq > 0 THEN rq / pq ELSE 1.0 END) - 0.5) * 50)) ELSE 12.5 END AS qs
  FROM j)
SELECT platform, round_even(e + c + r + qs, 1) AS total_score,
  CASE WHEN round_even(e + c + r + qs, 1) >= 75 THEN 'Strong momentum — your content strategy is accelerating'
       WHEN round_even(e + c + r + qs, 1) >= 55 THEN 'Good momentum — steady growth, look for opportunities to push harder'
       WHEN round_even(e + c + r + qs, 1) >= 35 THEN 'Moderate momentum — stable but not accelerating, consider experimenting'
       WHEN round_even(e + c + r + qs, 1) >= 20 THEN 'Low momentum — engagement or reach may be stalling'
       ELSE 'Warning — multiple signals declining, review content strategy' END AS verdict,
  round_even(e, 1) AS engagement_trend, round_even(c, 1) AS posting_consistency, round_even(r, 1) AS reach_growth,
  round_even(qs, 1) AS content_quality, recent_30d_posts, prev_30d_posts,
  coalesce(round(re, 4), 0.0) AS recent_avg_engagement, coalesce(round(pe, 4), 0.0) AS prev_avg_engagement
FROM s
""")

# ---------------------------------------------------------------------------
# Similar-post prediction (J5 / M18): exact all-pairs in SQL
# ---------------------------------------------------------------------------
SIM = """,
e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
pe0 AS (SELECT p.platform, p.post_id, p.engagement_rate, p.published_at, CAST(p.post_id AS BIGINT) % (SELECT max(vec_id) + 1 FROM e) AS vec_id
        FROM posts p),
pe AS (SELECT * FROM pe0 WHERE platform IN (SELECT platform FROM pe0 GROUP BY platform HAVING count(*) >= 10)),
pv AS (SELECT platform, vec_id, v, count(*) AS n, min(post_id) AS first_id FROM pe JOIN e USING (vec_id) GROUP BY platform, vec_id, v),
vs AS (SELECT a.platform, a.vec_id AS a, b.vec_id AS b, b.first_id, round(list_cosine_similarity(a.v, b.v), 9) AS sim,
         a.n * (b.n - CASE WHEN a.vec_id = b.vec_id THEN 1 ELSE 0 END) AS pairs
       FROM pv a JOIN pv b USING (platform)),
near AS (SELECT * FROM vs QUALIFY row_number() OVER (PARTITION BY platform, a ORDER BY sim DESC, first_id) <= 6),
mem AS (SELECT platform, vec_id, post_id, engagement_rate FROM pe QUALIFY row_number() OVER (PARTITION BY platform, vec_id ORDER BY post_id) <= 6),
pr AS (SELECT p.platform, p.post_id, m.post_id AS nb, near.sim, m.engagement_rate AS nr
       FROM pe p JOIN near ON near.platform = p.platform AND near.a = p.vec_id
       JOIN mem m ON m.platform = p.platform AND m.vec_id = near.b AND m.post_id <> p.post_id),
rk AS (SELECT *, row_number() OVER (PARTITION BY platform, post_id ORDER BY sim DESC, nb) AS r FROM pr),
pred AS (SELECT platform, post_id, sum(sim * nr) AS swr, sum(sim) AS ss, avg(nr) AS m, max(sim) AS top, count(*) AS n_neighbors
         FROM rk WHERE r <= 5 GROUP BY platform, post_id),
sp AS (SELECT pe.platform, pe.post_id, round(engagement_rate, 4) AS actual_rate,
         round(CASE WHEN ss > 0 THEN swr / ss ELSE m END, 4) AS predicted_rate,
         round(engagement_rate - CASE WHEN ss > 0 THEN swr / ss ELSE m END, 4) + 0.0::DOUBLE AS error,
         round(top, 3) AS top_similarity, n_neighbors, strftime(published_at, '%Y-%m-%d %H:%M:%S') AS published_at
       FROM pe JOIN pred USING (platform, post_id))
"""

SQL["similar_posts"] = _q(SIM + "SELECT * FROM sp")

SQL["similar_ranked"] = _q(SIM + """,
r2 AS (SELECT *, row_number() OVER (PARTITION BY platform ORDER BY abs(error) ASC, post_id) AS a,
              row_number() OVER (PARTITION BY platform ORDER BY abs(error) DESC, post_id DESC) AS b FROM sp)
SELECT platform, post_id, actual_rate, predicted_rate, error,
  CASE WHEN a <= 3 THEN CAST(a AS INTEGER) END AS predictable_rank, CASE WHEN b <= 3 THEN CAST(b AS INTEGER) END AS surprising_rank
FROM r2 WHERE a <= 3 OR b <= 3
""")

SQL["similar_summary"] = _q(SIM + """,
mae AS (SELECT platform, count(*) AS n_posts, round(avg(abs(error)), 4) AS mean_absolute_error FROM sp GROUP BY platform),
cu AS (SELECT platform, sim, sum(pairs) OVER (PARTITION BY platform ORDER BY sim RANGE UNBOUNDED PRECEDING) AS upto,
         sum(pairs) OVER (PARTITION BY platform) AS total FROM vs WHERE sim > 0 AND pairs > 0),
md AS (SELECT platform, round((min(sim) FILTER (upto >= (total + 1) // 2) + min(sim) FILTER (upto >= total // 2 + 1)) / 2, 3) AS median_similarity
       FROM cu GROUP BY platform)
SELECT mae.*, md.median_similarity FROM mae LEFT JOIN md USING (platform)
""")

SQL["similar_recent"] = _q(SIM.replace("WHERE r <= 5 GROUP BY platform, post_id", "WHERE r <= 3 GROUP BY platform, post_id") + """,
rec AS (SELECT platform, post_id, engagement_rate, row_number() OVER (PARTITION BY platform ORDER BY published_at DESC NULLS LAST, post_id) AS rr FROM pe),
nb2 AS (SELECT platform, post_id, max(CASE WHEN r = 1 THEN nb END) AS similar_1, max(CASE WHEN r = 2 THEN nb END) AS similar_2
        FROM rk WHERE r <= 2 GROUP BY platform, post_id)
SELECT rec.platform, CAST(rr AS INTEGER) AS recency_rank, rec.post_id, round(engagement_rate, 4) AS actual_rate,
  round(CASE WHEN ss > 0 THEN swr / ss ELSE m END, 4) AS predicted_rate, round(top, 3) AS similarity, similar_1, similar_2
FROM rec JOIN pred USING (platform, post_id) JOIN nb2 USING (platform, post_id) WHERE rr <= 5
""")

SQL["ml_suite_status"] = _q("""
SELECT platform, count(*) AS n_posts, CASE WHEN count(*) < 10 THEN 'insufficient_data' ELSE 'ok' END AS status,
  count(*) >= 15 AS predictor_enabled, count(*) >= 15 AS fatigue_enabled
FROM posts GROUP BY platform
""")


# ---------------------------------------------------------------------------
# Ingestion round trips (N1–N11 with the DST null rule; N6 Greek dates)
# ---------------------------------------------------------------------------
SQL["ingest_roundtrip"] = POSTS + """,
r AS (SELECT *, timezone('America/Los_Angeles', timezone('UTC', published_at)) AS loc FROM raw_posts),
e AS (SELECT post_id, title, content_type, reach, views, likes, shares, comments, saves, followers_gained,
        strptime(strftime(loc, '%m/%d/%Y %H:%M'), '%m/%d/%Y %H:%M') AS lt FROM r),
u AS (SELECT *, timezone('UTC', timezone('America/Los_Angeles', lt)) AS utc FROM e),
c AS (SELECT *, timezone('America/Los_Angeles', timezone('UTC', utc)) AS back,
        timezone('America/Los_Angeles', timezone('UTC', utc - INTERVAL 1 HOUR)) AS earlier,
        timezone('America/Los_Angeles', timezone('UTC', utc + INTERVAL 1 HOUR)) AS later FROM u)
SELECT post_id, 'instagram' AS platform, content_type,
  CASE WHEN back <> lt OR earlier = lt OR later = lt THEN NULL ELSE strftime(utc, '%Y-%m-%d %H:%M:%S') END AS published_at,
  reach, views, likes, comments, shares, saves, followers_gained, likes + comments + shares + saves AS engagement_total,
  round(CASE WHEN reach > 0 THEN (likes + comments + shares + saves) / CAST(reach AS DOUBLE) ELSE 0.0 END, 6) AS engagement_rate,
  CAST(length(coalesce(title, '')) AS INTEGER) AS title_chars
FROM c
"""

SQL["greek_dates"] = _q(""",
days AS (SELECT DISTINCT platform, CAST(ts_kst AS DATE) AS d FROM posts WHERE published_at IS NOT NULL),
rows0 AS (SELECT platform AS file, CAST(row_number() OVER (PARTITION BY platform ORDER BY d) AS INTEGER) AS row_no,
            CAST(day(d) AS VARCHAR) || ' ' || (CASE month(d) WHEN 1 THEN 'Ιανουαρίου' WHEN 2 THEN 'Φεβρουαρίου' WHEN 3 THEN 'Μαρτίου' WHEN 4 THEN 'Απριλίου' WHEN 5 THEN 'Μαΐου' WHEN 6 THEN 'Ιουνίου' WHEN 7 THEN 'Ιουλίου' WHEN 8 THEN 'Αυγούστου' WHEN 9 THEN 'Σεπτεμβρίου' WHEN 10 THEN 'Οκτωβρίου' WHEN 11 THEN 'Νοεμβρίου' WHEN 12 THEN 'Δεκεμβρίου' END) AS value,
            max(d) OVER (PARTITION BY platform) AS asof_d FROM days),
p AS (SELECT *, trim(value) AS v, string_split_regex(trim(value), '\\s+') AS parts FROM rows0),
p2 AS (SELECT *, CASE WHEN len(parts) >= 2 THEN TRY_CAST(parts[1] AS INTEGER) END AS dd,
          lower(trim(parts[2])) AS w FROM p),
p3 AS (SELECT *, CASE WHEN dd IS NOT NULL AND len(parts) >= 2 THEN coalesce(CASE w WHEN 'ιανουαρίου' THEN 1 WHEN 'ιανουάριου' THEN 1 WHEN 'φεβρουαρίου' THEN 2 WHEN 'φεβρουάριου' THEN 2 WHEN 'μαρτίου' THEN 3 WHEN 'μάρτιου' THEN 3 WHEN 'απριλίου' THEN 4 WHEN 'απρίλιου' THEN 4 WHEN 'μαΐου' THEN 5 WHEN 'μαίου' THEN 5 WHEN 'ιουνίου' THEN 6 WHEN 'ιούνιου' THEN 6 WHEN 'ιουλίου' THEN 7 WHEN 'ιούλιου' THEN 7 WHEN 'αυγούστου' THEN 8 WHEN 'σεπτεμβρίου' THEN 9 WHEN 'σεπτέμβριου' THEN 9 WHEN 'οκτωβρίου' THEN 10 WHEN 'οκτώβριου' THEN 10 WHEN 'νοεμβρίου' THEN 11 WHEN 'νοέμβριου' THEN 11 WHEN 'δεκεμβρίου' THEN 12 WHEN 'δεκέμβριου' THEN 12 END, CASE WHEN starts_with(w, 'ιανο') OR starts_with('ιανουαρίου', substring(w, 1, 4)) THEN 1 WHEN starts_with(w, 'ιανο') OR starts_with('ιανουάριου', substring(w, 1, 4)) THEN 1 WHEN starts_with(w, 'φεβρ') OR starts_with('φεβρουαρίου', substring(w, 1, 4)) THEN 2 WHEN starts_with(w, 'φεβρ') OR starts_with('φεβρουάριου', substring(w, 1, 4)) THEN 2 WHEN starts_with(w, 'μαρτ') OR starts_with('μαρτίου', substring(w, 1, 4)) THEN 3 WHEN starts_with(w, 'μάρτ') OR starts_with('μάρτιου', substring(w, 1, 4)) THEN 3 WHEN starts_with(w, 'απρι') OR starts_with('απριλίου', substring(w, 1, 4)) THEN 4 WHEN starts_with(w, 'απρί') OR starts_with('απρίλιου', substring(w, 1, 4)) THEN 4 WHEN starts_with(w, 'μαΐο') OR starts_with('μαΐου', substring(w, 1, 4)) THEN 5 WHEN starts_with(w, 'μαίο') OR starts_with('μαίου', substring(w, 1, 4)) THEN 5 WHEN starts_with(w, 'ιουν') OR starts_with('ιουνίου', substring(w, 1, 4)) THEN 6 WHEN starts_with(w, 'ιούν') OR starts_with('ιούνιου', substring(w, 1, 4)) THEN 6 WHEN starts_with(w, 'ιουλ') OR starts_with('ιουλίου', substring(w, 1, 4)) THEN 7 WHEN starts_with(w, 'ιούλ') OR starts_with('ιούλιου', substring(w, 1, 4)) THEN 7 WHEN starts_with(w, 'αυγο') OR starts_with('αυγούστου', substring(w, 1, 4)) THEN 8 WHEN starts_with(w, 'σεπτ') OR starts_with('σεπτεμβρίου', substring(w, 1, 4)) THEN 9 WHEN starts_with(w, 'σεπτ') OR starts_with('σεπτέμβριου', substring(w, 1, 4)) THEN 9 WHEN starts_with(w, 'οκτω') OR starts_with('οκτωβρίου', substring(w, 1, 4)) THEN 10 WHEN starts_with(w, 'οκτώ') OR starts_with('οκτώβριου', substring(w, 1, 4)) THEN 10 WHEN starts_with(w, 'νοεμ') OR starts_with('νοεμβρίου', substring(w, 1, 4)) THEN 11 WHEN starts_with(w, 'νοέμ') OR starts_with('νοέμβριου', substring(w, 1, 4)) THEN 11 WHEN starts_with(w, 'δεκε') OR starts_with('δεκεμβρίου', substring(w, 1, 4)) THEN 12 WHEN starts_with(w, 'δεκέ') OR starts_with('δεκέμβριου', substring(w, 1, 4)) THEN 12 END) END AS m FROM p2),
p4 AS (SELECT *, m IS NOT NULL AS valid FROM p3),
p5 AS (SELECT *, sum(CASE WHEN valid THEN 1 ELSE 0 END) OVER (PARTITION BY file) AS nvalid,
          lag(m) OVER (PARTITION BY file, valid ORDER BY row_no) AS prevm FROM p4),
p6 AS (SELECT *, CASE WHEN valid AND m < prevm - 1 THEN 1 ELSE 0 END AS wrap FROM p5),
p7 AS (SELECT *, sum(wrap) OVER (PARTITION BY file) AS wt,
          sum(wrap) OVER (PARTITION BY file, valid ORDER BY row_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS wr FROM p6),
p8 AS (SELECT *, CASE WHEN nvalid >= 60 THEN year(asof_d) - wt + wr
                      ELSE year(asof_d) - CASE WHEN m > month(asof_d) + 2 THEN 1 ELSE 0 END END AS yy FROM p7)
SELECT file, row_no, value, CASE WHEN valid THEN TRY_CAST(make_date(CAST(yy AS BIGINT), CAST(m AS BIGINT), CAST(dd AS BIGINT)) AS DATE) END AS date
FROM p8
""")

# ---------------------------------------------------------------------------
# Insight tables (R1–R3): rules over the other queries' SQL as subqueries
# ---------------------------------------------------------------------------
PNAME = ("(CASE platform WHEN 'instagram' THEN 'Instagram' WHEN 'youtube' THEN 'YouTube' WHEN 'facebook' THEN 'Facebook' "
         "WHEN 'tiktok' THEN 'TikTok' ELSE platform END)")
CLABEL = ("(CASE content_type WHEN 'short_video' THEN 'Short Video' WHEN 'long_video' THEN 'Long Video' "
          "WHEN 'image' THEN 'Image' WHEN 'carousel' THEN 'Carousel' WHEN 'story' THEN 'Story' WHEN 'live' THEN 'Live Stream' "
          "WHEN 'text_post' THEN 'Text Post' WHEN 'link_post' THEN 'Link Post' WHEN 'other' THEN 'Other' "
          "ELSE array_to_string(list_transform(string_split(content_type, '_'), lambda x: upper(x[1]) || lower(x[2:])), ' ') END)")


def PCT1(x: str) -> str:
    return f"(printf('%.1f', round(({x}) * 100, 1)) || '%')"


def sub(name: str) -> str:
    return "(" + SQL[name] + ")"


SQL["recommendations"] = f"""
WITH np AS (SELECT total_posts AS n, n_platforms FROM {sub('meta')} m),
top3 AS (SELECT * FROM {sub('hourly_profile')} h WHERE rank <= 3),
fo AS (SELECT min(rank) AS r FROM top3 WHERE post_count >= 3),
vp AS (SELECT platform, string_agg(DISTINCT {CLABEL}, ', ' ORDER BY {CLABEL}) AS types FROM {sub('viral_posts')} v GROUP BY platform),
rules AS (
  SELECT 1 AS rule_ix, platform, 'high' AS priority, 'content' AS category,
    printf('On %s, your best content type is ''%s'' with %s avg engagement (%d posts). Create more of this.',
           {PNAME}, {CLABEL}, {PCT1('engagement_rate')}, count) AS message
  FROM {sub('platform_content_ranking')} r WHERE rank = 1
  UNION ALL SELECT 2, NULL, 'high', 'timing',
    printf('Your best posting hour is %d:00 KST (based on %.0f posts). Schedule high-priority content around this time.', hour, post_count)
  FROM top3 WHERE rank = 1 AND post_count >= 3
  UNION ALL SELECT 3, NULL, 'medium', 'timing',
    printf('Hour %d:00 KST shows strong engagement (%.0f posts). Consider posting around this time.', hour, post_count)
  FROM top3, fo WHERE top3.rank = fo.r AND fo.r > 1
  UNION ALL SELECT 4, NULL, 'low', 'timing', 'Not enough data per time slot to recommend posting hours yet. Keep adding weekly exports.'
  FROM top3, fo WHERE top3.rank = 1 AND fo.r IS NULL
  UNION ALL SELECT 5, NULL, 'medium', 'timing', printf('Best performing day is %s. Consider making this your primary posting day.', day_of_week)
  FROM {sub('daily_profile')} d WHERE rank = 1 AND post_count >= 3
  UNION ALL SELECT 6, NULL, 'medium', 'engagement',
    'Comments-to-likes ratio is low. Try asking questions, running polls, or creating discussion-worthy content.'
  FROM {sub('engagement_composition')} c WHERE conversation_ratio < 0.05
  UNION ALL SELECT 7, platform, 'medium', 'platform', printf('%s engagement is below industry benchmark. Review content strategy for this platform.', {PNAME})
  FROM {sub('platform_overview')} o WHERE vs_benchmark < -0.02
  UNION ALL SELECT 8, platform, 'low', 'platform', printf('%s is outperforming industry benchmark by %s! Keep up the great work.', {PNAME}, {PCT1('vs_benchmark')})
  FROM {sub('platform_overview')} o2 WHERE vs_benchmark > 0.02
  UNION ALL SELECT 9, platform, 'high', 'growth',
    printf('%s reach is declining. Consider boosting posting frequency or trying new content formats on this platform.', {PNAME})
  FROM {sub('platform_growth')} g WHERE reach_trend = 'declining'
  UNION ALL SELECT 10, platform, 'low', 'growth', printf('%s reach is growing! Keep up the momentum.', {PNAME})
  FROM {sub('platform_growth')} g2 WHERE reach_trend = 'growing'
  UNION ALL SELECT 11, platform, 'high', 'content', printf('Viral content on %s: %s. Create more content in these formats.', {PNAME}, types)
  FROM vp
  UNION ALL SELECT 12, NULL, 'low', 'methodology',
    'Note: Instagram engagement rate uses reach as denominator; TikTok uses views. Direct rate comparison between platforms should be interpreted with this in mind.'
  FROM np WHERE n_platforms > 1),
allr AS (
  SELECT rules.* FROM rules, np WHERE np.n >= 10
  UNION ALL SELECT 0, NULL, 'high', 'data',
    'Not enough data for deep analysis yet. Keep adding weekly exports! At least 4 weeks of data is ideal.' FROM np WHERE np.n < 10)
SELECT CAST(rule_ix AS INTEGER) AS rule_ix, platform, priority,
  CAST(CASE priority WHEN 'high' THEN 0 WHEN 'medium' THEN 1 ELSE 2 END AS INTEGER) AS priority_rank, category, message,
  CAST(row_number() OVER (ORDER BY CASE priority WHEN 'high' THEN 0 WHEN 'medium' THEN 1 ELSE 2 END, rule_ix, platform NULLS FIRST) AS INTEGER) AS rank
FROM allr
"""

SQL["pulse"] = f"""
WITH s AS (
  SELECT CASE WHEN vs_benchmark > 0 THEN 1 ELSE 0 END AS g, CASE WHEN vs_benchmark < -0.02 THEN 1 ELSE 0 END AS b FROM {sub('platform_overview')} o
  UNION ALL SELECT CASE WHEN reach_trend = 'growing' THEN 1 ELSE 0 END, CASE WHEN reach_trend = 'declining' THEN 1 ELSE 0 END FROM {sub('platform_growth')} g
  UNION ALL SELECT CASE WHEN total_score >= 60 THEN 1 ELSE 0 END, CASE WHEN total_score < 35 THEN 1 ELSE 0 END FROM {sub('momentum')} m),
t AS (SELECT CAST(coalesce(sum(g), 0) AS BIGINT) AS signals_good, CAST(coalesce(sum(b), 0) AS BIGINT) AS signals_bad FROM s),
v AS (SELECT max(multiplier) AS vm FROM {sub('viral_posts')} vp),
c AS (SELECT t.*, CASE WHEN signals_good >= 2 AND signals_good > signals_bad * 3 THEN 'good'
                       WHEN signals_bad >= 2 AND signals_bad >= signals_good THEN 'bad' ELSE 'ok' END AS pulse_class, v.vm FROM t, v)
SELECT signals_good, signals_bad, pulse_class,
  (CASE pulse_class WHEN 'good' THEN 'Things are looking great! Our content is connecting with the audience and engagement is healthy across platforms.'
    WHEN 'bad' THEN 'There are some areas that need our attention. Engagement or reach is dropping on one or more platforms — let''s adjust our approach.'
    ELSE 'Our social media presence is steady. There''s room to grow — the data shows a few opportunities we can take advantage of.' END)
  || CASE WHEN vm IS NOT NULL THEN ' We had a standout post that performed ' || CAST(vm AS VARCHAR) || 'x above average!' ELSE '' END AS pulse_text
FROM c
"""

SQL["key_numbers"] = f"""
WITH ov AS {sub('platform_overview')},
tot AS (SELECT sum(total_posts) AS p, sum(total_engagement) AS e, sum(total_followers_gained) AS f FROM ov)
SELECT 1 AS ix, NULL AS platform, 'We''ve published ' || format('{{:,}}', CAST(p AS BIGINT)) || ' posts in total' AS text FROM tot
UNION ALL SELECT 2, platform, CASE WHEN platform = 'tiktok' THEN {PNAME} || ': ' || format('{{:,}}', total_reach) || ' video views'
  ELSE {PNAME} || ': reached ' || format('{{:,}}', total_reach) || ' people' END FROM ov
UNION ALL SELECT 3, NULL, 'We received ' || format('{{:,}}', CAST(e AS BIGINT)) || ' interactions (likes, comments, shares, saves)' FROM tot
UNION ALL SELECT 4, NULL, 'We gained ' || format('{{:,}}', CAST(f AS BIGINT)) || ' new followers across all platforms' FROM tot WHERE f > 0
UNION ALL SELECT 5, platform, {PNAME} || ' reach grew ' || CAST(CAST(round(wow_reach_change * 100, 0) AS INTEGER) AS VARCHAR) || '% compared to last week'
  FROM ov WHERE wow_reach_change > 0.1
UNION ALL SELECT 5, platform, {PNAME} || ' reach dropped ' || CAST(CAST(round(abs(wow_reach_change) * 100, 0) AS INTEGER) AS VARCHAR) || '% compared to last week'
  FROM ov WHERE wow_reach_change < -0.1
"""

CTITLE = "array_to_string(list_transform(string_split(content_type, '_'), lambda x: upper(x[1]) || lower(x[2:])), ' ')"

SQL["summary_lists"] = f"""
WITH hp AS (SELECT * FROM {sub('hourly_profile')} h WHERE rank = 1),
dp AS (SELECT * FROM {sub('daily_profile')} d WHERE rank = 1),
pcr AS (SELECT * FROM {sub('platform_content_ranking')} r WHERE rank = 1),
dl AS {sub('driver_lift')},
vp AS (SELECT *, row_number() OVER (ORDER BY multiplier DESC, platform, post_id) AS v FROM {sub('viral_posts')} v0),
pg AS {sub('platform_growth')},
fat AS {sub('content_fatigue')},
ov AS {sub('platform_overview')},
ec AS {sub('engagement_composition')},
cad AS {sub('cadence_summary')},
work AS (
  SELECT 'working' AS list, 1 AS ix, platform AS sub_key, printf('%s posts on %s get the best engagement (%d posts analyzed)', {CTITLE}, {PNAME}, count) AS text FROM pcr
  UNION ALL SELECT 'working', 2, NULL, printf('Posting around %d:00 KST gets the most engagement', hour) FROM hp WHERE post_count >= 3
  UNION ALL SELECT 'working', 3, NULL, printf('%s is our best performing day', day_of_week) FROM dp WHERE post_count >= 3
  UNION ALL SELECT 'working', 4, platform || '1', printf('Multilingual captions (Korean + English) boost engagement on %s', {PNAME}) FROM dl WHERE factor = 'is_multilingual' AND lift > 0.1
  UNION ALL SELECT 'working', 4, platform || '2', printf('Using emojis increases engagement on %s', {PNAME}) FROM dl WHERE factor = 'has_emoji' AND lift > 0.1
  UNION ALL SELECT 'working', 5, lpad(CAST(v AS VARCHAR), 3, '0'), printf('Our post %s went viral on %s (%sx above average)', post_id, {PNAME}, CAST(multiplier AS VARCHAR)) FROM vp WHERE v <= 2),
attn AS (
  SELECT 'attention' AS list, 1 AS ix, platform AS sub_key, printf('%s reach has been declining recently — try new content formats or increase posting frequency', {PNAME}) AS text FROM pg WHERE reach_trend = 'declining'
  UNION ALL SELECT 'attention', 2, concat_ws('|', platform, CAST(severity_rank AS VARCHAR), content_type), printf('Our audience may be getting tired of %s posts on %s (engagement is dropping)', {CTITLE}, {PNAME}) FROM fat WHERE trend = 'declining'
  UNION ALL SELECT 'attention', 3, NULL, 'We''re getting lots of likes but very few comments — try asking questions or creating discussion-worthy content' FROM ec WHERE conversation_ratio < 0.05
  UNION ALL SELECT 'attention', 4, platform, printf('%s engagement is below the industry average — our content strategy on this platform needs a refresh', {PNAME}) FROM ov WHERE vs_benchmark < -0.02),
cf AS (SELECT * FROM cad WHERE platform = (SELECT min(platform) FROM cad)),
gr AS (SELECT * FROM fat WHERE trend = 'growing'),
gf AS (SELECT * FROM gr WHERE platform = (SELECT min(platform) FROM gr)),
gf2 AS (SELECT * FROM gf WHERE content_type = (SELECT min(content_type) FROM gf)),
acts0 AS (
  SELECT 'actions' AS list, 1 AS ix, NULL AS sub_key, printf('Create more %s content on %s — it''s your top performer', {CTITLE}, {PNAME}) AS text FROM pcr WHERE platform = (SELECT min(platform) FROM pcr)
  UNION ALL SELECT 'actions', 2, NULL, printf('Schedule your most important post for %d:00 KST', hour) FROM hp
  UNION ALL SELECT 'actions', 3, NULL, printf('Try posting %d times per week on %s (currently ~%d)', optimal_for_engagement, {PNAME}, CAST(round_even(current_cadence, 0) AS BIGINT)) FROM cf WHERE optimal_for_engagement > current_cadence + 1
  UNION ALL SELECT 'actions', 4, NULL, printf('%s content is gaining momentum on %s — invest more in this format', {CTITLE}, {PNAME}) FROM gf2 WHERE (SELECT count(*) FROM attn) > 0),
acts AS (SELECT * FROM acts0 UNION ALL SELECT 'actions', 9, NULL, 'Keep posting consistently — your data is still building and the models will improve each week' WHERE (SELECT count(*) FROM acts0) = 0),
allr AS (SELECT * FROM work UNION ALL SELECT * FROM attn UNION ALL SELECT * FROM acts),
r AS (SELECT *, row_number() OVER (PARTITION BY list ORDER BY ix, sub_key NULLS FIRST) AS pos FROM allr)
SELECT list, CAST(pos AS INTEGER) AS pos, text FROM r
WHERE pos <= CASE list WHEN 'working' THEN 6 WHEN 'attention' THEN 5 ELSE 4 END
"""


# ---------------------------------------------------------------------------
# File parsers over rendered texts, TikTok-style table, tags, scoring bundle
# ---------------------------------------------------------------------------
from pulsekit.sources.greek import COUNTRY_CODES  # noqa: E402

SQL["preamble_series"] = SERIES + "SELECT platform || '/' || metric AS path, date, metric, value FROM series"

SQL["audience_sections"] = """
WITH c AS (SELECT CAST(n_regionkey AS VARCHAR) AS path, n_name, c_mktsegment, 'band ' || (c_custkey % 4) AS age, c_custkey % 3 = 0 AS man
           FROM customer JOIN nation ON c_nationkey = n_nationkey)
SELECT path, 'countries' AS section, n_name AS name, CAST(count(*) AS DOUBLE) AS value, NULL::DOUBLE AS men, NULL::DOUBLE AS women FROM c GROUP BY ALL
UNION ALL SELECT path, 'cities', c_mktsegment, CAST(count(*) AS DOUBLE), NULL, NULL FROM c GROUP BY ALL
UNION ALL SELECT path, 'age_gender', age, CAST(count(*) AS DOUBLE), CAST(count(*) FILTER (man) AS DOUBLE), CAST(count(*) FILTER (NOT man) AS DOUBLE)
FROM c GROUP BY path, age
"""

# expected target, score and status of each landing case before duplicates are settled
LANDING = """
WITH k(m, target, score, status, allowed) AS (VALUES (0, 'Overview.csv', 57, 'ok', 'Overview.csv'), (1, 'content.csv', 55, 'warn', NULL),
  (2, 'Viewers.csv', 3, 'err', NULL), (3, 'FollowerGender.csv', 25, 'err', NULL), (4, 'FollowerHistory.csv', 29, 'ok', 'FollowerHistory.csv')),
f AS (SELECT 'landing/' || lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS path, o_orderkey % 5 AS m, CAST(trunc(o_totalprice) AS BIGINT) AS length, o_orderdate FROM orders),
j AS (SELECT f.*, k.target, k.score, k.status, k.allowed, row_number() OVER (PARTITION BY k.target ORDER BY o_orderdate, path) AS nth FROM f JOIN k USING (m))
"""
SQL["landing_classes"] = LANDING + """
SELECT path, target, CAST(score AS INTEGER) AS score, CASE WHEN status = 'ok' AND nth > 1 THEN 'err' ELSE status END AS status,
  FALSE AS ambiguous FROM j
"""
SQL["landing_checks"] = LANDING + """
SELECT path, allowed AS correct_name, allowed IS NOT NULL AND length <= 300000 AS ok,
  'data/tiktok/' || allowed AS target_path, FALSE AS batch_ok FROM j
"""

SQL["country_shares"] = f"""
WITH c AS (SELECT n_name, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name),
names(code, name) AS (VALUES {", ".join(f"('{k}', '{v}')" for k, v in COUNTRY_CODES.items())})
SELECT n_name, coalesce(name, upper(substr(n_name, 1, 2))) AS country, round(n / (SELECT sum(n) FROM c) * 100, 1) AS share_pct,
  '&lt;b &quot;' || n_name || '&quot;&gt; &amp; more' AS shown FROM c LEFT JOIN names ON code = upper(substr(n_name, 1, 2))
"""

SQL["tiktok_daily"] = DAILY + """
SELECT platform, date, interactions AS likes, link_clicks AS comments, reach AS shares, interactions + link_clicks + reach AS interactions,
  views_7d_avg, follows_7d_avg, visits_7d_avg FROM daily
"""

SQL["hashtag_rows"] = _q("""
SELECT DISTINCT platform, post_id, '#' || lower(unnest(regexp_extract_all(coalesce(title, ''), '#([\\p{L}\\p{N}_]{2,})', 1))) AS tag FROM posts
""")

SQL["scoring_bundle"] = f"""
SELECT 'type' AS kind, content_type AS name, avg_score, best_score, count FROM ({SQL["scores_by_type"]})
UNION ALL SELECT 'platform', platform, avg_score, best_score, count FROM ({SQL["scores_by_platform"]})
"""


# ---------------------------------------------------------------------------
# Clustering (M7, M17, M20): seeds by hash races, Lloyd rounds in integers
# ---------------------------------------------------------------------------
def kmeans_sql(k_most: int, restarts: int = 10, rounds: int = 20) -> str:
    """CTEs from ``kp`` (platform, x BIGINT[]) and ``kk`` (platform, k) to ``km`` (platform, key, cluster, distance)."""
    near = "min((n.s - 2 * list_dot_product(n.v, c.v) + c.s) * 64 + c.i)::BIGINT"
    out = f"""
kn AS MATERIALIZED (SELECT platform, x, x::DOUBLE[] AS v, list_dot_product(x::DOUBLE[], x::DOUBLE[]) AS s, count(*) AS n, md5(array_to_string(x, ',')) AS key
       FROM kp JOIN kk USING (platform) GROUP BY platform, x),
kr AS (SELECT range AS r FROM range({restarts})),
w0 AS MATERIALIZED (SELECT platform, r, key, v, s, n, n::DOUBLE AS w, NULL::DOUBLE AS d FROM kn, kr),"""
    for t in range(k_most):
        race = f"-ln((('0x' || substr(md5(concat(r, ':{t}:', key)), 1, 8))::BIGINT + 1) / (2.0::DOUBLE ** 32 + 1)) / w"
        out += f"""
s{t} AS MATERIALIZED (SELECT platform, r, {t} AS i, v, s FROM w{t} JOIN kk USING (platform) WHERE w > 0 AND k > {t}
        QUALIFY row_number() OVER (PARTITION BY platform, r ORDER BY {race}, key) = 1),
w{t + 1} AS MATERIALIZED (SELECT *, n * d AS w FROM (SELECT w.platform, r, key, w.v, w.s, n, least(w.d, w.s - 2 * list_dot_product(w.v, c.v) + c.s) AS d
        FROM w{t} w JOIN s{t} c USING (platform, r))),"""
    out += f"""
c0 AS MATERIALIZED ({" UNION ALL ".join(f"SELECT * FROM s{t}" for t in range(k_most))}),"""
    for t in range(rounds):
        out += f"""
a{t} AS MATERIALIZED (SELECT n.platform, n.key, c.r, {near} & 63 AS i FROM kn n JOIN c{t} c USING (platform) GROUP BY n.platform, n.key, c.r),
c{t + 1} AS MATERIALIZED (SELECT platform, r, i, v, list_dot_product(v, v) AS s FROM (
   SELECT c.platform, c.r, c.i, coalesce(m.v, c.v) AS v FROM c{t} c LEFT JOIN (
     SELECT platform, r, i, list(y ORDER BY place)::DOUBLE[] AS v FROM (
       SELECT platform, r, i, place, (sum(y) - ((sum(y) % sum(n)) + sum(n)) % sum(n)) // sum(n) AS y FROM (
         SELECT a.platform, a.r, a.i, n.n, unnest(n.x) * n.n AS y, unnest(range(len(n.x))) AS place FROM a{t} a JOIN kn n USING (platform, key))
       GROUP BY platform, r, i, place) GROUP BY platform, r, i) m USING (platform, r, i))),"""
    out += f"""
kz AS MATERIALIZED (SELECT n.platform, n.key, n.n, c.r, {near} AS z FROM kn n JOIN c{rounds} c USING (platform) GROUP BY n.platform, n.key, n.n, c.r),
kb AS (SELECT platform, r FROM (SELECT platform, r, sum(n::HUGEINT * (z >> 6)) AS cost FROM kz GROUP BY platform, r)
       QUALIFY row_number() OVER (PARTITION BY platform ORDER BY cost, r) = 1),
km AS MATERIALIZED (SELECT platform, key, (z & 63)::INTEGER AS cluster, z >> 6 AS distance FROM kz JOIN kb USING (platform, r))"""
    return out


def _tier(c: str) -> str:
    return f"CASE WHEN hi_{c} > lo_{c} THEN floor(({c}::DOUBLE - lo_{c}) / (hi_{c} - lo_{c}) * 65536)::BIGINT ELSE 0 END"


_TIERS = ("engagement_rate", "likes", "comments", "shares")
SQL["content_tiers"] = _q(f""",
ends AS (SELECT platform, {", ".join(f"min({c})::DOUBLE AS lo_{c}, max({c})::DOUBLE AS hi_{c}" for c in _TIERS)} FROM posts GROUP BY platform),
kp AS MATERIALIZED (SELECT platform, post_id, content_type, reach, published_at, engagement_rate, likes, shares, [{", ".join(map(_tier, _TIERS))}] AS x
       FROM posts JOIN ends USING (platform)),
kk AS (SELECT platform, least(3, greatest(2, count(*) // 5)) AS k FROM kp GROUP BY platform HAVING count(*) >= 10),
{kmeans_sql(3)},
t AS MATERIALIZED (SELECT kp.*, km.cluster FROM kp JOIN km ON km.platform = kp.platform AND km.key = md5(array_to_string(kp.x, ','))),
g AS (SELECT platform, cluster, count(*) AS size, round(avg(engagement_rate), 4) AS avg_engagement_rate, trunc(avg(reach))::BIGINT AS avg_reach,
        trunc(avg(likes))::BIGINT AS avg_likes, trunc(avg(shares))::BIGINT AS avg_shares FROM t GROUP BY platform, cluster),
ty AS (SELECT platform, cluster, content_type AS dominant_type FROM (SELECT platform, cluster, content_type, count(*) AS n FROM t GROUP BY ALL)
       QUALIFY row_number() OVER (PARTITION BY platform, cluster ORDER BY n DESC, content_type) = 1),
sm AS (SELECT platform, cluster, string_agg(post_id, ',' ORDER BY post_id) AS sample_posts FROM (
         SELECT * FROM t QUALIFY row_number() OVER (PARTITION BY platform, cluster ORDER BY published_at DESC NULLS LAST, post_id) <= 3) GROUP BY platform, cluster)
SELECT g.*, ty.dominant_type, sm.sample_posts, ['[TOP] Top Performers', '[AVG] Average', '[LOW] Needs Improvement'][
    least(3, row_number() OVER (PARTITION BY platform ORDER BY avg_engagement_rate DESC, cluster))] AS label
FROM g JOIN ty USING (platform, cluster) JOIN sm USING (platform, cluster)
""")

_FIXED = "list_transform(embedding, lambda x: floor(x::DOUBLE * 65536)::BIGINT)"
_POST_VECTORS = f"""
ev AS (SELECT vec_id, {_FIXED} AS x FROM embeddings),
pv AS MATERIALIZED (SELECT p.platform, p.post_id, p.engagement_rate, p.weight, p.reach, p.content_type, e.x
       FROM posts p JOIN ev e ON e.vec_id = CAST(p.post_id AS BIGINT) % (SELECT max(vec_id) + 1 FROM ev))"""

SQL["topics"] = _q(f""",{_POST_VECTORS},
kp AS (SELECT platform, x FROM pv),
kk AS (SELECT platform, least(greatest(3, count(*) // 15), 8) AS k FROM kp GROUP BY platform HAVING count(*) >= 10),
{kmeans_sql(8)},
t AS MATERIALIZED (SELECT pv.* EXCLUDE (x), km.cluster AS topic_id, km.distance FROM pv JOIN km ON km.platform = pv.platform AND km.key = md5(array_to_string(pv.x, ','))),
g AS (SELECT platform, topic_id, count(*) AS post_count, round({WAVG("engagement_rate")}, 4) AS avg_engagement_rate, sum(reach)::BIGINT AS total_reach,
        arg_min(post_id, (distance, post_id)) AS representative_post FROM t GROUP BY platform, topic_id),
mi AS (SELECT platform, topic_id, string_agg(c, ',' ORDER BY c) AS content_types FROM (
         SELECT platform, topic_id, concat(content_type, ':', count(*)) AS c FROM t GROUP BY platform, topic_id, content_type) GROUP BY platform, topic_id),
tk AS (SELECT platform, post_id, unnest(regexp_extract_all(lower(coalesce(title, '')), '[\\p{{L}}\\p{{N}}_]{{3,}}')) AS term FROM posts),
kc AS (SELECT platform, topic_id, term, count(*) AS n FROM tk JOIN t USING (platform, post_id) WHERE term NOT IN ({_sql_list(STOP_WORDS)}) GROUP BY platform, topic_id, term
       QUALIFY row_number() OVER (PARTITION BY platform, topic_id ORDER BY n DESC, term) <= 5),
kw AS (SELECT platform, topic_id, string_agg(term, ',' ORDER BY n DESC, term) AS keywords FROM kc GROUP BY platform, topic_id)
SELECT g.*, mi.content_types, kw.keywords, (row_number() OVER (PARTITION BY platform ORDER BY avg_engagement_rate DESC, topic_id))::INTEGER AS rank
FROM g JOIN mi USING (platform, topic_id) LEFT JOIN kw USING (platform, topic_id)
""")

SQL["hashtag_clusters"] = _q(f""",{_POST_VECTORS},
oc AS MATERIALIZED (SELECT platform, post_id, engagement_rate, '#' || lower(unnest(regexp_extract_all(coalesce(title, ''), '#([\\p{{L}}\\p{{N}}_]{{2,}})', 1))) AS tag FROM posts),
tp AS (SELECT DISTINCT platform, post_id, tag FROM oc),
tv AS (SELECT platform, tag, list(y ORDER BY place)::BIGINT[] AS x FROM (
         SELECT platform, tag, place, (sum(y) - ((sum(y) % count(*)) + count(*)) % count(*)) // count(*) AS y FROM (
           SELECT tp.platform, tp.tag, unnest(pv.x) AS y, unnest(range(len(pv.x))) AS place FROM tp JOIN pv USING (platform, post_id))
         GROUP BY platform, tag, place) GROUP BY platform, tag),
kp AS (SELECT platform, x FROM tv),
kk AS (SELECT platform, least(greatest(2, count(*) // 3), 6) AS k FROM kp GROUP BY platform HAVING count(*) >= 3),
{kmeans_sql(6)},
lb AS MATERIALIZED (SELECT tv.platform, tv.tag, km.cluster AS cluster_id FROM tv JOIN km ON km.platform = tv.platform AND km.key = md5(array_to_string(tv.x, ','))),
pc AS (SELECT platform, cluster_id, round(avg(engagement_rate), 4) AS avg_engagement_rate, count(DISTINCT post_id) AS total_posts, count(DISTINCT tag) AS total_hashtags
       FROM oc JOIN lb USING (platform, tag) GROUP BY platform, cluster_id),
rk AS (SELECT lb.platform, lb.cluster_id, lb.tag, row_number() OVER (PARTITION BY lb.platform, lb.cluster_id ORDER BY c.n DESC, lb.tag) AS r
       FROM lb JOIN (SELECT platform, tag, count(*) AS n FROM tp GROUP BY platform, tag) c USING (platform, tag)),
tg AS (SELECT platform, cluster_id, string_agg(tag, ',' ORDER BY r) FILTER (r <= 5) AS top_hashtags, string_agg(substr(tag, 2), ' / ' ORDER BY r) FILTER (r <= 3) AS label
       FROM rk GROUP BY platform, cluster_id)
SELECT platform, cluster_id, top_hashtags, label, total_hashtags, total_posts, avg_engagement_rate FROM pc JOIN tg USING (platform, cluster_id)
""")

# ---------------------------------------------------------------------------
# Isolation forest (M8): samples, features and splits drawn by hashes
# ---------------------------------------------------------------------------
_IF = ("reach", "engagement_total", "likes", "comments", "shares")
_CHANCE = "((('0x' || substr(md5(concat_ws(':', 42, tree, platform, node, '{}')), 1, 8))::BIGINT + 1) / (2.0::DOUBLE ** 32 + 1))"


def _search(n: str) -> str:
    return f"(CASE WHEN {n} <= 1 THEN 0.0 WHEN {n} = 2 THEN 1.0 ELSE 2 * (ln({n}::DOUBLE - 1) + 0.5772156649::DOUBLE) - 2 * ({n}::DOUBLE - 1) / {n}::DOUBLE END)::DOUBLE"


def _isolation(trees: int = 100, samples: int = 256, levels: int = 8) -> str:
    by_feature = lambda f, pick: "CASE " + " ".join(f"WHEN {f} = {i} THEN {pick(i, c)}" for i, c in enumerate(_IF)) + " END"
    out = f""",
n_ AS (SELECT platform, count(*) AS n FROM posts GROUP BY platform HAVING count(*) >= 10),
d AS MATERIALIZED (SELECT platform, post_id, engagement_rate, {", ".join(f"coalesce({c}::DOUBLE, 0) AS {c}" for c in _IF)} FROM posts JOIN n_ USING (platform)),
l0 AS MATERIALIZED (SELECT * EXCLUDE (k) FROM (SELECT platform, post_id, tree, {", ".join(_IF)}, 1 AS node, md5(concat_ws(':', 42, tree, platform, post_id)) AS k
        FROM d, range({trees}) t(tree)) QUALIFY row_number() OVER (PARTITION BY platform, tree ORDER BY k, post_id) <= {samples}),"""
    for v in range(levels):
        ends = ", ".join(f"min({c}) OVER w AS lo{i}, max({c}) OVER w AS hi{i}" for i, c in enumerate(_IF))
        wide = [f"(hi{i} > lo{i})::INT" for i in range(len(_IF))]
        nth = f"floor({_CHANCE.format('f')} * wide)"
        feature = "CASE " + " ".join(f"WHEN hi{i} > lo{i} AND {' + '.join(['0', *wide[:i]])} = {nth} THEN {i}" for i in range(len(_IF))) + " END"
        lo, hi = (by_feature("f", lambda i, c, e=e: f"{e}{i}") for e in ("lo", "hi"))
        out += f"""
m{v} AS MATERIALIZED (SELECT *, {lo} + {_CHANCE.format('s')} * ({hi} - {lo}) AS split, node >= {1 << v} AND size > 1 AND wide > 0 AS grows FROM (
   SELECT *, {feature} AS f FROM (SELECT *, {" + ".join(wide)} AS wide FROM (
     SELECT platform, post_id, tree, {", ".join(_IF)}, node, count(*) OVER w AS size, {ends} FROM l{v} WINDOW w AS (PARTITION BY platform, tree, node))))),
l{v + 1} AS MATERIALIZED (SELECT platform, post_id, tree, {", ".join(_IF)},
   CASE WHEN grows THEN 2 * node + ({by_feature("f", lambda i, c: c)} >= split)::INT ELSE node END AS node FROM m{v}),"""
    out += f"""
forest AS MATERIALIZED ({" UNION ALL ".join(f"SELECT DISTINCT platform, tree, node, f, split, NULL::BIGINT AS path FROM m{v} WHERE grows" for v in range(levels))}
   UNION ALL SELECT platform, tree, node, NULL, NULL, (floor(log2(node) + 1e-9) * 1024 + round({_search('count(*)')} * 1024))::BIGINT FROM l{levels} GROUP BY platform, tree, node),
s0 AS MATERIALIZED (SELECT platform, post_id, {", ".join(_IF)}, tree, 1 AS node, NULL::BIGINT AS path FROM d, range({trees}) t(tree)),"""
    for v in range(levels + 1):
        out += f"""
s{v + 1} AS MATERIALIZED (SELECT s.platform, s.post_id, {", ".join("s." + c for c in _IF)}, s.tree,
   CASE WHEN f.path IS NULL THEN 2 * s.node + ({by_feature("f.f", lambda i, c: "s." + c)} >= f.split)::INT ELSE s.node END AS node, f.path
   FROM s{v} s JOIN forest f USING (platform, tree, node)),"""
    score = lambda path: f"2.0::DOUBLE ** (-({path}::DOUBLE / {trees * 1024}) / {_search(f'least(n, {samples})')})"
    return out + f"""
pl AS MATERIALIZED (SELECT platform, post_id, sum(path)::BIGINT AS path FROM s{levels + 1} GROUP BY platform, post_id),
o AS (SELECT platform, path, n, row_number() OVER (PARTITION BY platform ORDER BY path DESC) - 1 AS r, 0.85::DOUBLE * (n - 1) AS pos FROM pl JOIN n_ USING (platform)),
bnd AS (SELECT platform, n, lo, lo_s + (hi_s - lo_s) * (pos - floor(pos)) AS thr FROM (
   SELECT platform, n, pos, lo, {score("lo")} AS lo_s, {score("hi")} AS hi_s FROM (
     SELECT platform, any_value(n) AS n, any_value(pos) AS pos, max(path) FILTER (r = floor(pos)) AS lo, max(path) FILTER (r = ceil(pos)) AS hi FROM o GROUP BY platform))),
md AS (SELECT platform, quantile_cont(engagement_rate, 0.5) AS med FROM d GROUP BY platform)
SELECT pl.platform, pl.post_id, CASE WHEN d.engagement_rate > med THEN 'viral_outlier' ELSE 'underperformer_outlier' END AS type,
  round(d.engagement_rate, 4) AS engagement_rate, d.reach::BIGINT AS reach, round(thr - {score("path")}, 4) + 0.0::DOUBLE AS anomaly_score
FROM pl JOIN bnd USING (platform) JOIN d ON d.platform = pl.platform AND d.post_id = pl.post_id JOIN md ON md.platform = pl.platform WHERE path < lo
"""


SQL["isolation_outliers"] = _q(_isolation())


# ---------------------------------------------------------------------------
# Files on disk: what goes through them comes back
# ---------------------------------------------------------------------------
SQL["csv_export_scan"] = SQL["ingest_roundtrip"]
SQL["history_store"] = POSTS + """,
n AS (SELECT *, CAST(post_id AS BIGINT) % 5 = 0 AS again, CAST(post_id AS BIGINT) % 10 = 0 AS moved FROM raw_posts)
SELECT post_id, platform, strftime(CASE WHEN moved THEN published_at + INTERVAL 40 DAY ELSE published_at END, '%Y-%m-%d %H:%M:%S') AS published_at,
  likes + again::INT AS likes, engagement_total + again::INT AS engagement_total,
  round(CASE WHEN reach > 0 THEN least((engagement_total + again::INT)::DOUBLE / reach, 1.0) ELSE 0.0 END, 6) AS engagement_rate,
  CASE WHEN again THEN '2026-02-01' ELSE '2026-01-01' END AS ingested
FROM n
"""


def _det3(columns) -> str:
    v = lambda r, k: f"covar_pop({k}, {r})"
    a, b, c = [[v(r, k) for r in "tcs"] for k in columns]
    return f"({a[0]} * ({b[1]} * {c[2]} - {b[2]} * {c[1]}) - {b[0]} * ({a[1]} * {c[2]} - {a[2]} * {c[1]}) + {c[0]} * ({a[1]} * {b[2]} - {a[2]} * {b[1]}))"


_ANGLE = "2 * pi() * date_diff('day', DATE '1970-01-01', {}) / 365.25::DOUBLE"
_AHEAD = "date_diff('day', DATE '1970-01-05', {}) / 7::DOUBLE"
SQL["seasonal_forecast"] = _q(FPARAMS + f""",
ls AS MATERIALIZED (SELECT scope, metric, week_start, y, {_AHEAD.format('week_start')} AS t, cos({_ANGLE.format('week_start')}) AS c, sin({_ANGLE.format('week_start')}) AS s FROM lg),
kf AS (SELECT scope, metric, count(*) AS historical_weeks, max(week_start) AS last_week, avg(t) AS mt, avg(c) AS mc, avg(s) AS ms, avg(y) AS my,
  {_det3('ycs')} / {_det3('tcs')} AS kt, {_det3('tys')} / {_det3('tcs')} AS kc, {_det3('tcy')} / {_det3('tcs')} AS ks
  FROM ls GROUP BY scope, metric HAVING count(*) >= 52),
kz AS MATERIALIZED (SELECT *, my - kt * mt - kc * mc - ks * ms AS k1 FROM kf),
sp AS (SELECT scope, metric, sqrt(avg((y - (k1 + kt * t + kc * c + ks * s)) ** 2)) AS spread FROM ls JOIN kz USING (scope, metric) GROUP BY scope, metric),
ah AS (SELECT kz.*, spread, i::INTEGER AS i, CAST(last_week + 7 * i::INTEGER AS DATE) AS week FROM kz JOIN sp USING (scope, metric), range(1, 5) r(i)),
fv AS (SELECT *, k1 + kt * ({_AHEAD.format('week')}) + kc * cos({_ANGLE.format('week')}) + ks * sin({_ANGLE.format('week')}) AS yy FROM ah)
SELECT scope, metric, i, week, historical_weeks, CAST(round_even(greatest(0.0, yy), 0) AS BIGINT) AS predicted,
  CAST(round_even(greatest(0.0, yy - 1.2815515655446004::DOUBLE * spread), 0) AS BIGINT) AS lower_bound,
  CAST(round_even(greatest(0.0, yy + 1.2815515655446004::DOUBLE * spread), 0) AS BIGINT) AS upper_bound,
  round(kt, 4) AS weekly_trend, round(kc * cos({_ANGLE.format('week')}) + ks * sin({_ANGLE.format('week')}), 2) AS seasonal_part
FROM fv
""")
