"""Column-expression helpers shared by all operators.

Time model: ``published_at`` is a TIMESTAMP_NTZ holding the UTC wall clock
of the instant.  Calendar fields are taken in KST, a fixed UTC+9 offset, by
plain interval arithmetic, so no result depends on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference configuration for equal results.
# ---------------------------------------------------------------------------
KST_OFFSET_HOURS = 9
MIN_POSTS = 5
VIRAL_MULTIPLIER = 2.5
UNDERPERFORM_THRESHOLD = 0.3
TOP_N = 5
RECENT_DAYS, RECENT_WEIGHT = 90, 1.0
MEDIUM_DAYS, MEDIUM_WEIGHT = 180, 0.3
OLD_WEIGHT = 0.1
ENGAGEMENT_BENCHMARKS = {"instagram": 0.020, "youtube": 0.039, "facebook": 0.014, "tiktok": 0.025}
DEFAULT_BENCHMARK = 0.03
PLATFORM_NAMES = {"instagram": "Instagram", "youtube": "YouTube", "facebook": "Facebook", "tiktok": "TikTok"}
PLATFORM_START = {"instagram": "2025-03-01", "tiktok": "2026-01-06", "youtube": "2025-01-01", "facebook": "2025-01-01"}
QUALITY_WEIGHTS = {"likes": 1, "comments": 3, "shares": 5, "saves": 4}
SCORE_QUALITY_WEIGHTS = {"likes": 1, "comments": 3, "shares": 5, "saves": 4, "link_clicks": 2}
COMPOSITE_WEIGHTS = {"reach": 0.20, "engagement": 0.25, "quality": 0.25, "efficiency": 0.20, "growth": 0.10}
GRADE_CUTS = [(70, "A+"), (55, "A"), (40, "B+"), (30, "B"), (20, "C+"), (12, "C"), (6, "D")]
CONTENT_TYPE_LABELS = {
    "short_video": "Short Video", "long_video": "Long Video", "image": "Image",
    "carousel": "Carousel", "story": "Story", "live": "Live Stream",
    "text_post": "Text Post", "link_post": "Link Post", "other": "Other",
}
DAY_NAMES = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]


def map_lit(d: dict) -> Column:
    """A foldable map literal (a broadcast-free dimension lookup)."""
    kv = []
    for k, v in d.items():
        kv += [F.lit(k), F.lit(v)]
    return F.create_map(*kv)


# ---------------------------------------------------------------------------
# Time
# ---------------------------------------------------------------------------
def kst(ts: Column | str) -> Column:
    """UTC wall clock (NTZ) -> KST wall clock (NTZ)."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return c + F.expr(f"INTERVAL {KST_OFFSET_HOURS} HOURS")


def dow_index(ts_local: Column) -> Column:
    """Monday=0 .. Sunday=6 (Python ``weekday()``)."""
    return F.pmod(F.dayofweek(ts_local) + 5, F.lit(7))


def day_name(ts_local: Column) -> Column:
    return F.element_at(F.array(*[F.lit(d) for d in DAY_NAMES]), (dow_index(ts_local) + 1).cast("int"))


def year_week_sunday(ts_local: Column) -> Column:
    """``strftime('%Y-W%U')``: week of year, Sunday-start, days before the
    first Sunday are week 00."""
    doy = F.dayofyear(ts_local)
    dow0 = F.dayofweek(ts_local) - 1  # Sunday=0
    wk = F.floor((doy + 6 - dow0) / 7).cast("int")
    return F.concat(F.year(ts_local).cast("string"), F.lit("-W"), F.lpad(wk.cast("string"), 2, "0"))


def iso_week(ts_local: Column) -> Column:
    return F.weekofyear(ts_local)


def week_start_monday(ts_local: Column) -> Column:
    """Start (Monday) of the Monday..Sunday week holding ``ts_local`` as a DATE."""
    return F.date_sub(F.to_date(ts_local), dow_index(ts_local).cast("int"))


def epoch_micros(ts: Column) -> Column:
    """Epoch micro-seconds of an NTZ wall clock read as UTC.

    Built from the calendar fields so that no session-zone cast is involved.
    """
    days = F.datediff(F.to_date(ts), F.lit("1970-01-01").cast("date")).cast("long")
    secs = (F.hour(ts) * 3600 + F.minute(ts) * 60).cast("long") * 1_000_000
    frac = (F.extract(F.lit("SECOND"), ts) * 1_000_000).cast("long")
    return days * 86_400_000_000 + secs + frac


def ntz_days(later: Column, earlier: Column) -> Column:
    """(later - earlier) in fractional days for NTZ timestamps."""
    return (epoch_micros(later) - epoch_micros(earlier)) / F.lit(86400e6)


def recency_weight(ts: Column, ref: Column) -> Column:
    """1.0 within 90 days of ``ref``, 0.3 within 180, else (and null) 0.1."""
    d = ntz_days(ref, ts)
    return (F.when(d <= RECENT_DAYS, F.lit(RECENT_WEIGHT))
            .when(d <= MEDIUM_DAYS, F.lit(MEDIUM_WEIGHT))
            .otherwise(F.lit(OLD_WEIGHT)))


# ---------------------------------------------------------------------------
# Aggregates
# ---------------------------------------------------------------------------
def _finite(c: Column) -> Column:
    return c.isNotNull() & ~F.isnan(c)


def wavg(value: Column | str, weight: Column | str = "weight") -> Column:
    """Safe weighted mean: non-finite pairs ignored; 0.0 when empty or
    the weight sum is below 1e-10.  Pure Catalyst -> partial aggregation."""
    v = F.col(value) if isinstance(value, str) else value
    w = F.col(weight) if isinstance(weight, str) else weight
    ok = _finite(v.cast("double")) & _finite(w.cast("double"))
    sw = F.sum(F.when(ok, w))
    swv = F.sum(F.when(ok, v * w))
    return F.when(F.coalesce(sw, F.lit(0.0)) >= 1e-10, swv / sw).otherwise(F.lit(0.0))


def safe_div(num: Column, den: Column, default: float | None = None) -> Column:
    r = num / F.when(den != 0, den)
    return r if default is None else F.coalesce(r, F.lit(default))


def wow_change(cur: Column, prev: Column) -> Column:
    """(cur - prev) / prev rounded to 4 dp; null when prev == 0."""
    return F.round((cur - prev) / F.when(prev != 0, prev), 4)


def trunc_long(c: Column) -> Column:
    """Python ``int(x)``: truncation toward zero."""
    return c.cast("long")


def grade(score: Column) -> Column:
    out = None
    for cut, g in GRADE_CUTS:
        out = F.when(score >= cut, F.lit(g)) if out is None else out.when(score >= cut, F.lit(g))
    return out.otherwise(F.lit("F"))


def content_label(c: Column) -> Column:
    """Slug -> display label; unknown slugs title-cased with spaces."""
    return F.coalesce(F.element_at(map_lit(CONTENT_TYPE_LABELS), c), F.initcap(F.regexp_replace(c, "_", " ")))


def platform_name(c: Column) -> Column:
    return F.coalesce(F.element_at(map_lit(PLATFORM_NAMES), c), c)


def benchmark(c: Column) -> Column:
    return F.coalesce(F.element_at(map_lit(ENGAGEMENT_BENCHMARKS), c), F.lit(DEFAULT_BENCHMARK))


def tie_key_newest_first() -> list[Column]:
    """Deterministic stand-in for the reference's table order (newest first)."""
    return [F.col("published_at").desc_nulls_last(), F.col("platform").asc(), F.col("post_id").asc()]


def distribution_pct(c: Column) -> Column:
    """A 0..1 distribution share -> percentage with 1 dp (null when
    the value is not numeric)."""
    return F.round(c.cast("string").try_cast("double") * 100, 1)


def safe_text(c: Column, max_len: int | None = None) -> Column:
    """HTML-escape a display string (& < > ") and optionally cut it to
    ``max_len`` characters first."""
    t = F.coalesce(c.cast("string"), F.lit(""))
    if max_len:
        t = F.substring(t, 1, max_len)
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        t = F.replace(t, F.lit(a), F.lit(b))
    return t
