"""N1–N12 — vendor export columns -> the unified post schema.

Column resolution (N1) looks only at the frame's column names on the
driver; everything else is one ``select`` of native expressions, so a raw
export of any size is normalised in a single narrow stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulsekit.functions import exprs as X

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference: source specs (candidate
# column names per unified field, first match wins) and the content-type map.
# ---------------------------------------------------------------------------
SOURCE_SPECS: dict[str, dict[str, list[str]]] = {
    "instagram": {
        "post_id": ["post id", "post_id", "id", "content id"],
        "content_type": ["post type", "type", "content type", "media type", "media_type"],
        "published_at": ["publish time", "published", "publish date", "created", "date posted", "post date"],
        "title": ["description", "caption", "title", "post caption", "text"],
        "permalink": ["permalink", "post url", "url", "link"],
        "duration_sec": ["duration (sec)", "duration", "video duration", "duration (seconds)", "duration_sec"],
        "reach": ["reach", "accounts reached"],
        "views": ["views", "video views", "plays", "video plays", "impressions"],
        "likes": ["likes", "like count", "reactions"],
        "comments": ["comments", "comment count"],
        "shares": ["shares", "share count", "sends"],
        "saves": ["saves", "save count", "bookmarks"],
        "followers_gained": ["follows", "new followers", "follows from post", "profile follows", "followers gained"],
        "link_clicks": ["link clicks", "website clicks", "tap link", "website taps", "external link taps"],
    },
    "youtube": {
        "post_id": ["video id", "video_id", "id", "content"],
        "content_type": ["type", "content type", "video type"],
        "published_at": ["published", "publish date", "date", "upload date", "video publish time"],
        "title": ["video title", "title", "content", "video"],
        "reach": ["impressions", "reach"],
        "views": ["views", "video views", "view count"],
        "likes": ["likes", "like count"],
        "comments": ["comments", "comment count"],
        "shares": ["shares", "share count"],
        "saves": ["saves", "added to playlists"],
        "watch_time_sec": ["watch time (hours)", "watch time", "total watch time"],
        "avg_watch_sec": ["average view duration", "avg view duration", "average watch time"],
        "followers_gained": ["subscribers", "subscribers gained", "subs gained"],
        "link_clicks": ["card clicks", "end screen clicks"],
    },
    "facebook": {
        "post_id": ["post id", "post_id", "id"],
        "content_type": ["type", "post type", "content type"],
        "published_at": ["date", "published", "created", "post date", "publish time"],
        "title": ["post message", "message", "title", "description", "caption"],
        "reach": ["reach", "post reach", "impressions", "lifetime post total reach"],
        "views": ["video views", "views"],
        "likes": ["reactions", "likes", "like count", "lifetime post total reactions"],
        "comments": ["comments", "comment count", "lifetime post total comments"],
        "shares": ["shares", "share count", "lifetime post total shares"],
        "link_clicks": ["link clicks", "post clicks", "lifetime post total clicks"],
    },
    "tiktok": {
        "post_id": ["video id", "id", "post_id", "video_id"],
        "content_type": ["type"],
        "published_at": ["date", "post date", "published", "created", "date posted"],
        "title": ["caption", "title", "description", "video description"],
        "reach": ["total views", "views", "video views", "reach"],
        "views": ["total views", "views", "video views"],
        "likes": ["likes", "like count", "diggs"],
        "comments": ["comments", "comment count"],
        "shares": ["shares", "share count"],
        "saves": ["saves", "favorites", "bookmarks"],
        "watch_time_sec": ["total play time", "total watch time"],
        "avg_watch_sec": ["average watch time", "avg watch time"],
        "followers_gained": ["new followers", "followers gained"],
    },
    "tiktok_content": {
        "post_id": ["video link", "video_link"],
        "title": ["video title", "video_title"],
        "permalink": ["video link", "video_link"],
        "published_at": ["post time", "post_time"],
        "likes": ["total likes", "total_likes"],
        "comments": ["total comments", "total_comments"],
        "shares": ["total shares", "total_shares"],
        "views": ["total views", "total_views"],
    },
}

CONTENT_TYPE_MAP = {
    "ig reel": "short_video", "ig carousel": "carousel", "ig image": "image", "ig story": "story",
    "reel": "short_video", "reels": "short_video", "story": "story", "stories": "story",
    "carousel": "carousel", "photo": "image", "image": "image", "igtv": "long_video", "ig_reel": "short_video",
    "video": "long_video", "short": "short_video", "shorts": "short_video", "live": "live",
    "premiere": "long_video",
    "link": "link_post", "status": "text_post", "photo_post": "image", "video_post": "long_video",
    "reel_fb": "short_video",
    "tiktok_video": "short_video",
    "post": "image", "other": "other",
}

NUMERIC_FIELDS = ["reach", "views", "likes", "comments", "shares", "saves", "watch_time_sec",
                  "followers_gained", "link_clicks"]
EXPORT_TZ = "America/Los_Angeles"


def register_source(name: str, spec: dict[str, list[str]]) -> None:
    """Plug in a new export format (user-extensible registry)."""
    SOURCE_SPECS[name] = spec


def build_column_map(columns: list[str], spec: dict[str, list[str]]) -> dict[str, str]:
    """lower/trim match of actual headers against ordered candidates."""
    actual = {}
    for c in columns:
        actual.setdefault(c.lower().strip().lstrip("\ufeff"), c)
    out = {}
    for field, cands in spec.items():
        for cand in cands:
            if cand.lower().strip() in actual:
                out[field] = actual[cand.lower().strip()]
                break
    return out


def content_type_expr(c) -> F.Column:
    """lower+trim, map to the 9 categories, default 'other'."""
    return F.coalesce(F.element_at(X.map_lit(CONTENT_TYPE_MAP), F.lower(F.trim(c.cast("string")))), F.lit("other"))


def number_expr(c) -> F.Column:
    """Non-numeric (incl. 'undefined') -> 0, truncated to an integer."""
    return F.coalesce(F.col(c).cast("string").try_cast("double") if isinstance(c, str) else c.try_cast("double"),
                      F.lit(0.0)).cast("long")


#: Written dates other than ``M/d/yyyy H:mm`` and ISO ones: shape, and the patterns tried on it.
WRITTEN_DATES = [
    (r"^[A-Za-z]{3,9}\.? \d{1,2},? \d{4}", ["MMM d, yyyy", "MMMM d, yyyy", "MMM d yyyy", "MMMM d yyyy"]),
    (r"^\d{1,2} [A-Za-z]{3,9} \d{4}", ["d MMM yyyy", "d MMMM yyyy"]),
    (r"^\d{4}/\d{1,2}/\d{1,2}", ["yyyy/M/d"]),
    (r"^\d{1,2}/\d{1,2}/\d{4}", ["M/d/yyyy"]),
]
_CLOCKS = ["", " H:mm", " H:mm:ss", " h:mm a", " h:mm:ss a"]


def parse_local_time(s: F.Column) -> F.Column:
    """N5 step 1: ``M/d/yyyy H:mm`` first, then ISO-like and written dates, as a
    zone-less wall clock."""
    shape = r"^\s*(\d{1,2})/(\d{1,2})/(\d{4})\s+(\d{1,2}):(\d{2})\s*$"
    g = lambda i: F.regexp_extract(s, shape, i).try_cast("int")
    us = F.when(s.rlike(shape), F.try_make_timestamp_ntz(g(3), g(1), g(2), g(4), g(5), F.lit(0)))
    iso = F.to_timestamp_ntz(F.try_to_timestamp(F.regexp_replace(s, "T", " ")).cast("string"))
    plain = F.regexp_replace(F.regexp_replace(F.trim(s), r"\s+", " "), r"^([A-Za-z]{3,9})\. ", "$1 ")
    written = [F.when(plain.rlike(form), F.coalesce(*[
        F.to_timestamp_ntz(F.try_to_timestamp(plain, F.lit(day + clock)).cast("string")) for day in days for clock in _CLOCKS]))
        for form, days in WRITTEN_DATES]
    return F.coalesce(us, F.when(s.rlike(r"^\s*\d{4}-\d{2}-\d{2}"), iso), *written)


def localize_to_utc(local: F.Column, tz: str = EXPORT_TZ) -> F.Column:
    """N5 step 2: wall clock in ``tz`` -> UTC wall clock; times that do not
    exist (spring-forward gap) or exist twice (fall-back overlap) -> null."""
    utc = F.convert_timezone(F.lit(tz), F.lit("UTC"), local)
    back = F.convert_timezone(F.lit("UTC"), F.lit(tz), utc)
    earlier = F.convert_timezone(F.lit("UTC"), F.lit(tz), utc - F.expr("INTERVAL 1 HOUR"))
    later = F.convert_timezone(F.lit("UTC"), F.lit(tz), utc + F.expr("INTERVAL 1 HOUR"))
    bad = (back != local) | (earlier == local) | (later == local)
    return F.when(~bad, utc)


def normalize_export(df: DataFrame, platform: str, spec: dict[str, list[str]] | None = None,
                     source_col: str | None = None, title_max_chars: int | None = None,
                     export_tz: str = EXPORT_TZ) -> DataFrame:
    """N3 (with N4–N11): one projection to the unified post schema.

    ``title_max_chars=200`` reproduces the reference's caption cut; the
    default keeps whole captions.  ``published_at`` is the UTC wall clock.
    Missing ids get a stable content hash (N7) instead of a row counter.
    """
    spec = spec or SOURCE_SPECS[platform]
    cm = build_column_map(df.columns, spec)

    def col(field):
        return F.col(f"`{cm[field]}`") if field in cm else None

    sel = {}
    if "post_id" in cm:
        pid = col("post_id").cast("string")
        if platform == "tiktok_content":
            pid = F.when(pid.contains("/"), F.element_at(F.split(pid, "/"), -1)).otherwise(pid)
    else:
        pid = None
    stable = F.sha2(F.concat_ws("\u0001", F.lit(platform), *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))
                                                            for c in df.columns]), 256)
    sel["post_id"] = F.coalesce(pid, F.concat(F.lit(f"{platform}_"), F.substring(stable, 1, 16))) if pid is not None \
        else F.concat(F.lit(f"{platform}_"), F.substring(stable, 1, 16))
    plat = "tiktok" if platform == "tiktok_content" else platform
    sel["platform"] = F.lit(plat)
    if platform == "tiktok_content":
        sel["content_type"] = F.lit("short_video")
    else:
        sel["content_type"] = content_type_expr(col("content_type")) if "content_type" in cm else F.lit("other")
    if "published_at" in cm:
        sel["published_at"] = localize_to_utc(parse_local_time(col("published_at").cast("string")), export_tz)
    else:
        sel["published_at"] = F.lit(None).cast("timestamp_ntz")
    t = F.coalesce(col("title").cast("string"), F.lit("")) if "title" in cm else F.lit("")
    t = F.translate(t, "\u2028\u2029", "  ")
    sel["title"] = F.substring(t, 1, title_max_chars) if title_max_chars else t
    sel["permalink"] = F.coalesce(col("permalink").cast("string"), F.lit("")) if "permalink" in cm else F.lit("")
    sel["duration_sec"] = number_expr(col("duration_sec")) if "duration_sec" in cm else F.lit(0).cast("long")
    for f in NUMERIC_FIELDS:
        sel[f] = number_expr(col(f)) if f in cm else F.lit(0).cast("long")
    if platform == "tiktok_content":
        sel["reach"] = sel["views"]
    sel["avg_watch_sec"] = (F.coalesce(col("avg_watch_sec").cast("string").try_cast("double"), F.lit(0.0))
                            if "avg_watch_sec" in cm else F.lit(0.0))
    if source_col:
        sel[source_col] = F.col(source_col)
    out = df.select(*[v.alias(k) for k, v in sel.items()])
    if platform == "youtube" and "watch_time_sec" in cm:
        # A file whose mean watch time is < 1000 is in hours.  Per
        # source file (a size-bounded export) when files are known, else
        # one scalar subquery over the whole frame — never a global window.
        if source_col:
            mean = F.avg("watch_time_sec").over(Window.partitionBy(source_col))
        else:
            mean = out.select(F.avg("watch_time_sec")).scalar()
        out = out.withColumn("watch_time_sec", F.when(mean < 1000, (F.col("watch_time_sec") * 3600).cast("long"))
                             .otherwise(F.col("watch_time_sec")))
    eng = F.col("likes") + F.col("comments") + F.col("shares") + F.col("saves")
    return (out.withColumn("engagement_total", eng)
            .withColumn("engagement_rate", F.when(F.col("reach") > 0, eng / F.col("reach")).otherwise(F.lit(0.0))))


def render_instagram_export(posts: DataFrame, tz: str = EXPORT_TZ) -> DataFrame:
    """Render unified posts as a Meta-style Instagram export (all strings,
    local publish time ``MM/dd/yyyy HH:mm``, ``IG ...`` post types, numbers
    as text with 'undefined' for zero reach) — the inverse of N3, used to
    drive the ingest path from the test tables."""
    local = F.convert_timezone(F.lit("UTC"), F.lit(tz), F.col("published_at"))
    ig_type = X.map_lit({"short_video": "IG reel", "carousel": "IG carousel", "image": "IG image", "story": "IG story",
                         "long_video": "IGTV"})
    return posts.select(
        F.col("post_id").alias("Post ID"), F.lit("1784").alias("Account ID"),
        F.col("title").alias("Description"), F.col("duration_sec").cast("string").alias("Duration (sec)"),
        F.date_format(local, "MM/dd/yyyy HH:mm").alias("Publish time"), F.col("permalink").alias("Permalink"),
        F.coalesce(F.element_at(ig_type, F.col("content_type")), F.col("content_type")).alias("Post type"),
        F.lit("Lifetime").alias("Date"),
        F.col("views").cast("string").alias("Views"),
        F.when(F.col("reach") == 0, F.lit("undefined")).otherwise(F.col("reach").cast("string")).alias("Reach"),
        F.col("likes").cast("string").alias("Likes"), F.col("shares").cast("string").alias("Shares"),
        F.col("followers_gained").cast("string").alias("Follows"), F.col("comments").cast("string").alias("Comments"),
        F.col("saves").cast("string").alias("Saves"))
