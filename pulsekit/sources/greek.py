"""N6 — localised (Greek) ``D Month`` dates without a year, with the
reference's year inference, as window functions over each file's rows.

Rows are ``(file, row_no, value)``.  Windows are partitioned by file — one
export file is a bounded unit (a daily series of at most a few years).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulsekit.functions import exprs as X

# Fixed values that must equal the reference: Greek genitive month names.
GREEK_MONTHS = {
    "ιανουαρίου": 1, "ιανουάριου": 1,
    "φεβρουαρίου": 2, "φεβρουάριου": 2,
    "μαρτίου": 3, "μάρτιου": 3,
    "απριλίου": 4, "απρίλιου": 4,
    "μαΐου": 5, "μαίου": 5,
    "ιουνίου": 6, "ιούνιου": 6,
    "ιουλίου": 7, "ιούλιου": 7,
    "αυγούστου": 8,
    "σεπτεμβρίου": 9, "σεπτέμβριου": 9,
    "οκτωβρίου": 10, "οκτώβριου": 10,
    "νοεμβρίου": 11, "νοέμβριου": 11,
    "δεκεμβρίου": 12, "δεκέμβριου": 12,
}
# Country code -> name (unknown codes map to themselves).
COUNTRY_CODES = {
    "GR": "Greece", "KR": "South Korea", "US": "United States",
    "RO": "Romania", "CY": "Cyprus", "DE": "Germany",
    "AU": "Australia", "GB": "United Kingdom", "CA": "Canada",
    "JP": "Japan", "FR": "France", "IT": "Italy", "ES": "Spain",
    "NL": "Netherlands", "BR": "Brazil", "IN": "India",
    "RS": "Serbia", "BG": "Bulgaria", "ET": "Ethiopia",
    "PH": "Philippines", "EG": "Egypt", "ZA": "South Africa",
    "RU": "Russia", "UA": "Ukraine", "PL": "Poland",
    "GE": "Georgia", "LB": "Lebanon", "Others": "Others",
}
LONG_SERIES_ROWS = 60


def month_expr(word: F.Column) -> F.Column:
    """Exact month-name lookup, else the first name (in table order) sharing
    a 4-character prefix either way."""
    w = F.lower(F.trim(word))
    exact = F.element_at(X.map_lit(GREEK_MONTHS), w)
    pref = None
    for k, v in GREEK_MONTHS.items():
        cond = w.startswith(k[:4]) | F.lit(k).startswith(F.substring(w, 1, 4))
        pref = F.when(cond, F.lit(v)) if pref is None else pref.when(cond, F.lit(v))
    return F.coalesce(exact, pref.otherwise(F.lit(None).cast("int")))


def parse_greek_dates(rows: DataFrame, as_of, file_col: str = "file", order_col: str = "row_no",
                      value_col: str = "value") -> DataFrame:
    """Adds ``date`` (DATE) and ``published_at`` (UTC wall clock of KST
    midnight).  ``as_of`` (a date literal or Column) replaces the wall clock:
    its year ends the series, its month drives the short-series rule."""
    v = F.trim(F.regexp_replace(F.col(value_col).cast("string"), '^"|"$', ""))
    explicit = F.when(v.rlike(r"^\d{4}-\d{1,2}-\d{1,2}"), F.try_to_date(F.substring(v, 1, 10)))
    parts = F.split(v, r"\s+")
    day = F.when(F.size(parts) >= 2, F.element_at(parts, 1).try_cast("int"))
    mon = F.when(F.size(parts) >= 2, month_expr(F.element_at(parts, 2)))
    d = (rows.withColumn("_exp", explicit)
         .withColumn("_m", F.coalesce(F.month("_exp"), F.when(day.isNotNull(), mon)))
         .withColumn("_d", F.coalesce(F.dayofmonth("_exp"), day)))
    valid = F.col("_m").isNotNull()
    asof = F.lit(as_of).cast("date") if not isinstance(as_of, F.Column) else as_of
    end_year, now_month = F.year(asof), F.month(asof)
    fw = Window.partitionBy(file_col)
    d = d.withColumn("_valid", valid)
    ow = Window.partitionBy(file_col, "_valid").orderBy(order_col)
    d = (d.withColumn("_nvalid", F.sum(F.col("_valid").cast("int")).over(fw))
         .withColumn("_prev", F.lag("_m").over(ow))
         .withColumn("_wrap", F.coalesce((F.col("_valid") & (F.col("_m") < F.col("_prev") - 1)).cast("int"), F.lit(0)))
         .withColumn("_wraps_total", F.sum("_wrap").over(fw))
         .withColumn("_wraps_run", F.sum(F.when(F.col("_exp").isNull(), F.col("_wrap")).otherwise(0))
                     .over(ow.rowsBetween(Window.unboundedPreceding, 0))))
    long_year = end_year - F.col("_wraps_total") + F.col("_wraps_run")
    short_year = end_year - F.when(F.col("_m") > now_month + 2, 1).otherwise(0)
    year = F.when(F.col("_exp").isNotNull(), F.year("_exp")).when(
        F.col("_nvalid") >= LONG_SERIES_ROWS, long_year).otherwise(short_year)
    date = F.when(F.col("_valid"), F.try_make_timestamp_ntz(year, F.col("_m"), F.col("_d"), F.lit(0), F.lit(0), F.lit(0)))
    return (d.withColumn("date", F.to_date(date))
            .withColumn("published_at", date - F.expr(f"INTERVAL {X.KST_OFFSET_HOURS} HOURS"))
            .drop("_exp", "_m", "_d", "_valid", "_nvalid", "_prev", "_wrap", "_wraps_total", "_wraps_run"))


def render_greek_month(month: int) -> str:
    """Display spelling (first table spelling, capitalised) of a month."""
    for k, v in GREEK_MONTHS.items():
        if v == month:
            return k.capitalize()
    raise ValueError(month)


def render_greek_date(date: F.Column) -> F.Column:
    """``D Month`` in Greek genitive (first spelling per month), no year."""
    first = {}
    for k, v in GREEK_MONTHS.items():
        first.setdefault(v, k)
    names = F.element_at(X.map_lit({m: n.capitalize() for m, n in first.items()}), F.month(date))
    return F.concat_ws(" ", F.dayofmonth(date).cast("string"), names)


def country_name(code: F.Column) -> F.Column:
    """ISO code -> name, unknown codes kept."""
    c = F.trim(code.cast("string"))
    return F.coalesce(F.element_at(X.map_lit(COUNTRY_CODES), c), c)
