r"""Secret scan with corpus-wide ownership frequency.

Every candidate string of every document is hashed.  The hashes are grouped by
distinct repositories and owners over the whole corpus: a string that many
owners hold is a copied example, one that stays with few owners looks live.
The patterns of the three base kinds always report; generic candidates (mixed
letters and digits) are added only where ownership says that they look live.

Only built-in functions run here.  Positions are found by marking the matches
with two private-use characters (any in the text are first replaced by a third,
which no pattern touches) and summing the lengths of the pieces between them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsekit.llm.common import cut, table

#: The kinds in their order, with their patterns.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
GENERIC = r"[A-Za-z0-9+/_-]{24,}"
KINDS = ["assign", "access", "hex", "generic"]
#: A string held by more owners than this counts as a copied example.
MAX_OWNERS = 2

_OPEN, _SHUT, _SPARE = "\ue000", "\ue001", "\ue002"
_SPAN = "array<struct<start:int,kind:int,stop:int,value:string>>"


def _none() -> Column:
    return F.from_json(F.lit("[]"), _SPAN)


def find(text: Column, pattern: str, kind: int, holds) -> Column:
    """Spans of the leftmost matches of ``pattern``; ``holds`` says which matches (by their string) count."""
    marked = F.regexp_replace(F.translate(text, _OPEN + _SHUT, _SPARE * 2), pattern, f"{_OPEN}$0{_SHUT}")
    parts = F.split(marked, f"[{_OPEN}{_SHUT}]", -1)
    start = F.struct(F.lit(0).alias("at"), F.lit(False).alias("inside"), _none().alias("out"))

    def step(acc, part):
        stop = acc["at"] + F.length(part)
        span = F.struct(acc["at"].alias("start"), F.lit(kind).alias("kind"), stop.alias("stop"), part.alias("value"))
        return F.struct(stop.alias("at"), (~acc["inside"]).alias("inside"),
                        F.when(acc["inside"] & holds(part), F.concat(acc["out"], F.array(span))).otherwise(acc["out"]).alias("out"))

    return F.when(F.regexp_like(text, F.lit(pattern)), F.aggregate(parts, start, step)["out"]).otherwise(_none())


def _mixed(s: Column) -> Column:
    return s.rlike("[0-9]") & s.rlike("[A-Z]") & s.rlike("[a-z]")


def _secret(s: Column, kind: Column) -> Column:
    """The secret itself: of an assignment its value, else the whole match."""
    return F.when(kind == 0, F.regexp_extract(s, ASSIGN, 1)).otherwise(s)


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"),
                                                                 s["stop"].cast("string"))), ",")


def scan(docs: DataFrame, repo: Column | None = None, owner: Column | None = None, max_owners: int = MAX_OWNERS) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, lang, source): counts, base spans, all spans with their ownership.

    ``all_spans`` holds (start, kind, stop, value, owners, repos, live).  A null text is
    empty and has no span; a null owner is one owner, a null repository one repository.  Equal rows each get their row.
    """
    owner = F.col("source") if owner is None else owner
    repo = F.struct(F.col("source"), F.col("lang")) if repo is None else repo
    text = F.coalesce(F.col("text"), F.lit(""))
    base = F.concat(find(text, ASSIGN, 0, lambda m: F.length(F.regexp_extract(m, ASSIGN, 1)) >= 12),
                    find(text, ACCESS, 1, lambda m: F.lit(True)), find(text, HEX, 2, lambda m: F.lit(True)))
    found = cut(docs.select("doc_id", F.xxhash64(owner).alias("owner"), F.xxhash64(repo).alias("repo"),
                            F.xxhash64(text, F.length(text)).alias("h"), F.sort_array(base).alias("base"),
                            find(text, GENERIC, 3, _mixed).alias("more")))
    free = F.filter(F.col("more"), lambda g: ~F.exists(F.col("base"), lambda b: (b["start"] < g["stop"]) & (g["start"] < b["stop"])))
    found = found.withColumn("more", free)
    key = ["doc_id", "owner", "h"]
    spans = (found.where((F.size("base") > 0) | (F.size("more") > 0)).dropDuplicates(key)
             .select(*key, "repo", F.explode(F.concat("base", "more")).alias("s"))
             .withColumn("digest", F.sha2(_secret(F.col("s")["value"], F.col("s")["kind"]), 256)))
    # distinct (string, owner, repository) first: a hot string shrinks before it meets its group
    held = (found.where((F.size("base") > 0) | (F.size("more") > 0))
            .select("owner", "repo", F.explode(F.concat("base", "more")).alias("s"))
            .select("owner", "repo", F.sha2(_secret(F.col("s")["value"], F.col("s")["kind"]), 256).alias("digest")).distinct())
    held = held.groupBy("digest", "owner").agg(F.count(F.lit(1)).alias("repos")).groupBy("digest").agg(
        F.count(F.lit(1)).alias("owners"), F.sum("repos").alias("repos"))
    judged = (spans.join(held, "digest")
              .select(*key, F.struct("s.start", "s.kind", "s.stop", "s.value", "owners", "repos",
                                     (F.col("owners") <= max_owners).alias("live")).alias("s"))
              .groupBy(*key).agg(F.sort_array(F.collect_list("s")).alias("all_spans")))
    j = judged.select(F.col("doc_id").alias("_d"), F.col("owner").alias("_o"), F.col("h").alias("_h"), "all_spans")
    on = F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("owner") == F.col("_o")) & (F.col("h") == F.col("_h"))
    return found.join(j, on, "left").select("doc_id", "owner", "h", "base", F.coalesce(
        "all_spans", F.from_json(F.lit("[]"), "array<struct<start:int,kind:int,stop:int,value:string,owners:bigint,repos:bigint,live:boolean>>")
    ).alias("all_spans"))


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = scan(table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source"))
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    shown = F.filter("all_spans", lambda s: (s["kind"] < 3) | s["live"])
    return rows.select("doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
                       F.sha2(_joined(F.col("base")), 256).alias("base_sha256"), _joined(shown).alias("spans"),
                       F.size(F.filter("all_spans", lambda s: s["live"])).cast("long").alias("n_live"),
                       F.size(F.filter("all_spans", lambda s: ~s["live"])).cast("long").alias("n_copied"))


def redact(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """``text`` with each maximal run of overlapping spans (sorted by start) replaced by ``mark``."""
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

    def step(acc, s):
        return F.when(s["stop"] <= acc["at"], acc).when(
            s["start"] < acc["at"], F.struct(acc["out"].alias("out"), s["stop"].alias("at"))).otherwise(
            F.struct(F.concat(acc["out"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit(mark)).alias("out"), s["stop"].alias("at")))

    return let_tail(F.aggregate(spans, start, step), text)


def let_tail(acc: Column, text: Column) -> Column:
    return F.transform(F.array(acc), lambda a: F.concat(a["out"], F.substring(text, a["at"] + 1, F.length(text))))[0]


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: secrets that look live are masked in the text; copied examples and all else stay."""
    cols = docs.columns
    live = (scan(docs.select("doc_id", "text", "lang", "source"))
            .select("doc_id", "owner", "h", F.filter("all_spans", lambda s: s["live"]).alias("live"))
            .where(F.size("live") > 0).dropDuplicates(["doc_id", "owner", "h"])
            .select(F.col("doc_id").alias("_d"), F.col("owner").alias("_o"), F.col("h").alias("_h"), F.col("live").alias("_live")))
    text = F.coalesce(F.col("text"), F.lit(""))
    on = (F.col("doc_id").eqNullSafe(F.col("_d")) & (F.xxhash64("source") == F.col("_o"))
          & (F.xxhash64(text, F.length(text)) == F.col("_h")))
    masked = docs.join(live, on, "left").withColumn(
        "text", F.when(F.col("_live").isNull(), F.col("text")).otherwise(redact(F.col("text"), F.col("_live"))))
    if "n_chars" in cols:
        masked = masked.withColumn("n_chars", F.when(F.col("_live").isNull(), F.col("n_chars")).otherwise(F.length("text").cast("long")))
    return masked.select(*[F.col(f"`{c}`") for c in cols])


_MARKED = "string_split_regex(regexp_replace(translate(t, chr(57344) || chr(57345), chr(57346) || chr(57346)), p, chr(57344) || '\\0' || chr(57345), 'g'), '[' || chr(57344) || chr(57345) || ']')"
SQL_SECRETS = rf"""
WITH pat(kind, name, p) AS (VALUES
  (0, 'assign', '(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)'),
  (1, 'access', 'AKIA[A-Z0-9]+'), (2, 'hex', '[0-9a-f]+'), (3, 'generic', '[A-Za-z0-9+/_-]{{24,}}')),
d AS (SELECT doc_id, lang, source, coalesce(text, '') AS t FROM documents),
pieces AS (SELECT doc_id, lang, source, kind, name, p, {_MARKED} AS parts FROM d, pat),
flat AS (SELECT doc_id, lang, source, kind, name, p, unnest(parts) AS part, generate_subscripts(parts, 1) AS i FROM pieces),
pos AS (SELECT *, sum(length(part)) OVER (PARTITION BY doc_id, kind ORDER BY i) AS stop FROM flat),
hit AS (SELECT doc_id, lang, source, kind, name, stop - length(part) AS start, stop, part,
               CASE WHEN kind = 0 THEN regexp_extract(part, p, 1) ELSE part END AS val FROM pos WHERE i % 2 = 0),
base AS (SELECT * FROM hit WHERE (kind = 0 AND length(val) >= 12) OR (kind = 1 AND length(part) >= 18) OR (kind = 2 AND length(part) >= 16)),
gen AS (SELECT * FROM hit g WHERE kind = 3 AND regexp_matches(part, '[0-9]') AND regexp_matches(part, '[A-Z]') AND regexp_matches(part, '[a-z]')
        AND NOT EXISTS (SELECT 1 FROM base b WHERE b.doc_id = g.doc_id AND b.start < g.stop AND g.start < b.stop)),
cand AS (SELECT * FROM base UNION ALL SELECT * FROM gen),
own AS (SELECT val, count(DISTINCT coalesce(source, chr(0))) AS owners FROM cand GROUP BY val),
judged AS (SELECT c.*, owners <= {MAX_OWNERS} AS live FROM cand c JOIN own USING (val)),
a AS (SELECT doc_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
             string_agg(name || ':' || start || ':' || stop, ',' ORDER BY start, kind) FILTER (kind < 3) AS base,
             string_agg(name || ':' || start || ':' || stop, ',' ORDER BY start, kind) FILTER (kind < 3 OR live) AS spans,
             count(*) FILTER (live) AS n_live, count(*) FILTER (NOT live) AS n_copied FROM judged GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access, coalesce(n_hex, 0)::BIGINT AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_live, 0)::BIGINT AS n_live,
       coalesce(n_copied, 0)::BIGINT AS n_copied
FROM d LEFT JOIN a USING (doc_id)
"""
