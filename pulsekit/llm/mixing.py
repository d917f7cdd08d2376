"""Mixing sources to target weights by systematic sampling.

A source's target divided by its size is the expected number of copies of
each of its documents.  Running that number along the source's documents and
adding one random offset, a document is emitted once per integer boundary that
its step crosses.  Every document thus gets the floor or the ceiling of its
expected copies.  Documents run by size, so each stretch of similar documents
contributes its share and the taken words stay near the target.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsekit.llm.common import cut, n_words, ranked, table

#: A source gives at most this multiple of its own words.
MAX_REPEAT = 3
#: Offsets drawn per source; the one whose take lands nearest to the target is used.
OFFSETS = 16
SEED = "mix-1"


def source_targets(sized: DataFrame, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """(source, source_size, target) from rows with ``source`` and ``size``.

    Sources in code-point order, null last, weigh 1, 2, 3, repeating.  A target
    stops at ``max_repeat`` times its source; the excess goes to the others by
    weight, until none is above.  The level (words per unit of weight) is the
    only value that reaches the driver.  No words at all: every target is 0.
    """
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranks = ranked(sums, [], ["source"], "_rank")
    rows = cut(ranks.select("source", "source_size", ((F.col("_rank") - 1) % 3 + 1).alias("weight"),
                            (F.col("source_size") * max_repeat).alias("cap")))
    total = rows.agg(F.sum("source_size")).first()[0] or 0
    level, held = 0.0, -1
    while True:
        above = F.col("cap") < F.lit(level) * F.col("weight")
        n, capped, weight = rows.agg(F.count_if(above), F.sum(F.when(above, F.col("cap")).otherwise(0)),
                                     F.sum(F.when(above, 0).otherwise(F.col("weight")))).first()
        if n == held or not weight:
            break
        level, held = (total - capped) / weight, n
    target = F.least(F.col("cap").cast("double"), F.lit(float(level)) * F.col("weight"))
    return rows.select("source", "source_size", target.alias("target"))


def _offset(source: Column, j: int) -> Column:
    """Offset ``j`` of a source, in [0, 1)."""
    digest = F.md5(F.concat(F.lit(f"{SEED}:{j}:"), F.coalesce(source, F.lit("\x00null"))))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def _crossed(u: Column) -> Column:
    """Integer boundaries crossed by document ``_k`` of its source at offset ``u``."""
    step = F.floor(F.col("_k") * F.col("_rate") + u) - F.floor((F.col("_k") - 1) * F.col("_rate") + u)
    return F.least(step, F.ceil(F.col("_rate"))).cast("long")


def mix(docs: DataFrame, max_repeat: int = MAX_REPEAT, offsets: int = OFFSETS) -> DataFrame:
    """All rows of ``docs`` (with ``doc_id``, ``source``, ``size``) plus source_size, target, copies, taken.

    Rows with size 0 take no words.  Null sources form one source.  Equal rows
    are counted each for itself.  Empty input: empty output.  Further columns pass through,
    but for any named like an added one, which is replaced.
    """
    docs = docs.drop("source_size", "target", "copies", "taken")
    tie = F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns])
    keep = [F.col(f"`{c}`") for c in docs.columns]
    rows = ranked(docs.withColumn("_tie", tie), ["source"], ["size", "doc_id", "_tie"], "_k")
    targets = source_targets(rows.select("source", "size"), max_repeat)
    t = targets.select(F.col("source").alias("_s"), "source_size", "target",
                       F.coalesce(F.col("target") / F.nullif(F.col("source_size"), F.lit(0)), F.lit(0.0)).alias("_rate"))
    narrow = rows.select("source", "size", "_k").join(t, F.col("source").eqNullSafe(F.col("_s")))
    takes = narrow.groupBy("_s").agg(F.first("target").alias("_t"), *[
        F.sum(F.col("size") * _crossed(_offset(F.col("_s"), j))).alias(f"_o{j}") for j in range(offsets)])
    best = F.array_min(F.array(*[F.struct(F.abs(F.col(f"_o{j}") - F.col("_t")).alias("d"), F.lit(j).alias("j"),
                                          _offset(F.col("_s"), j).alias("u")) for j in range(offsets)]))
    picked = cut(t.join(takes.select(F.col("_s").alias("_s2"), best["u"].alias("_u")), F.col("_s").eqNullSafe(F.col("_s2")))
                 .drop("_s2"))
    copies = _crossed(F.col("_u"))
    return (rows.join(picked, F.col("source").eqNullSafe(F.col("_s")))
            .select(*keep, "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken")))


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", n_words(F.col("text")).alias("size"))
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: every document as often as the mix takes it."""
    cols = docs.columns
    named = docs.select(F.struct(*[F.col(f"`{c}`") for c in cols]).alias("_row"), F.col("doc_id"), F.col("source"),
                        n_words(F.col("text")).alias("size"))
    out = mix(named).where("copies > 0")
    return (out.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
            .select(*[F.col("_row").getField(c).alias(c) for c in cols]))


SQL_MIX = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents),
s0 AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
s AS (SELECT source, source_size, ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::BIGINT AS weight,
             source_size * {MAX_REPEAT} AS cap FROM s0),
lv(step, held, level) AS (
  SELECT 0, -1::BIGINT, 0.0::DOUBLE
  UNION ALL
  SELECT lv.step + 1, x.n, (x.total - x.capped)::DOUBLE / x.weight FROM lv, LATERAL (
    SELECT count(*) FILTER (cap < lv.level * weight) AS n, sum(source_size)::DOUBLE AS total,
           coalesce(sum(cap) FILTER (cap < lv.level * weight), 0)::DOUBLE AS capped,
           sum(weight) FILTER (NOT cap < lv.level * weight)::DOUBLE AS weight FROM s) x
  WHERE x.n <> lv.held AND x.weight > 0),
t AS (SELECT source, source_size, least(cap::DOUBLE, (SELECT arg_max(level, step) FROM lv) * weight) AS target FROM s),
r AS (SELECT d.doc_id, d.size, d.source, t.source_size, t.target,
             CASE WHEN t.source_size = 0 THEN 0.0 ELSE t.target / t.source_size END AS rate,
             row_number() OVER (PARTITION BY d.source ORDER BY d.size, d.doc_id) AS k
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
o AS (SELECT source, j, ('0x' || substr(md5('{SEED}:' || j || ':' || coalesce(source, chr(0) || 'null')), 1, 8))::BIGINT / 4294967296.0 AS u
      FROM t, range({OFFSETS}) g(j)),
c AS (SELECT r.source, o.j, o.u, abs(sum(size * least(floor(k * rate + u) - floor((k - 1) * rate + u), ceil(rate))) - any_value(target)) AS d
      FROM r JOIN o ON r.source IS NOT DISTINCT FROM o.source GROUP BY r.source, o.j, o.u),
p AS (SELECT source, u FROM c QUALIFY row_number() OVER (PARTITION BY source ORDER BY d, j) = 1)
SELECT r.doc_id, r.size, r.source_size, r.target,
       (least(floor(k * rate + u) - floor((k - 1) * rate + u), ceil(rate)) * size)::BIGINT AS taken, r.source,
       least(floor(k * rate + u) - floor((k - 1) * rate + u), ceil(rate))::BIGINT AS copies
FROM r JOIN p ON r.source IS NOT DISTINCT FROM p.source
"""
