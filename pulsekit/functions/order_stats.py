"""Exact interpolated percentiles without gathering a group.

Values are first counted in order-preserving bins, of which a group has a
bounded number.  The bins that hold the wanted ranks are known from the running
counts; only values inside those bins are then counted one by one.  Every count
is combined in the tasks before it is shuffled, so neither a hot group nor a hot
value meets in one task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Bins per doubling of 1 + |value|: at most about 2 * 64 * 4096 for all doubles up to 2**64.
BINS = 4096


def _bin(v: Column) -> Column:
    return F.floor(F.signum(v) * F.log2(F.abs(v) + 1) * BINS)


def percentiles(df: DataFrame, keys: list[str], wanted: dict[str, tuple[str, float]]) -> DataFrame:
    """One row per group of ``keys`` with a column per entry of ``wanted``: name -> (column, q).

    Null values are left out; a group without values has nulls.  Interpolates
    between neighbouring ranks as the built-in exact percentile does.
    """
    columns = sorted({c for c, _ in wanted.values()})
    long = (df.select(*keys, F.explode(F.array(*[F.struct(F.lit(c).alias("_c"), F.col(c).cast("double").alias("_v")) for c in columns])).alias("_s"))
            .select(*keys, "_s._c", "_s._v").where(F.col("_v").isNotNull()).withColumn("_b", _bin(F.col("_v"))))
    group = [*keys, "_c"]
    per_bin = long.groupBy(*group, "_b").agg(F.count(F.lit(1)).alias("_n"))
    run = Window.partitionBy(*group).orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    per_bin = (per_bin.withColumn("_to", F.sum("_n").over(run)).withColumn("_all", F.sum("_n").over(Window.partitionBy(*group)))
               .withColumn("_from", F.col("_to") - F.col("_n")))
    asked = F.array(*[F.struct(F.lit(name).alias("name"), F.lit(c).alias("c"), F.lit(float(q)).alias("q")) for name, (c, q) in wanted.items()])
    ranks = (per_bin.withColumn("_a", F.explode(asked)).where(F.col("_a.c") == F.col("_c"))
             .withColumn("_pos", F.col("_a.q") * (F.col("_all") - 1))
             .withColumn("_rank", F.explode(F.array_distinct(F.array(F.floor("_pos"), F.ceil("_pos")))))
             .where((F.col("_rank") >= F.col("_from")) & (F.col("_rank") < F.col("_to")))
             .select(*group, "_b", F.col("_a.name").alias("_name"), "_pos", "_rank", "_from"))
    same = lambda l, r, cols: reduce(lambda a, b: a & b, [l[c].eqNullSafe(r[c]) for c in cols])
    bins = ranks.select(*group, "_b").distinct()
    inside = long.alias("l").join(bins.alias("r"), same(long, bins, [*group, "_b"]), "left_semi")
    per_value = inside.groupBy(*group, "_b", "_v").agg(F.count(F.lit(1)).alias("_n"))
    run = Window.partitionBy(*group, "_b").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    per_value = per_value.withColumn("_to", F.sum("_n").over(run))
    pv = per_value.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate([*group, "_b"])], "_v", "_n", "_to")
    on = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_k{i}")) for i, c in enumerate([*group, "_b"])])
    at = F.col("_rank") - F.col("_from")
    found = ranks.join(pv, on & (at >= F.col("_to") - F.col("_n")) & (at < F.col("_to")))
    # both neighbours of a position, weighted by its distance to the other one
    weight = F.when(F.col("_rank") == F.col("_pos"), 1.0).otherwise(1 - F.abs(F.col("_rank") - F.col("_pos")))
    return found.groupBy(*keys).agg(*[F.sum(F.when(F.col("_name") == name, F.col("_v") * weight)).alias(name) for name in wanted])
