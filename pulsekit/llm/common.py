"""Helpers shared by the corpus operators."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from pulsekit.session import cut_lineage, ensure_checkpoint_dir, release, shuffles_deleted

#: A word: a run of characters other than space, tab, LF, VT, FF and CR.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_batches(df: DataFrame, rows: int = 1000) -> DataFrame:
    """``df``, with fewer rows per Arrow batch where the session leaves that open.

    Batches are counted in rows; with whole texts, ten thousand rows can be a gigabyte.
    """
    spark, key = df.sparkSession, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) == 10_000 and not spark.sparkContext.getConf().contains(key):
        spark.conf.set(key, rows)
    return df


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage of a narrow table in the shared checkpoint folder."""
    return cut_lineage(df)


def materialise(df: DataFrame) -> DataFrame:
    """Write a wide table as Parquet in the shared folder and read it back.

    Columnar and compressed, so it suits tables with whole texts better than
    ``checkpoint()``.  The folder carries the application id and may be
    deleted when the application has ended.  Shuffle files of the write go as
    soon as it ends: nothing reads them again.
    """
    spark = df.sparkSession
    at = f"{ensure_checkpoint_dir(spark)}/llm-{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
    with shuffles_deleted(spark):
        df.write.parquet(at)
    return spark.read.schema(df.schema).parquet(at)


def discard(df: DataFrame) -> None:
    """Delete the files behind a frame of ``materialise`` that nothing reads any more."""
    sc = df.sparkSession.sparkContext
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if f"/llm-{sc.applicationId}/" in folder:
            path = sc._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row, also inside lambdas."""
    return F.transform(F.array(value), body)[0]


def word_array(text: Column) -> Column:
    """Words of a text (null: none) as an array."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), GAP), lambda w: w != "")


def n_words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def ranked(df: DataFrame, by: list[str], order: list[str], name: str = "rank") -> DataFrame:
    """Number the rows from 1 within ``by`` in the order of ``order``, whatever the group sizes.

    Rows are range-partitioned on (by, order), so one group may span many
    tasks.  Only the row counts per (group, partition) are then accumulated:
    a group has at most as many of those as there are partitions.
    """
    keys = [*by, *order]
    out = materialise(df.repartitionByRange(*[F.col(c).asc_nulls_last() for c in keys])
                      .sortWithinPartitions(*[F.col(c).asc_nulls_last() for c in keys])
                      .withColumn("_at", F.monotonically_increasing_id()))
    out = out.withColumn("_part", F.shiftright("_at", 33))
    parts = out.groupBy(*by, "_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    before = W.partitionBy(*by).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    parts = parts.withColumn("_base", F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first") + 1)
    parts = parts.select(*[F.col(c).alias(f"_by_{c}") for c in by], F.col("_part").alias("_p"), "_base")
    on = F.col("_part") == F.col("_p")
    for c in by:
        on = on & F.col(c).eqNullSafe(F.col(f"_by_{c}"))
    return out.join(parts, on).select(*[F.col(f"`{c}`") for c in df.columns], (F.col("_base") + F.col("_at")).alias(name))


def components(edges: DataFrame, rounds: int = 64) -> DataFrame:
    """Connected components of undirected ``edges`` (a, b): one row (node, label) with the smallest node.

    Alternates hooking (every node takes the smallest label next to it) and
    pointer jumping (it takes its label's label), so the rounds grow with the
    logarithm of a component's diameter.  Each step is a grouped minimum with
    partial aggregation: a hub's neighbours never meet in one task.  After a round
    an edge stands between the labels of its ends, once, and inside a tree not at
    all: the links within a group are gone after the first round.  Broadcasts and shuffles of a round are released
    before the next one, so that the driver holds those of one round however many there are.
    """
    live = cut(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = cut(live.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")))
    for _ in range(rounds):
        release(edges.sparkSession)
        seen = cut(live.join(labels.select(F.col("node").alias("b"), F.col("label").alias("lb")), "b").select("a", "lb").distinct()
                   .join(labels.select(F.col("node").alias("a"), F.col("label").alias("la")), "a").where("la <> lb"))
        near = seen.groupBy(F.col("a").alias("node")).agg(F.min("lb").alias("near"))
        hooked = (labels.join(near, "node", "left")
                  .select("node", "label", F.least("label", "near").alias("low")))
        # the old label's node hooks too, so whole trees move at once
        lift = hooked.groupBy(F.col("label").alias("node")).agg(F.min("low").alias("lift"))
        new = cut(hooked.join(lift, "node", "left")
                  .select("node", F.col("label").alias("old"), F.least("low", F.coalesce("lift", "low")).alias("label")))
        jumped = cut(new.join(new.select(F.col("node").alias("label"), F.col("label").alias("up")), "label", "left")
                     .select("node", "old", F.least("label", F.coalesce("up", "label")).alias("label")))
        labels = jumped.select("node", "label")
        if jumped.where("label < old").isEmpty():
            return labels
        live = seen.select(F.col("la").alias("a"), F.col("lb").alias("b")).distinct()
    raise RuntimeError(f"components did not settle in {rounds} rounds")


def joined(labels: DataFrame, edges: DataFrame) -> DataFrame:
    """``components`` of the edges behind ``labels`` and further ``edges`` (a, b): one row (node, label).

    Only the labels that new edges connect are put together; nothing is read again of the edges behind ``labels``.
    """
    at = lambda c: (F.col("node").alias(c), F.col("label").alias(f"l{c}"))
    ends = (edges.select("a", "b").join(labels.select(*at("a")), "a", "left").join(labels.select(*at("b")), "b", "left")
            .select(F.coalesce("la", "a").alias("a"), F.coalesce("lb", "b").alias("b")).where("a <> b").distinct())
    ends = cut(ends)
    if ends.isEmpty():
        return labels
    moved = components(ends).select(F.col("node").alias("label"), F.col("label").alias("to"))
    # a node that no label stood for so far is among the moved ones by its own name
    both = labels.join(moved, "label", "full").select(F.coalesce("node", "label").alias("node"), F.coalesce("to", "label").alias("label"))
    return cut(both)
