"""Exact top-k inner-product search by tiles.

Vectors are packed into shards, queries into tiles (binary matrices of bounded
size).  Every tile meets every shard once: one matrix product, a partial
selection of the k best per query, and a running merge of the tile's list over
the shards of one task.  The lists of a query then merge in a tree of fixed
fan-in.  A stated query set meets all rows in blocks; no pair of rows is emitted
beyond k per query and task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from pulsekit.llm.common import materialise, table

K = 20
SHARD_ROWS = 4096
TILE_ROWS = 1024
#: Lists of a query that meet in one merge.
FAN_IN = 64


def quantised(vectors: DataFrame, scale: int = 64) -> DataFrame:
    """(vec_id, v array<long>): floor(scale * x) per component; vectors null or with null or non-finite components go."""
    x = F.col("embedding")
    ok = x.isNotNull() & F.forall(x, lambda c: F.coalesce(~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf")), F.lit(False)))
    return vectors.where(ok & F.col("vec_id").isNotNull()).select(
        "vec_id", F.transform(x, lambda c: F.floor(F.lit(float(scale)) * c.cast("double"))).alias("v"))


def _packed(rows: DataFrame, size: int, name: str) -> DataFrame:
    """Blocks of at most ``size`` rows: (name, dim, n, ids, mat), with ids and mat as little-endian int64 bytes."""

    def pack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext
        part, n = TaskContext.get().partitionId(), 0
        left: dict[int, tuple[list, list]] = {}

        def block(dim):
            nonlocal n
            ids, mat = left.pop(dim)
            n += 1
            return pd.DataFrame({name: [(part << 32) + n], "dim": [dim], "ids": [np.array(ids, "<i8").tobytes()],
                                 "mat": [np.array(mat, "<i8").tobytes()]})

        for frame in frames:
            for i, v in zip(frame["vec_id"], frame["v"]):
                ids, mat = left.setdefault(len(v), ([], []))
                ids.append(i)
                mat.append(v)
                if len(ids) == size:
                    yield block(len(v))
        for dim in list(left):
            yield block(dim)

    return rows.mapInPandas(pack, f"{name} long, dim int, ids binary, mat binary")


def _scores(q: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Exact integer products: in doubles where they fit 53 bits, else in 64-bit integers."""
    if q.shape[1] == 0:
        return np.zeros((len(q), len(m)), np.int64)
    if float(np.abs(q).max(initial=0)) * float(np.abs(m).max(initial=0)) * q.shape[1] < 2.0 ** 53:
        return (q.astype(np.float64) @ m.T.astype(np.float64)).astype(np.int64)
    return q @ m.T


def _best(score: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best of each row by (score down, id up); ids is (rows, n); an id of -2**63 is no candidate."""
    if score.shape[1] > 4 * k:
        # partial selection: everything at or above the k-th score stays, so ties at the edge are all seen
        floor = np.partition(score, score.shape[1] - k, axis=1)[:, score.shape[1] - k]
        keep = score >= floor[:, None]
        n = max(k, int(keep.sum(axis=1).max()))
        order = np.argsort(~keep, axis=1, kind="stable")[:, :n]
        score, ids = np.take_along_axis(score, order, 1), np.take_along_axis(ids, order, 1)
    order = np.lexsort((ids, -score.astype(np.float64) if score.dtype != np.int64 else ~score), axis=1)[:, :k]
    return np.take_along_axis(score, order, 1), np.take_along_axis(ids, order, 1)


NONE = np.iinfo(np.int64).min


def _search(k: int):
    """Per (tile, run of shards): running top lists."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, qi, q, best = None, None, None, None

        def lists():
            score, ids = best
            keep = ids != NONE
            n = keep.sum(axis=1)
            return pd.DataFrame({"query_id": np.repeat(qi, n), "vec_id": ids[keep], "score": score[keep], "run": at[1]})

        for frame in frames:
            for row in frame.itertuples(index=False):
                if at != (row.tile, row.run):
                    if at is not None:
                        yield lists()
                    at = (row.tile, row.run)
                    qi = np.frombuffer(row.tile_ids, "<i8")
                    q = np.frombuffer(row.tile_mat, "<i8").reshape(len(qi), row.dim)
                    best = (np.full((len(qi), 0), NONE), np.full((len(qi), 0), NONE))
                ids = np.frombuffer(row.ids, "<i8")
                score = _scores(q, np.frombuffer(row.mat, "<i8").reshape(len(ids), row.dim))
                own = qi[:, None] == ids[None, :]
                score[own] = NONE
                cand = np.where(own, NONE, np.broadcast_to(ids, score.shape))
                s, i = _best(score, cand, k)
                best = _best(np.hstack([best[0], s]), np.hstack([best[1], i]), k)
        if at is not None:
            yield lists()

    return run


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K, scale: int = 64) -> DataFrame:
    """Per query row its k best other rows: (query_id, rank, vec_id, score), ties to the smaller vec_id.

    ``vectors`` and ``queries`` hold (vec_id, embedding).  Only vectors of a query's own
    length are its candidates.  Null or non-finite vectors and null ids take no part; a
    query's own id is no candidate; a repeated vec_id stands once per (id, vector).  Fewer
    than k candidates: all of them.  Empty input: no rows.
    """
    spark = vectors.sparkSession
    n_runs = 4 * max(1, spark.sparkContext.defaultParallelism)
    shards = materialise(_packed(quantised(vectors, scale).distinct(), SHARD_ROWS, "shard")
                         .withColumn("run", F.pmod(F.xxhash64("shard"), F.lit(n_runs))))
    tiles = _packed(quantised(queries, scale).distinct(), TILE_ROWS, "tile")
    runs = shards.groupBy("dim").agg(F.collect_set("run").alias("runs"))  # at most n_runs numbers per length
    sent = (tiles.join(runs, "dim").select("tile", "dim", F.col("ids").alias("tile_ids"), F.col("mat").alias("tile_mat"),
                                           F.explode("runs").alias("run")))
    # The merge join streams tiles and holds a run's shards, so a tile's lists stay together;
    # in any other order the lists are only emitted more often.
    pairs = sent.hint("merge").join(shards.select("dim", "run", "shard", "ids", "mat"), ["dim", "run"])
    lists = pairs.mapInPandas(_search(k), "query_id long, vec_id long, score long, run long").distinct()
    best = W.partitionBy("query_id", "at").orderBy(F.col("score").desc(), "vec_id")
    lists = lists.withColumn("at", F.floor(F.col("run") / FAN_IN))
    while n_runs > FAN_IN:
        lists = lists.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).drop("rank")
        lists, n_runs = lists.withColumn("at", F.floor(F.col("at") / FAN_IN)), -(-n_runs // FAN_IN)
    last = W.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (lists.withColumn("rank", F.row_number().over(last)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def op8_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return top_k(rows, rows.where(F.col("vec_id") % 20 == 0))


SQL_TOP_K = f"""
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0)
SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score,
       (row_number() OVER (PARTITION BY q.vec_id ORDER BY list_dot_product(q.v, c.v) DESC, c.vec_id))::INTEGER AS rank
FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 20 = 0
QUALIFY rank <= {K}
"""
