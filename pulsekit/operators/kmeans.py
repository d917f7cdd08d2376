"""Exact k-means per platform (M7, M17, M20): hash-drawn seeding and Lloyd rounds in integers.

Points are integer vectors; equal ones are one node with a count.  Seeds are drawn as k-means++ draws them
(each with a chance in proportion to its squared distance to the seeds before it), but by
hashes of the vectors: every node runs a race with an exponential time, and the fastest wins.  All
platforms and restarts go together, so a step is one scan with partial sums per task, and results
depend on neither layout nor order.  Centres are the floors of their nodes' means; the
restart of the least total squared distance wins, ties to the first.

Only centres reach the driver: platforms x restarts x k x dimension numbers.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from pulsekit.session import cut_lineage

RESTARTS = 10
ROUNDS = 20
#: Fixed-point scale of features and vector components.
SCALE = 1 << 16

Centres = dict[str | None, list[np.ndarray]]          # per platform: the centres of each restart


def node_key(x: Column) -> Column:
    return F.md5(F.concat_ws(",", F.transform(x, lambda v: v.cast("string"))))


def nodes_of(points: DataFrame, vectors: DataFrame | None = None) -> DataFrame:
    """(platform, key, x, n) of points (platform, x array<long>), narrow and checkpointed; with ``vectors`` (key, x), of points (platform, key)."""
    if vectors is not None:
        return cut_lineage(points.groupBy("platform", "key").agg(F.count(F.lit(1)).alias("n")).join(vectors, "key").select("platform", "key", "x", "n"))
    return cut_lineage(points.groupBy("platform", "x").agg(F.count(F.lit(1)).alias("n")).select("platform", node_key(F.col("x")).alias("key"), "x", "n"))


def _uniform(text: Column) -> Column:
    """A number between 0 and 1 from the first 32 bits of a text's MD5."""
    return (F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") + 1) / F.lit(2.0 ** 32 + 1)


def _by_platform(batch: pa.RecordBatch) -> Iterator[tuple[str | None, np.ndarray, np.ndarray, np.ndarray]]:
    """Per platform of a batch: places, integer vectors, counts."""
    if not batch.num_rows:
        return
    names = batch.column("platform").dictionary_encode(null_encoding="encode")
    of = names.indices.to_numpy()
    x = batch.column("x").flatten().to_numpy().reshape(batch.num_rows, -1) if _even(batch.column("x")) else None
    n = batch.column("n").to_numpy() if "n" in batch.schema.names else np.ones(batch.num_rows, np.int64)
    for i, p in sorted(enumerate(names.dictionary.to_pylist()), key=lambda e: str(e[1])):
        at = np.flatnonzero(of == i)
        yield p, at, x[at] if x is not None else np.array(batch.column("x").take(pa.array(at)).to_pylist(), np.int64).reshape(len(at), -1), n[at]


def _even(x: pa.Array) -> bool:
    """Whether all vectors of a batch have one length."""
    return not x.null_count and len(set(np.diff(x.offsets.to_numpy()).tolist())) == 1


def _squares(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of integer rows."""
    reach = float(np.abs(x).max(initial=0)) + float(np.abs(c).max(initial=0))
    if reach * reach * max(1, x.shape[1]) < 2.0 ** 53:
        a, b = x.astype(np.float64), c.astype(np.float64)
        return ((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)[None, :]).astype(np.int64)
    return np.stack([((x - row) ** 2).sum(1) for row in c], axis=1)


def _nearest(x: np.ndarray, centres: list[np.ndarray]) -> Iterator[np.ndarray]:
    """The nearest centre (ties: the lowest) of every vector, for one set of centres after the other; distances to all are taken at once."""
    if centres and all(len(c) for c in centres):
        d = _squares(x, np.concatenate(centres))
        for c, end in zip(centres, np.cumsum([len(c) for c in centres])):
            yield d[:, end - len(c):end].argmin(axis=1)


def _draw(seeds: Centres, wanted: dict[str | None, int], step: int):
    """Per task and (platform, restart): the node that wins the race for seed number ``step``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[tuple, tuple] = {}
        for b in batches:
            keys, uniform = b.column("key"), b.column("u").flatten().to_numpy().reshape(b.num_rows, -1)
            for p, at, x, n in _by_platform(b):
                if wanted.get(p, 0) <= step:
                    continue
                u = uniform[at]
                for r, chosen in enumerate(seeds[p]):
                    if len(chosen) < step:
                        continue
                    weight = n.astype(np.float64) if not step else n * _squares(x, chosen).min(axis=1).astype(np.float64)
                    ok = weight > 0
                    if ok.any():
                        time = np.where(ok, -np.log(u[:, r]) / np.where(ok, weight, 1.0), np.inf)
                        i = min(np.flatnonzero(time == time.min()).tolist(), key=lambda j: keys[int(at[j])].as_py())
                        found = (time[i], keys[int(at[i])].as_py(), x[i].tolist())
                        best[p, r] = min(best.get((p, r), found), found)
        rows = [(p, r, *v) for (p, r), v in best.items()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * 5, [
            pa.string(), pa.int32(), pa.float64(), pa.string(), pa.list_(pa.int64())])], ["platform", "r", "time", "key", "x"])
    return run


def draw_seeds(nodes: DataFrame, wanted: dict[str | None, int], restarts: int = RESTARTS) -> Centres:
    """Seeds of each restart; fewer than wanted where a platform has fewer nodes."""
    seeds: Centres = {p: [np.zeros((0, 0), np.int64)] * restarts for p in wanted}
    for step in range(max(wanted.values(), default=0)):
        u = F.array(*[_uniform(F.concat(F.lit(f"{r}:{step}:"), F.col("key"))) for r in range(restarts)])
        won = (nodes.withColumn("u", u).mapInArrow(_draw(seeds, wanted, step), "platform string, r int, time double, key string, x array<long>")
               .groupBy("platform", "r").agg(F.min(F.struct("time", "key", "x")).alias("w")).collect())
        for row in won:
            old = seeds[row["platform"]][row["r"]]
            new = np.array([row["w"]["x"]], np.int64)
            seeds[row["platform"]][row["r"]] = np.vstack([old, new]) if len(old) else new
    return seeds


def _sums(centres: Centres):
    """Per task: node counts and component sums of every cluster of every restart."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = {p: [np.zeros((len(c), c.shape[1] + 1), np.int64) for c in cs] for p, cs in centres.items()}
        for b in batches:
            for p, _, x, n in _by_platform(b):
                for r, (c, near) in enumerate(zip(centres.get(p, []), _nearest(x, centres.get(p, [])))):
                    for i in range(len(c)):
                        mine = near == i
                        total[p][r][i, 0] += n[mine].sum()
                        total[p][r][i, 1:] += n[mine] @ x[mine]
        rows = [(p, r, i, t.tolist()) for p, ts in total.items() for r, m in enumerate(ts) for i, t in enumerate(m) if t[0]]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * 4, [
            pa.string(), pa.int32(), pa.int32(), pa.list_(pa.int64())])], ["platform", "r", "i", "total"])
    return run


def _costs(centres: Centres):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cost = {(p, r): 0 for p, cs in centres.items() for r in range(len(cs))}
        for b in batches:
            for p, _, x, n in _by_platform(b):
                for r, c in enumerate(centres.get(p, [])):
                    cost[p, r] += int((_squares(x, c).min(axis=1).astype(object) * n.astype(object)).sum())
        yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in cost], pa.string()), pa.array([k[1] for k in cost], pa.int32()),
                                          pa.array([Decimal(v) for v in cost.values()], pa.decimal128(38, 0))], ["platform", "r", "cost"])
    return run


def fit(nodes: DataFrame, wanted: dict[str | None, int], restarts: int = RESTARTS, rounds: int = ROUNDS) -> dict[str | None, np.ndarray]:
    """The best restart's centres per platform, for ``wanted`` clusters of each; at most ``rounds`` rounds."""
    centres = draw_seeds(nodes, wanted, restarts)
    nodes = nodes.select("platform", "x", "n")            # no names in the rounds
    for _ in range(rounds if wanted else 0):
        sums = (nodes.mapInArrow(_sums(centres), "platform string, r int, i int, total array<long>")
                .select("platform", "r", "i", F.posexplode("total").alias("place", "v")).groupBy("platform", "r", "i", "place").agg(F.sum("v").alias("v")))
        found: dict[tuple, dict[int, int]] = {}
        for row in sums.collect():
            found.setdefault((row["platform"], row["r"], row["i"]), {})[row["place"]] = row["v"]
        new = {p: [c.copy() for c in cs] for p, cs in centres.items()}
        for (p, r, i), v in found.items():
            new[p][r][i] = [v[j + 1] // v[0] for j in range(len(v) - 1)]      # an empty cluster keeps its centre
        same = all((a == b).all() for p in centres for a, b in zip(centres[p], new[p]))
        centres = new
        if same:
            break
    costs: dict[str | None, tuple] = {}
    if wanted:
        for row in nodes.mapInArrow(_costs(centres), "platform string, r int, cost decimal(38,0)").groupBy("platform", "r").agg(F.sum("cost").alias("cost")).collect():
            costs[row["platform"]] = min(costs.get(row["platform"], (row["cost"], row["r"])), (row["cost"], row["r"]))
    return {p: centres[p][r] for p, (_, r) in costs.items()}


def assign(nodes: DataFrame, centres: dict[str | None, np.ndarray]) -> DataFrame:
    """(platform, key, cluster, distance): each node's nearest centre (ties: the lowest) and the squared distance."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = b.column("key").to_pylist()
            for p, at, x, _ in _by_platform(b):
                if p in centres:
                    d = _squares(x, centres[p])
                    yield pa.RecordBatch.from_pydict({"platform": pa.array([p] * len(at), pa.string()), "key": [keys[i] for i in at],
                                                      "cluster": pa.array(d.argmin(axis=1), pa.int32()), "distance": pa.array(d.min(axis=1), pa.int64())})
    return nodes.mapInArrow(run, "platform string, key string, cluster int, distance long")


def cluster(points: DataFrame, k, least: int = 1, restarts: int = RESTARTS, rounds: int = ROUNDS, vectors: DataFrame | None = None) -> DataFrame:
    """``points`` (platform, x array<long>, ...) with ``cluster`` and ``distance``; ``k`` gives the clusters for a platform's number
    of points, and platforms with fewer than ``least`` points are left out.  Instead of its vector a point may carry
    ``key``, the ``node_key`` of its vector in ``vectors`` (key, x); it stays out of the result."""
    sizes = {r["platform"]: r["c"] for r in points.groupBy("platform").agg(F.count(F.lit(1)).alias("c")).collect()}
    wanted = {p: k(n) for p, n in sizes.items() if n >= least}
    nodes = nodes_of(points.select("platform", "x" if vectors is None else "key"), vectors)
    centres = fit(nodes, wanted, restarts, rounds)
    if vectors is None:
        return _placed(points, centres)
    found = assign(nodes, centres).select(F.col("platform").alias("_p"), F.col("key").alias("_k"), "cluster", "distance")
    keyed = points.withColumnRenamed("key", "_key")
    return keyed.join(found, F.col("platform").eqNullSafe(F.col("_p")) & (F.col("_key") == F.col("_k"))).drop("_key", "_p", "_k")


def _placed(points: DataFrame, centres: dict[str | None, np.ndarray]) -> DataFrame:
    """``points`` of the platforms that have centres, with ``cluster`` and ``distance``: centres are few, so no join is needed."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            near, far = np.full(b.num_rows, -1, np.int32), np.zeros(b.num_rows, np.int64)
            for p, at, x, _ in _by_platform(b.select(["platform", "x"])):
                if p in centres:
                    d = _squares(x, centres[p])
                    near[at], far[at] = d.argmin(axis=1), d.min(axis=1)
            kept = pa.RecordBatch.from_arrays([*b.columns, pa.array(near), pa.array(far)], [*b.schema.names, "cluster", "distance"])
            yield kept.filter(pa.array(near >= 0))

    return points.mapInArrow(run, StructType([*points.schema.fields, StructField("cluster", IntegerType()), StructField("distance", LongType())]))
