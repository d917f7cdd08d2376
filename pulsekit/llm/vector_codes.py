"""Vector code compression: product codes whose nearest entries are found in a GNAT.

Vectors become integers and are cut into equal parts; each part position has a codebook.
The entries of a codebook stand in a geometric near-neighbour access tree: a node has
split points, every other entry of the node belongs to its nearest split point, and each
split point keeps the range of its distances to the entries of each child.  A query's
distance to one split point thus rules out every child whose range its radius does not
reach.  Ranges are widened and comparisons are strict, so an entry at the same distance as the
best is never lost, and the choice among such entries is made on integer distances.

Codebooks are small and of fixed size (entries x dimension), so they pass through the driver;
vectors never do.  A round is one scan with partial sums per task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsekit.llm.common import materialise, table

ENTRIES = 256
PARTS = 4
ROUNDS = 4
SCALE = 1024
#: Split points of a node, and entries up to which a node is a leaf.
DEGREE = 16
LEAF = 6
#: Vectors searched at once.
CHUNK = 8192
#: Integer components beyond this could overflow sums of squares in 64 bits.
LIMIT = 1 << 26
#: Relative slack that exceeds the rounding of a square root and of one difference.
SLACK = 2.0 ** -49


def part_bounds(dim: int, parts: int) -> list[int]:
    """Where the consecutive parts begin; the first ones are longer where ``dim`` does not divide."""
    return np.cumsum([0, *[dim // parts + (i < dim % parts) for i in range(parts)]]).tolist()


def _distances(q: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Exact squared distances of 64-bit integer rows."""
    out = np.empty((len(q), len(p)), np.int64)
    for j, row in enumerate(p):
        d = q - row
        out[:, j] = (d * d).sum(1)
    return out


class Queries:
    """Rows to search for, with exact distances to entries: one product in doubles where all its terms fit 53 bits."""

    def __init__(self, q: np.ndarray, points: np.ndarray):
        self.q, self.points = q, points
        reach = float(np.abs(q).max(initial=0)) + float(np.abs(points).max(initial=0))
        self.small = reach * reach * max(1, q.shape[1]) < 2.0 ** 53
        if self.small:
            self.qf, self.pf = q.astype(np.float64), points.astype(np.float64)
            self.qn, self.pn = (self.qf * self.qf).sum(1), (self.pf * self.pf).sum(1)

    def to(self, rows: np.ndarray, entries: np.ndarray) -> np.ndarray:
        if not self.small:
            return _distances(self.q[rows], self.points[entries])
        d = self.qf[rows] @ (-2 * self.pf[entries].T)
        d += self.qn[rows, None]
        d += self.pn[entries]
        return d.astype(np.int64)


class Gnat:
    """A geometric near-neighbour access tree over the integer rows of a codebook."""

    def __init__(self, points: np.ndarray, degree: int = DEGREE, leaf: int = LEAF):
        self.points, self.degree, self.leaf = points, degree, leaf
        self.between = _distances(points, points) if len(points) else np.zeros((0, 0), np.int64)
        #: distances computed by ``nearest`` so far
        self.computed = 0
        self.root = self._node(np.arange(len(points)))

    def _node(self, at: np.ndarray) -> dict:
        if len(at) <= self.leaf:
            return {"leaf": at}
        # split points: each the farthest from those chosen before
        split, near = [0], self.between[at[0], at].copy()
        while len(split) < min(self.degree, max(2, len(at) // 3)):
            far = int(near.argmax())
            if not near[far]:
                break                                  # the others equal a chosen one
            split.append(far)
            near = np.minimum(near, self.between[at[far], at])
        if len(split) == 1:
            return {"leaf": at}
        d = self.between[np.ix_(at[split], at)]
        owner = d.argmin(axis=0)
        owner[split] = np.arange(len(split))
        rest = np.ones(len(at), bool)
        rest[split] = False
        low, high = np.empty((len(split),) * 2), np.empty((len(split),) * 2)
        for j in range(len(split)):
            mine = np.sqrt(d[:, owner == j].astype(np.float64))       # the split point itself among them
            low[:, j], high[:, j] = mine.min(axis=1) * (1 - SLACK), mine.max(axis=1) * (1 + SLACK)
        return {"split": at[split], "low": low, "high": high,
                "children": [self._node(at[rest & (owner == j)]) for j in range(len(split))]}

    def nearest(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest entry of each row (ties: the lowest index) and the squared distance."""
        best = np.full(len(q), np.iinfo(np.int64).max)
        index = np.full(len(q), len(self.points))
        if len(q) and len(self.points):
            self._search(self.root, Queries(q, self.points), np.arange(len(q)), best, index)
        return index, best

    def _take(self, q: Queries, rows: np.ndarray, entries: np.ndarray, best: np.ndarray, index: np.ndarray) -> np.ndarray:
        """Distances of ``rows`` to ``entries`` (in ascending order); the best of them is compared with the best so far as (distance, index)."""
        d = q.to(rows, entries)
        self.computed += d.size
        first = d.argmin(axis=1) if len(entries) > 1 else np.zeros(len(rows), np.int64)
        near, entry = d[np.arange(len(rows)), first], entries[first]
        old, old_index = best[rows], index[rows]
        better = (near < old) | ((near == old) & (entry < old_index))
        best[rows] = np.where(better, near, old)
        index[rows] = np.where(better, entry, old_index)
        return d

    def _search(self, node: dict, q: Queries, rows: np.ndarray, best: np.ndarray, index: np.ndarray) -> None:
        if "leaf" in node:
            if len(node["leaf"]):
                self._take(q, rows, node["leaf"], best, index)
            return
        split, low, high = node["split"], node["low"], node["high"]
        alive = np.ones((len(rows), len(split)), bool)
        for i in range(len(split)):
            k = np.flatnonzero(alive[:, i])
            if not len(k):
                continue
            d = np.sqrt(self._take(q, rows[k], split[i:i + 1], best, index)[:, 0].astype(np.float64))
            radius = np.sqrt(best[rows[k]].astype(np.float64)) * (1 + SLACK)
            # children all of whose entries are nearer to the split point than any within the radius, or farther
            reach = (d * (1 - SLACK) - radius)[:, None] <= high[i]
            reach &= (d * (1 + SLACK) + radius)[:, None] >= low[i]
            alive[k] &= reach
        for j, child in enumerate(node["children"]):
            k = np.flatnonzero(alive[:, j])
            if len(k):
                self._search(child, q, rows[k], best, index)


def _vectors(batch: pa.RecordBatch, scale: int) -> tuple[np.ndarray, list[np.ndarray], list[int]]:
    """Of a batch whose last column holds the vectors: places of the kept rows, their integer rows by length, the lengths."""
    col = batch.column(batch.num_columns - 1)
    size = np.asarray(pc.fill_null(pc.list_value_length(col), -1))
    found = []
    for n in sorted(set(size.tolist()) - {-1}):
        at = np.flatnonzero(size == n)
        x = col.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(at), n)
        ok = np.isfinite(x).all(axis=1)
        v = np.floor(x[ok] * scale)
        if np.abs(v).max(initial=0) > LIMIT:
            raise ValueError(f"a component beyond {LIMIT // scale} in size: squared distances would not fit 64 bits")
        found.append((at[ok], v.astype(np.int64), n))
    return found


def _seeds(rows: DataFrame, scale: int, entries: int) -> list[list[int]]:
    """Integer vectors of the ``entries`` smallest kept ids; a bounded number of rows.

    Ids come first, alone; whole vectors are then read below the last of them only.
    """
    finite = F.forall("embedding", lambda c: F.coalesce(~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf")), F.lit(False)))
    kept = rows.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & finite)
    ids = [r[0] for r in kept.select("vec_id").orderBy("vec_id").limit(entries).collect()]
    if not ids:
        return []
    v = F.transform("embedding", lambda c: F.floor(F.lit(float(scale)) * c.cast("double")))
    seeds = kept.where(F.col("vec_id") <= ids[-1]).select("vec_id", v.alias("v")).orderBy("vec_id", "v").limit(entries).collect()
    return [list(r["v"]) for r in seeds]


Books = list[np.ndarray]


def _assign(books: Books, bounds: list[int], v: np.ndarray, trees: list[Gnat]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    for p in range(len(books)):
        yield p, *trees[p].nearest(np.ascontiguousarray(v[:, bounds[p]:bounds[p + 1]]))


def _round(rows: DataFrame, books: Books, bounds: list[int], scale: int) -> Books:
    """Every part to its nearest entry; each entry becomes the floor of its parts' mean, unused ones stay."""
    dim = bounds[-1]

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = [Gnat(b) for b in books]
        count = [np.zeros(len(b), np.int64) for b in books]
        total = [np.zeros(b.shape, np.int64) for b in books]
        for batch in batches:
            for _, v, n in _vectors(batch, scale):
                for lo in range(0, len(v) if n == dim else 0, CHUNK):
                    chunk = v[lo:lo + CHUNK]
                    for p, e, _ in _assign(books, bounds, chunk, trees):
                        order = np.argsort(e, kind="stable")
                        used, first = np.unique(e[order], return_index=True)
                        total[p][used] += np.add.reduceat(chunk[order, bounds[p]:bounds[p + 1]], first, axis=0) if bounds[p] < bounds[p + 1] else 0
                        count[p] += np.bincount(e, minlength=len(books[p]))
        for p in range(len(books)):
            used = np.flatnonzero(count[p])
            yield pa.RecordBatch.from_pydict({"part": pa.array(np.full(len(used), p), pa.int32()), "entry": pa.array(used, pa.int32()),
                                              "n": pa.array(count[p][used]), "total": pa.array(total[p][used].tolist(), pa.list_(pa.int64()))})

    sums = rows.select("embedding").mapInArrow(partial, "part int, entry int, n long, total array<long>")
    per_place = (sums.select("part", "entry", F.posexplode(F.concat(F.array("n"), "total")).alias("place", "x"))
                 .groupBy("part", "entry", "place").agg(F.sum("x").alias("x")))
    new = [b.copy() for b in books]
    found: dict[tuple[int, int], dict[int, int]] = {}
    for r in per_place.collect():                      # at most entries x (dimension + parts) numbers
        found.setdefault((r["part"], r["entry"]), {})[r["place"]] = r["x"]
    for (p, e), x in found.items():
        new[p][e] = [x[i + 1] // x[0] for i in range(new[p].shape[1])]
    return new


def fit(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> tuple[Books, list[int]]:
    """Codebooks (one integer matrix per part position) and the part bounds, from all rows of ``vectors`` (vec_id, embedding)."""
    seeds = _seeds(vectors, scale, entries)
    bounds = part_bounds(len(seeds[0]) if seeds else 0, parts)
    seeds = [s for s in seeds if len(s) == bounds[-1]]
    books = [np.array([s[lo:hi] for s in seeds], np.int64).reshape(len(seeds), hi - lo) for lo, hi in zip(bounds, bounds[1:])]
    for _ in range(rounds if seeds else 0):
        books = _round(vectors, books, bounds, scale)
    return books, bounds


def encode(vectors: DataFrame, books: Books, bounds: list[int], scale: int = SCALE) -> DataFrame:
    """(vec_id, label, code, error) of every kept row of ``vectors`` (vec_id, label, embedding)."""
    dim = bounds[-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = [Gnat(b) for b in books]
        for batch in batches:
            for at, v, n in _vectors(batch, scale):
                for lo in range(0, len(v), CHUNK):
                    where, chunk = pa.array(at[lo:lo + CHUNK]), v[lo:lo + CHUNK]
                    if n == dim and len(books[0]):
                        error, code = np.zeros(len(chunk), np.int64), np.zeros((len(chunk), len(books)), np.int64)
                        for p, e, d in _assign(books, bounds, chunk, trees):
                            error += d
                            code[:, p] = e
                        text = pa.array(["".join(f"{x:02x}" for x in c) for c in code.tolist()], pa.string())
                        error = pa.array(error)
                    else:
                        text, error = pa.nulls(len(chunk), pa.string()), pa.nulls(len(chunk), pa.int64())
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(where), batch.column(1).take(where), text, error],
                                                     ["vec_id", "label", "code", "error"])

    rows = vectors.select(F.col("vec_id").cast("long"), F.col("label").cast("long"), "embedding")
    return rows.mapInArrow(run, "vec_id long, label long, code string, error long")


def codebooks_digest(books: Books) -> str:
    """Lowercase SHA-256 of all components by part, entry and place."""
    return hashlib.sha256(",".join(str(x) for b in books for row in b.tolist() for x in row).encode()).hexdigest()


def vector_codes(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) for ``vectors`` (vec_id, embedding, label).

    Rows whose vector is null or holds null or non-finite components go.  Null ids stay but seed no
    entry; repeated rows count and return as often as they stand; fewer rows than entries give
    smaller codebooks.  Vectors of another length than that of the smallest id's have null code and
    error; nulls of ``label`` are one label; other columns are ignored.  Empty table: no rows.
    """
    books, bounds = fit(vectors, parts, entries, rounds, scale)
    coded = materialise(encode(vectors, books, bounds, scale))
    total = coded.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error"))
    return (coded.join(total, F.col("label").eqNullSafe(F.col("_label")))
            .select("vec_id", "code", "error", "label_error", F.lit(codebooks_digest(books)).alias("codebooks_sha256")))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes(table(spark, sf_dir, "embeddings"))


def _sql_round(i: int) -> str:
    """CTEs of round ``i``: nearest entries of the codebook before it, then the codebook after it."""
    return f"""
a{i} AS MATERIALIZED (SELECT v.rid, v.p, min((v.s - 2 * list_dot_product(v.x, c.x) + c.s) * 256 + c.e)::BIGINT AS k
       FROM v JOIN c{i} c USING (p) GROUP BY v.rid, v.p),
c{i + 1} AS MATERIALIZED (SELECT p, e, x, list_dot_product(x, x) AS s FROM (
    SELECT c.p, c.e, coalesce(m.x, c.x) AS x FROM c{i} c LEFT JOIN (
      SELECT p, e, list(y ORDER BY place) AS x FROM (
        SELECT p, e, place, floor(sum(y) / count(*)) AS y FROM (
          SELECT a.p, a.k % 256 AS e, unnest(v.x) AS y, unnest(range(len(v.x))) AS place FROM a{i} a JOIN v USING (rid, p))
        GROUP BY p, e, place) GROUP BY p, e) m USING (p, e)))"""


SQL_CODES = f"""
WITH kept AS MATERIALIZED (SELECT row_number() OVER () AS rid, vec_id, label, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS x
    FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0),
v AS MATERIALIZED (SELECT rid, vec_id, p, x, list_dot_product(x, x) AS s FROM (
    SELECT rid, vec_id, p, x[p * len(x) // {PARTS} + 1:(p + 1) * len(x) // {PARTS}] AS x FROM kept, range({PARTS}) t(p))),
c0 AS MATERIALIZED (SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, x, s FROM v QUALIFY e < {ENTRIES}),
{",".join(_sql_round(i) for i in range(ROUNDS))},
last AS (SELECT v.rid, v.p, min((v.s - 2 * list_dot_product(v.x, c.x) + c.s) * 256 + c.e)::BIGINT AS k
         FROM v JOIN c{ROUNDS} c USING (p) GROUP BY v.rid, v.p),
coded AS (SELECT rid, string_agg(lower(lpad(to_hex(k % 256), 2, '0')), '' ORDER BY p) AS code, sum(k // 256)::BIGINT AS error FROM last GROUP BY rid),
book AS (SELECT sha256(string_agg(t, ',' ORDER BY p, e)) AS codebooks_sha256
         FROM (SELECT p, e, array_to_string(list_transform(x, lambda y: y::BIGINT), ',') AS t FROM c{ROUNDS}))
SELECT kept.vec_id, coded.code, coded.error, (sum(coded.error) OVER (PARTITION BY kept.label))::BIGINT AS label_error, codebooks_sha256
FROM kept JOIN coded USING (rid), book
"""
