"""Ranked lexical search by pipelined term partitioning.

Documents are cut into blocks of bounded size, and each block into postings per term.
Terms are owned by a fixed number of stages, the rarest by the first.  Items travel in bundles,
one per (group of items, block of documents): a bundle carries the sparse
accumulators of its items (documents met so far and their integer scores) through the stages, and
each stage's cogroup adds the contributions of the terms that it owns.  After the last
stage a bundle gives its best documents, and a limited ranking merges the bundles.

Between stages an accumulator goes only where its score plus the most that later stages could
add stays below the k-th best score of its item in the same block; such a document is not among the
best of its own block, so results are exact.

A bundle holds at most BLOCK_DOCS documents for about GROUP_ITEMS items, whatever the corpus; a
frequent term is one row per block.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from pulsekit.llm.common import materialise, table, text_batches

K = 10
#: Documents of a block (at most 65,536), bytes of text after which a block ends early, and items of a group on average.
BLOCK_DOCS = 4096
BLOCK_BYTES = 64 << 20
GROUP_ITEMS = 64
#: A term's stage: the first whose bound its share of the documents does not exceed; the last stage takes the rest.
STAGE_BOUNDS = (1 / 512, 1 / 64, 1 / 8)
STAGES = len(STAGE_BOUNDS) + 1
#: No contribution of a term reaches this many times its weight.
IMPACT = 1_000_000

_TERM = re.compile(rb"[0-9a-z\x80-\xff]+")


def terms(text: str | None) -> list[bytes]:
    """Terms of a text as UTF-8: runs of ASCII letters, digits and all characters beyond ASCII, A-Z in lower case."""
    return _TERM.findall((text or "").encode("utf-8", "surrogatepass").lower())


def postings(docs: DataFrame, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """Rows (block, term, n, length, ids, sizes, places, tfs).

    The row with the empty term is the block's directory: ids and term counts of its documents,
    how many have a term (n) and their terms together (length).  Every other row holds one term's
    places in the directory and its occurrences there; n is their number.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made = TaskContext.get().partitionId(), 0
        ids, sizes, found, held = [], [], {}, 0

        def block() -> Iterator[pa.RecordBatch]:
            nonlocal made, ids, sizes, found, held
            made += 1
            at = (part << 32) + made
            name = ["block", "term", "n", "length", "ids", "sizes", "places", "tfs"]
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(), pa.binary()]
            rows = [[at], [""], [sum(s > 0 for s in sizes)], [sum(sizes)], [ids], [sizes], [None], [None]]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows, kinds)], name)
            listed = list(found.items())
            ids, sizes, found, held = [], [], {}, 0
            for lo in range(0, len(listed), 20_000):
                some = listed[lo:lo + 20_000]
                none, n = [None] * len(some), [len(x) for _, (x, _) in some]
                rows = [[at] * len(some), [t.decode("utf-8", "surrogatepass") for t, _ in some], n, none, none, none,
                        [np.array(x, "<u2").tobytes() for _, (x, _) in some], [np.array(y, "<u4").tobytes() for _, (_, y) in some]]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows, kinds)], name)

        for batch in batches:
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = terms(text.as_py())
                tf: dict[bytes, int] = {}
                for w in words:
                    tf[w] = tf.get(w, 0) + 1
                place = len(ids)
                for w, n in tf.items():
                    entry = found.get(w)
                    if entry is None:
                        found[w] = ([place], [n])
                    else:
                        entry[0].append(place)
                        entry[1].append(n)
                ids.append(i)
                sizes.append(len(words))
                held += sum(map(len, words))
                if len(ids) == block_docs or held >= BLOCK_BYTES:
                    yield from block()
        if ids:
            yield from block()

    return (text_batches(docs).select(F.col("doc_id").cast("long"), "text")
            .mapInArrow(run, "block long, term string, n long, length long, ids array<long>, sizes array<long>, places binary, tfs binary"))


def item_terms(items: DataFrame) -> DataFrame:
    """Distinct (item_id, term); the terms of one id are those of all its rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = [(i, w.decode("utf-8", "surrogatepass")) for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) for w in set(terms(t))]
            yield pa.RecordBatch.from_arrays([pa.array([p[0] for p in pairs], pa.int64()), pa.array([p[1] for p in pairs], pa.string())], ["item_id", "term"])

    return items.select(F.col("item_id").cast("long"), "text").mapInArrow(run, "item_id long, term string").distinct()


BUNDLE = "block long, g long, ids array<long>, sizes array<long>, items array<long>, ends array<int>, places binary, scores binary"


def _sparse(bundle: pa.Table) -> tuple[list, np.ndarray, np.ndarray, list, np.ndarray, np.ndarray]:
    """Documents, their term counts, items, ends of the items' accumulators, places and scores of a bundle row."""
    ids, sizes, items, ends, places, scores = (bundle.column(c)[0].as_py() for c in ("ids", "sizes", "items", "ends", "places", "scores"))
    return ids, np.array(sizes, np.int64), items, ends, np.frombuffer(places, "<u2"), np.frombuffer(scores, "<i8")


def _add(n_docs: int, n_terms: int, k: int):
    """One stage for one bundle: add the stage's contributions, drop accumulators that cannot reach the block's best."""

    def run(bundle: pa.Table, work: pa.Table) -> pa.Table:
        if not bundle.num_rows or not work.num_rows:
            return bundle
        ids, sizes, items, ends, places, scores = _sparse(bundle)
        row_of = {item: r for r, item in enumerate(items)}
        for w in work.column("wanted"):
            for x in w.as_py():
                row_of.setdefault(x["item_id"], len(row_of))
        acc = np.zeros((len(row_of), len(ids)), np.int64)
        for r, (lo, hi) in enumerate(zip([0, *ends], ends)):
            acc[r, places[lo:hi]] = scores[lo:hi]
        rest = np.full(len(row_of), -1)
        length = 10 + (90 * sizes * n_docs) // n_terms
        for weight, at, tf, wanted in zip(*(work.column(c).to_pylist() for c in ("weight", "places", "tfs", "wanted"))):
            at, tf = np.frombuffer(at, "<u2"), np.frombuffer(tf, "<u4").astype(np.int64)
            score = weight * ((1_000_000_000 * tf) // (1000 * tf + 8 * length[at]))
            for x in wanted:
                r = row_of[x["item_id"]]
                acc[r, at] += score
                rest[r] = x["rest"]
        ends, out_places, out_scores = [], [], []
        for r, row in enumerate(acc):
            at = np.flatnonzero(row)
            if rest[r] >= 0 and len(at) > k:
                at = at[row[at] + rest[r] >= np.partition(row[at], len(at) - k)[len(at) - k]]
            out_places.append(at)
            out_scores.append(row[at])
            ends.append((ends[-1] if ends else 0) + len(at))
        new = {"items": [list(row_of)], "ends": [ends], "places": [np.concatenate(out_places).astype("<u2").tobytes()],
               "scores": [np.concatenate(out_scores).astype("<i8").tobytes()]}
        return pa.table([bundle.column(f.name) if f.name not in new else pa.array(new[f.name], f.type) for f in bundle.schema], schema=bundle.schema)

    return run


def _best(k: int):
    """The k best documents of every item of a bundle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids, _, items, ends, places, scores = _sparse(pa.Table.from_batches([batch.slice(i, 1)]))
                out = []
                for item, lo, hi in zip(items, [0, *ends], ends):
                    s = scores[lo:hi]
                    floor = np.partition(s, len(s) - k)[len(s) - k] if len(s) > k else 0
                    top = [(-int(s[j]), ids[places[lo + j]] is None, ids[places[lo + j]] or 0) for j in np.flatnonzero(s >= floor).tolist()]
                    out += [(item, None if null else d, -neg) for neg, null, d in sorted(top)[:k]]
                yield pa.RecordBatch.from_arrays([pa.array([o[c] for o in out], pa.int64()) for c in range(3)], ["item_id", "doc_id", "score"])

    return run


def ranked_search(docs: DataFrame, items: DataFrame, k: int = K, block_docs: int = BLOCK_DOCS, group_items: int = GROUP_ITEMS) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best rows of ``docs`` (doc_id, text) for each id of ``items`` (item_id, text).

    Scores are the integer sums of the module's formula, over the item's distinct terms; equal
    scores rank by ascending doc_id, null last.  Null and empty texts have no terms; an item without
    terms or matches gives no row.  Repeated rows of ``docs`` rank as often as they stand; rows of
    ``items`` with one id are one item.  Other columns are ignored.  Empty tables: no rows.
    """
    wanted = materialise(item_terms(items))
    directory = wanted.select("term").union(wanted.sparkSession.range(1).select(F.lit("").alias("term"))).distinct()
    # the vocabulary of the items decides what of the index is kept; Spark broadcasts it where it is small enough
    index = materialise(postings(docs, block_docs).join(materialise(directory), "term", "left_semi"))
    n_docs, n_terms = index.where("term = ''").agg(F.sum("n"), F.sum("length")).first()
    n_items = wanted.select("item_id").distinct().count()
    out = "item_id long, doc_id long, score long"
    if not n_terms or not n_items:
        return docs.sparkSession.createDataFrame([], out).select("item_id", F.lit(1).alias("rank"), "doc_id", "score")
    groups = max(1, -(-n_items // group_items))
    df = index.where("term <> ''").groupBy("term").agg(F.sum("n").alias("df"))
    stage = F.lit(STAGES - 1)
    for s in reversed(range(STAGES - 1)):
        stage = F.when(F.col("df") <= STAGE_BOUNDS[s] * n_docs, s).otherwise(stage)
    weight = F.floor(1000 * F.log(F.lit(2.0 * n_docs + 2) / (2 * F.col("df") + 1)))
    weighted = wanted.join(df.select("term", stage.alias("stage"), weight.alias("weight")), "term")
    # what later stages can add to an item at most
    later = W.partitionBy("item_id").orderBy(F.col("stage").desc()).rangeBetween(W.unboundedPreceding, -1)
    rest = F.coalesce(F.sum("weight").over(later), F.lit(0)) * IMPACT
    weighted = weighted.withColumn("stage", F.col("stage").cast("int")).withColumn("rest", rest)
    lists = materialise(weighted.groupBy(F.pmod(F.xxhash64("item_id"), F.lit(groups)).alias("g"), "term", "stage", "weight")
                        .agg(F.collect_list(F.struct("item_id", "rest")).alias("wanted")))
    empty = F.lit(b"")
    bundles = index.where("term = ''").select(
        "block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))).alias("g"), "ids", "sizes",
        F.array().cast("array<long>").alias("items"), F.array().cast("array<int>").alias("ends"), empty.alias("places"), empty.alias("scores"))
    for s in range(STAGES):
        work = (index.where("term <> ''").join(lists.where(F.col("stage") == s), "term")
                .select(*[F.col(c).alias(c) for c in ("block", "g", "weight", "places", "tfs", "wanted")]))   # names of their own
        bundles = bundles.groupBy("block", "g").cogroup(work.groupBy("block", "g")).applyInArrow(_add(n_docs, n_terms, k), BUNDLE)
    order = W.partitionBy("item_id").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return (bundles.mapInArrow(_best(k), out).withColumn("rank", F.row_number().over(order))
            .where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score"))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_SQL_TERMS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
SQL_SEARCH = f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, {_SQL_TERMS} AS t FROM documents),
c AS (SELECT count(*) FILTER (len(t) > 0) AS n, sum(len(t))::BIGINT AS l FROM d),
tf AS MATERIALIZED (SELECT rid, term, count(*) AS tf FROM (SELECT rid, unnest(t) AS term FROM d) GROUP BY rid, term),
w AS (SELECT term, floor(1000 * ln((2 * n + 2) / (2 * df + 1)))::BIGINT AS w FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), c),
i AS (SELECT DISTINCT item_id, unnest({_SQL_TERMS}) AS term FROM benchmark),
m AS (SELECT rid, doc_id, 10 + (90 * len(t) * n) // l AS m FROM d, c),
s AS (SELECT item_id, doc_id, rid, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
      FROM i JOIN w USING (term) JOIN tf USING (term) JOIN m USING (rid) GROUP BY item_id, doc_id, rid)
SELECT item_id, doc_id, score, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INTEGER AS rank
FROM s WHERE score > 0 QUALIFY rank <= {K}
"""
