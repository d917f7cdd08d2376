"""Removal of repeated byte strings with a run-length Burrows-Wheeler index.

Every 200-byte window has an anchor: its 64-byte piece of smallest hash.  Equal
windows have equal anchors, so a text falls into segments (all windows with one
anchor occurrence) that only need to meet segments with the same anchor.
Segments equal in full are settled by their hashes.  The others are brought
together by anchor and indexed in blocks: their Burrows-Wheeler transform is cut
into runs, the common prefix of neighbouring suffixes is measured at run ends
only, and streaming from there along the text (it shrinks by one per byte) gives
all matching statistics; stretches of 200 bytes or more are marked.

An anchor shared by too many different segments for one block is settled by
exact counts of its windows instead (128-bit hashes, grouped by Spark).
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from pulsekit.llm.common import materialise, table, text_batches
from pulsekit.llm.shingles import mix, prefix, range_hash, slices

LENGTH = 200
ANCHOR = 64
#: Different segments of one anchor that a block takes; beyond, its windows are counted.
HOT = 4096
BLOCK_BYTES = 1_000_000

_LATER = np.uint64(0x9E3779B97F4A7C15)


def _bytes(text) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def segments_of(texts: list[bytes], length: int = LENGTH, anchor: int = ANCHOR) -> tuple[np.ndarray, ...]:
    """(text, start, windows, anchor hash, segment hash) of every segment of the texts.

    A segment is a run of consecutive windows with the same anchor occurrence; ties go to the leftmost.
    """
    size = np.array([len(t) for t in texts], np.int64)
    none = np.zeros(0, np.int64)
    if not len(size) or size.max() < length:
        return none, none, none, none, none
    at = np.concatenate([[0], np.cumsum(size)])
    buffer = np.frombuffer(b"".join(texts), np.uint8)
    sums = prefix(buffer)
    starts = np.arange(len(buffer) - anchor + 1)
    value = range_hash(sums, starts, starts + anchor)
    width = length - anchor + 1
    low = np.uint64((1 << int(len(value) - 1).bit_length()) - 1)
    key = (value & ~low) | np.arange(len(value), dtype=np.uint64)
    padded = np.full(-(-len(value) // width) * width, np.iinfo(np.uint64).max)
    padded[: len(value)] = key
    blocks = padded.reshape(-1, width)
    left = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    n = len(buffer) - length + 1
    least = np.minimum(right[:n], left[width - 1: width - 1 + n])
    text = np.repeat(np.arange(len(texts)), size)
    window = np.flatnonzero(text[:n] == text[length - 1:])
    place = (least[window] & low).astype(np.int64)
    new = np.concatenate([[True], (np.diff(place) != 0) | (np.diff(window) != 1)])
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(window)))
    a, p = window[first], place[first]
    segment = range_hash(sums, a, a + count - 1 + length) ^ mix((p - a).astype(np.uint64) + _LATER)
    return text[a], a - at[text[a]], count, value[p].view(np.int64), segment.view(np.int64)


def segments(docs: DataFrame) -> DataFrame:
    """(anchor, segment, node, at) of all texts; ``at`` packs the start and, in the low byte, the number of windows."""

    def run(batches):
        for b in batches:
            nodes, done = b.column(0).to_numpy(), 0
            for part in slices([_bytes(t) for t in b.column(1).to_pylist()]):
                text, start, count, anchor, segment = segments_of(part)
                yield pa.RecordBatch.from_pydict({"anchor": pa.array(anchor), "segment": pa.array(segment),
                                                  "node": pa.array(nodes[done + text]), "at": pa.array(start << 8 | count)})
                done += len(part)

    return docs.select("node", "text").mapInArrow(run, "anchor long, segment long, node long, at long")


# -- the index of one block --------------------------------------------------------

def suffix_order(symbols: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Suffix array by prefix doubling.  Symbols are 1..256, and 0 where a segment ends; ends differ by their place.

    ``stop`` holds the next end of every position.  A comparison never passes an end.
    """
    n = len(symbols)
    padded = np.concatenate([symbols, np.zeros(7, np.int64)])
    key = np.zeros(n, np.int64)
    for j in range(7):                       # seven symbols of nine bits; nothing beyond the end
        key = key << 9 | np.where(np.arange(n) + j <= stop, padded[j: n + j], 0)
    order = np.argsort(key, kind="stable")
    rank = np.zeros(n, np.int64)

    def ranked(changed):
        rank[order] = np.cumsum(np.concatenate([[0], changed]))

    ranked(np.diff(key[order]) != 0)
    ends = symbols == 0
    rank += int(ends.sum())
    rank[ends] = np.arange(int(ends.sum()))  # every end is a symbol of its own
    step = 7
    while True:
        pair = rank << 32 | rank[np.minimum(np.arange(n) + step, stop)]
        order = np.argsort(pair, kind="stable")
        changed = np.diff(pair[order]) != 0
        ranked(changed)
        if changed.all():
            return order
        step *= 2


def run_samples(symbols: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes at the starts of runs of the transform, each with the suffix that ends the run before it."""
    transform = symbols[order - 1]
    # an end is a run of its own: what precedes a segment's first byte is nothing
    start = np.flatnonzero((transform[1:] != transform[:-1]) | (transform[1:] == 0)) + 1
    return order[start], order[start - 1]


def common(symbols: np.ndarray, stop: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common prefix of suffixes a and b, up to their ends."""
    most = np.minimum(stop[a] - a, stop[b] - b)
    out = np.zeros(len(a), np.int64)
    live = np.flatnonzero(most >= LENGTH)    # shorter ones cannot hold a match
    n = len(symbols)
    words = np.zeros(n, np.int64)
    padded = np.concatenate([symbols, np.zeros(7, np.int64)])
    for j in range(7):
        words = words << 9 | padded[j: n + j]
    done = np.zeros(len(a), bool)
    while len(live):
        x, y = a[live] + out[live], b[live] + out[live]
        room = most[live] - out[live] >= 7
        same = room & (words[np.minimum(x, n - 1)] == words[np.minimum(y, n - 1)])
        out[live[same]] += 7
        done[live[~same]] = True
        live = live[same]
    tail = np.flatnonzero(done)
    for _ in range(7):
        tail = tail[out[tail] < most[tail]]
        tail = tail[symbols[a[tail] + out[tail]] == symbols[b[tail] + out[tail]]]
        out[tail] += 1
    return out


def repeats_in_block(parts: list[bytes], length: int = LENGTH) -> list[list[tuple[int, int]]]:
    """Per segment, the byte ranges covered by strings of ``length`` that also start elsewhere in the block."""
    size = np.array([len(p) for p in parts], np.int64)
    symbols = np.frombuffer(b"\0".join([*parts, b""]), np.uint8).astype(np.int64) + 1
    end = np.cumsum(size + 1) - 1
    symbols[end] = 0
    stop = np.repeat(end, size + 1)
    order = suffix_order(symbols, stop)
    a, b = run_samples(symbols, order)
    match = common(symbols, stop, a, b)
    long = match >= length
    begin = end - size
    out: list[list[tuple[int, int]]] = [[] for _ in parts]
    for s, m in ((a[long], match[long]), (b[long], match[long])):
        which = np.searchsorted(end, s)
        for k, x, y in zip(which.tolist(), (s - begin[which]).tolist(), (s - begin[which] + m).tolist()):
            out[k].append((x, y))
    return out


def _block_marks(length: int):
    """Streams segments sorted by anchor through blocks; whole anchors stay together."""

    def run(batches):
        parts, names, size, last = [], [], 0, None

        def flush():
            rows = [(s, x, y) for s, spans in zip(names, repeats_in_block(parts, length)) for x, y in joined(spans)]
            return pa.RecordBatch.from_pydict({n: pa.array([r[i] for r in rows], pa.int64()) for i, n in enumerate(["segment", "start", "stop"])})

        for batch in batches:
            for anchor, segment, data in zip(*(c.to_pylist() for c in batch.columns)):
                if size >= BLOCK_BYTES and anchor != last:
                    yield flush()
                    parts, names, size = [], [], 0
                if anchor == last and names and names[-1] == segment:
                    continue                 # the same segment read from a copy of its text
                parts.append(data)
                names.append(segment)
                size += len(data)
                last = anchor
        if parts:
            yield flush()

    return run


def joined(spans) -> list[tuple[int, int]]:
    """Sorted spans with touching or overlapping ones made one."""
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [tuple(x) for x in out]


def _window_rows(length: int):
    """(segment, i, h1, h2) of every window of hot segments."""

    def run(batches):
        for batch in batches:
            for segment, data in zip(*(c.to_pylist() for c in batch.columns)):
                buffer = np.frombuffer(data, np.uint8)
                i = np.arange(len(buffer) - length + 1)
                h1 = range_hash(prefix(buffer), i, i + length)
                h2 = range_hash(prefix(buffer ^ np.uint8(0x5A)), i, i + length)
                yield pa.RecordBatch.from_pydict({"segment": pa.array(np.full(len(i), segment)), "i": pa.array(i),
                                                  "h1": pa.array(h1.view(np.int64)), "h2": pa.array(h2.view(np.int64))})

    return run


def _with_node(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit("")), F.octet_length(F.coalesce("text", F.lit("")))).alias("node"))


def repeated_spans(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """(node, spans): per text (by its hash), the byte ranges covered by repeated strings."""
    named = _with_node(text_batches(docs))
    by_anchor = segments(named).repartition("anchor")
    same, anchor = W.partitionBy("anchor", "segment"), W.partitionBy("anchor")
    hits = materialise(by_anchor
                       .withColumn("n", F.count(F.lit(1)).over(same))
                       .withColumn("other", F.min("segment").over(anchor) != F.max("segment").over(anchor))
                       .where((F.col("n") > 1) | F.col("other")))
    start, count = F.shiftright("at", 8), F.col("at").bitwiseAND(255)
    whole = hits.where("n > 1").select("node", start.alias("start"), (start + count + (LENGTH - 1)).alias("stop"))

    reps = (hits.where("other").groupBy("anchor", "segment").agg(F.min(F.struct("node", "at")).alias("r"))
            .select("anchor", "segment", F.col("r.node").alias("node"), F.col("r.at").alias("at")))
    wanted = reps.groupBy("node").agg(F.collect_list(F.struct("anchor", "segment", "at")).alias("wanted"))  # bounded by the text

    def cut_out(batches):
        for b in batches:
            rows = [(w["anchor"], w["segment"], data[w["at"] >> 8: (w["at"] >> 8) + (w["at"] & 255) + LENGTH - 1])
                    for text, ws in zip(b.column(0).to_pylist(), b.column(1).to_pylist()) for data in [_bytes(text)] for w in ws]
            for i in range(0, max(1, len(rows)), 20_000):
                part = rows[i:i + 20_000]
                yield pa.RecordBatch.from_pydict({"anchor": pa.array([r[0] for r in part], pa.int64()), "segment": pa.array([r[1] for r in part], pa.int64()),
                                                  "data": pa.array([r[2] for r in part], pa.binary())})

    data = materialise(named.select("node", "text").join(wanted, "node").select("text", "wanted")
                       .mapInArrow(cut_out, "anchor long, segment long, data binary"))
    crowded = data.groupBy("anchor").agg(F.count_distinct("segment").alias("m")).where(F.col("m") > hot).select("anchor")
    calm = data.join(crowded, "anchor", "left_anti").repartition("anchor").sortWithinPartitions("anchor", "segment")
    marks = calm.select("anchor", "segment", "data").mapInArrow(_block_marks(LENGTH), "segment long, start long, stop long")

    busy = data.join(crowded, "anchor", "left_semi").dropDuplicates(["segment"])
    windows = busy.select("segment", "data").mapInArrow(_window_rows(LENGTH), "segment long, i long, h1 long, h2 long")
    again = windows.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h1", "h2")
    marks = marks.unionByName(windows.join(again, ["h1", "h2"]).select("segment", F.col("i").alias("start"), (F.col("i") + LENGTH).alias("stop")))
    # only segments without an equal one need the marks: the others go whole
    lone = hits.where("n = 1").select("segment", "node", start.alias("at"))
    partly = lone.join(marks, "segment").select("node", (F.col("at") + F.col("start")).alias("start"), (F.col("at") + F.col("stop")).alias("stop"))
    return whole.unionByName(partly).distinct().groupBy("node").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))


def remove_repeats(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): n_bytes, n_removed, n_spans, kept_sha256.

    Null texts are empty and keep nothing; texts under 200 bytes lose nothing.  Equal
    rows are repeats of each other.  Bytes are removed even inside a character.
    """
    spans = repeated_spans(docs, hot)

    def run(batches):
        for b in batches:
            n, gone, runs, sha = [], [], [], []
            for text, found in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                data, at, digest, cut = _bytes(text), 0, hashlib.sha256(), 0
                merged = joined((s["start"], s["stop"]) for s in found or [])
                for x, y in merged:
                    digest.update(data[at:x])
                    cut, at = cut + y - x, y
                digest.update(data[at:])
                n.append(len(data)), gone.append(cut), runs.append(len(merged)), sha.append(digest.hexdigest())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(runs, pa.int64()),
                                              pa.array(sha, pa.string())], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    rows = _with_node(docs).join(spans, "node", "left").select("doc_id", "text", "spans")
    return rows.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def op5_repeat_removal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))
