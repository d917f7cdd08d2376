"""Toxicity by multiple-instance learning.

Labels belong to documents, offence sits in sentences.  A sentence's score is a
logistic function of its words; a document's score is the noisy-or of its
sentences' scores (one offending sentence is enough).  The word weights are
trained from document labels through the noisy-or, and the same scores then
point at the offending sentences.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsekit.llm.common import materialise, table, text_batches

#: Documents per class (distinct texts, in hash order) on which the weights are fitted.
FIT_DOCS = 2000
#: Words in this many toxic training texts are tested; of those that get weights, this share may be chance finds.
MIN_TOXIC, CHANCE_SHARE = 3, 0.05
STEPS, RATE, RIDGE, START_BIAS = 300, 0.1, 1e-6, -4.0
THRESHOLD = 0.7
#: Sentences with at least this score are reported.
OFFENDING = 0.5

_SENTENCE = re.compile(r"[^.!?\n]+")
_WORD = re.compile(r"[^\W\d_]+")


def held_out(doc_id):
    """Documents never learned from: crc32 of the id as text leaves 1 by 3 (a null id: not held out)."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def sentence_words(text: str) -> Iterator[tuple[int, int, list[str]]]:
    for m in _SENTENCE.finditer(text):
        yield m.start(), m.end(), _WORD.findall(m.group().lower())


def training_texts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(text, toxic) of the labelled, not held-out documents; each distinct text once, toxic if any label says so."""
    marks = labels.where(F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    rows = (docs.select("doc_id", "text").where(~held_out(F.col("doc_id")) & F.col("text").isNotNull())
            .withColumn("h", F.xxhash64("text", F.length("text"))))
    # which row stands for a text is settled on narrow rows; texts are shuffled once, by the same plan at every size
    first = (rows.select("doc_id", "h").join(marks, "doc_id")
             .groupBy("h").agg(F.min("doc_id").alias("doc_id"), F.max("toxic").alias("toxic")))
    return materialise(rows.hint("merge").join(first, ["doc_id", "h"]).select("text", "toxic"))


def telling_words(train: DataFrame) -> list[str]:
    """Words that mark toxic texts, by log-likelihood ratio, counted over all training texts.

    All words count whose excess in toxic texts is no chance find, by the false discovery rate (Benjamini and
    Hochberg): no fixed number of words, and more of them the more texts are labelled.
    """

    def count(frames):
        toxic, clean = Counter(), Counter()

        def out():
            words = list(toxic.keys() | clean.keys())
            return pd.DataFrame({"word": words, "t": [toxic[w] for w in words], "c": [clean[w] for w in words]})

        for frame in frames:
            for text, mark in zip(frame["text"], frame["toxic"]):
                (toxic if mark else clean).update(set(_WORD.findall(text.lower())))
                if len(toxic) + len(clean) > 300_000:
                    yield out()
                    toxic.clear(), clean.clear()
        yield out()

    n = train.agg(F.sum("toxic"), F.count(F.lit(1))).first()
    nt, nc = float(n[0] or 0), float((n[1] or 0) - (n[0] or 0))
    if not nt or not nc:
        return []
    sums = train.mapInPandas(count, "word string, t long, c long").groupBy("word").agg(F.sum("t").alias("t"), F.sum("c").alias("c"))
    expect = (F.col("t") + F.col("c")) * F.lit(nt / (nt + nc))
    part = lambda o, e: F.when(o > 0, o * F.log(o / e)).otherwise(0.0)
    ratio = 2 * (part(F.col("t"), expect) + part(F.col("c"), F.col("t") + F.col("c") - expect))
    tested = materialise(sums.where(F.col("t") >= MIN_TOXIC).select("word", F.when(F.col("t") > expect, F.round(ratio, 6)).otherwise(0.0).alias("g")))
    m = tested.count()
    # no word below the ratio that a single test would ask for can pass
    least = chi_square(CHANCE_SHARE)
    found = sorted(((r["g"], r["word"]) for r in tested.where(F.col("g") >= least).collect()), key=lambda x: (-x[0], x[1]))
    passed = [i for i, (g, _) in enumerate(found, 1) if math.erfc(math.sqrt(g / 2)) <= CHANCE_SHARE * i / m]
    return [w for _, w in found[:max(passed, default=0)]]


def chi_square(p: float) -> float:
    """The ratio that chance alone exceeds with probability ``p`` (one degree of freedom), by bisection."""
    lo, hi = 0.0, 1e4
    while hi - lo > 1e-9:
        lo, hi = ((lo + hi) / 2, hi) if math.erfc(math.sqrt((lo + hi) / 4)) > p else (lo, (lo + hi) / 2)
    return hi


def fit(train: DataFrame, words: list[str], fit_docs: int = FIT_DOCS) -> dict[str, float]:
    """Word weights and bias (under the empty word) fitted through the noisy-or on at most 2 * ``fit_docs`` texts."""
    index = {w: i for i, w in enumerate(words)}

    def bags(frames):
        for frame in frames:
            rows = []
            for text in frame["text"]:
                hits = ([index[w] for w in ws if w in index] for _, _, ws in sentence_words(text))
                rows.append([sorted(set(h)) for h in hits if h])
            yield pd.DataFrame({"h": frame["h"], "toxic": frame["toxic"],
                                "at": [[i for s in r for i in s] for r in rows], "size": [[len(s) for s in r] for r in rows]})

    # texts to fit on are settled on narrow rows, (hash, class) alone; only theirs are then read whole
    hashed = train.withColumn("h", F.xxhash64("text"))
    last = {}
    for toxic in (1, 0):
        h = hashed.where(F.col("toxic") == toxic).select("h").orderBy("h").limit(fit_docs).agg(F.max("h")).first()[0]
        last[toxic] = F.lit(False) if h is None else (F.col("toxic") == toxic) & (F.col("h") <= h)
    picked = hashed.where(last[1] | last[0])
    rows = picked.mapInPandas(bags, "h long, toxic int, at array<int>, size array<int>").toPandas()
    rows = rows.sort_values(["toxic", "h"], kind="stable")
    if not len(rows) or not words:
        return {"": START_BIAS}
    at = np.concatenate([*rows["at"], []]).astype(np.int64)
    size = np.concatenate([*rows["size"], []]).astype(np.int64)
    doc = np.repeat(np.arange(len(rows)), [len(x) for x in rows["size"]])
    sent = np.repeat(np.arange(len(size)), size)
    y = rows["toxic"].to_numpy(float)
    share = np.where(y == 1, 0.5 / max(1, y.sum()), 0.5 / max(1, (1 - y).sum()))   # both classes weigh the same
    w = np.zeros(len(words) + 1)
    w[:-1], w[-1] = 0.5, START_BIAS
    m, v = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, STEPS + 1):
        z = np.bincount(sent, w[at], len(size)) + w[-1]
        a = np.maximum(np.bincount(doc, np.logaddexp(0, z), len(rows)), 1e-12)    # -log of "no sentence offends"
        slope = share * (np.where(y == 1, -1 / np.expm1(np.minimum(a, 500)), 1.0))
        g = slope[doc] / (1 + np.exp(-z))
        grad = np.append(np.bincount(at, g[sent], len(words)), g.sum())
        grad[:-1] += RIDGE * w[:-1]
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad ** 2
        w -= RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-9)
    return dict(zip(words, np.round(w[:-1], 6).tolist())) | {"": float(np.round(w[-1], 6))}


def score(docs: DataFrame, weights: dict[str, float]) -> DataFrame:
    """(doc_id, score, offending): the noisy-or over all sentences, and those (start, stop, score) that offend.

    Sentences without any known word cannot offend.  Null and empty texts score 0.
    """
    bias = weights[""]
    known = {w: x for w, x in weights.items() if w}

    def run(frames):
        for frame in frames:
            total, spans = [], []
            for text in frame["text"]:
                a, out = 0.0, []
                for start, stop, ws in sentence_words(text or ""):
                    hits = known.keys() & ws
                    if hits:
                        z = bias + sum(known[w] for w in sorted(hits))
                        a += float(np.logaddexp(0, z))
                        if z >= 0:
                            out.append((start, stop, float(1 / (1 + np.exp(-z)))))
                total.append(float(-np.expm1(-a)))
                spans.append(out)
            yield pd.DataFrame({"doc_id": frame["doc_id"], "score": total, "offending": spans})

    return text_batches(docs).select("doc_id", "text").mapInPandas(run, "doc_id long, score double, offending array<struct<start:int,stop:int,score:double>>")


def train_and_score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    train = training_texts(text_batches(docs), labels)
    return score(docs, fit(train, telling_words(train)))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = train_and_score(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"))
    worst = F.array_max(F.transform("offending", lambda s: F.struct(s["score"].alias("p"), (-s["start"]).alias("a"), s["stop"].alias("b"))))
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                       F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"),
                       F.size("offending").cast("long").alias("n_offending"), (-worst["a"]).alias("worst_start"), worst["b"].alias("worst_stop"))
