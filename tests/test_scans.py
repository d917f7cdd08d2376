"""What is read once, what needs no join, and that results stay the same."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from pulsekit.operators import insights, kmeans, ml, text, trends
from pulsekit.sources import testdata

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_pieces_of_titles_give_their_terms():
    """every different piece is looked at once, and gives what the whole title gives."""
    rng = random.Random(1)
    letters = [*map(chr, range(0, 0x400)), *" 　 각각\U0001f600㈜½ﬁⅧ", *" " * 200]
    titles = ["", "   ", "a¨bc def", "ΟΔΟΣ ΣΑΣ Σ x", "x yes　no\x1cabc\x85def", "#tag##foo #ab __x ﬁre İstanbul éclair ́abc", "\x0bxyz\x0cfoo\tbar\nbaz\rqux",
              "(The) the, THE! t_e a.b.cde"] + ["".join(rng.choice(letters) for _ in range(60)) for _ in range(3000)]
    terms, row, term = text.term_places(pa.array(titles).slice(2))
    names, got = terms.to_pylist(), [Counter() for _ in titles[2:]]
    for r, t in zip(row.tolist(), term.tolist()):
        got[r][names[t]] += 1
    assert got == [Counter(text.caption_terms(t)) for t in titles[2:]]


def test_clusters_need_no_join(spark):
    """F16: points of few centres are placed without a join; the steps that seek centres keep equal results (test_kmeans)."""
    df = spark.createDataFrame([("p", str(i), [i * i, i]) for i in range(40)], "platform string, post_id string, x array<long>")
    out = kmeans.cluster(df, lambda n: 3, restarts=2, rounds=3)
    assert "Join" not in plan(out) and out.columns == ["platform", "post_id", "x", "cluster", "distance"] and out.count() == 40


def test_axes_of_all_platforms_come_from_one_scan(spark):
    """one job for the sums of all platforms, with MLlib's axes and shares."""
    rng = np.random.default_rng(1)
    names = "abcdef"
    vectors = [[float(v) for v in rng.normal(3, 1, 12) * np.arange(1, 13)] for _ in range(360)]
    posts = spark.createDataFrame([(names[i % 6], str(i)) for i in range(360)] + [(None, "0")], "platform string, post_id string")
    e = spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>").cache()
    e.count()
    spark.sparkContext.setJobGroup("axes", "axes")
    out = ml.caption_pca(posts, e)
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("axes"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs <= 6                                  # two or so for the sums; a fit per platform made many times that
    rows = out.collect()
    assert len(rows) == 360
    for p in "ad":
        mine = e.where(F.col("vec_id") % 6 == names.index(p)).select("vec_id", array_to_vector("embedding").alias("v"))
        m = PCA(k=10, inputCol="v", outputCol="o").fit(mine)
        want = {str(r["vec_id"]): r["o"].toArray() for r in m.transform(mine).collect()}
        for r in rows:
            if r["platform"] == p:
                assert np.allclose(np.abs(r["pca"]), np.abs(want[r["post_id"]])) and abs(r["explained_variance"] - sum(m.explainedVariance)) < 1e-9


def test_tags_are_taken_from_captions_once(spark, posts):
    """the result reads stored tags, not captions."""
    out = ml.hashtag_clusters(posts, testdata.post_embeddings(spark, SF))
    assert "regexp_extract_all" not in plan(out) and "title" not in plan(out)


def test_tag_sums_are_added_up_in_their_task(spark, monkeypatch):
    """a row per task and tag, also where a task passes sums on early."""
    monkeypatch.setattr(ml, "HELD_TAGS", 3)
    rows = [("p" if i % 3 else None, f"#{i % 7}", [i, -i, 1 << 40]) for i in range(100)]
    batches = [pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows[a:a + 9])], ["platform", "tag", "e"]) for a in range(0, 100, 9)]
    got, want = {}, {}
    for b in ml._tag_sums(iter(batches)):
        for r in b.to_pylist():
            old = got.get((r["platform"], r["tag"]), (0, [0, 0, 0]))
            got[r["platform"], r["tag"]] = (old[0] + r["n"], [x + y for x, y in zip(old[1], r["total"])])
    for p, t, e in rows:
        old = want.get((p, t), (0, [0, 0, 0]))
        want[p, t] = (old[0] + 1, [x + y for x, y in zip(old[1], e)])
    assert got == want


def test_features_need_no_join(spark, posts):
    """features and the columns beside them come from one read of the posts."""
    f, cols = ml.feature_table(posts.localCheckpoint())
    assert "Join" not in plan(f) and {"likes", "title", "permalink", *cols} <= set(f.columns)


def test_folds_are_found_from_counts(spark):
    """blocks in order of time, undated posts first, without a pass over wide rows per fold."""
    rows = spark.createDataFrame([(p, f"{i:03}", i % 11) for p, n in (("a", 53), ("b", 25), ("c", 9)) for i in range(n)], "platform string, post_id string, d int")
    rows = rows.select("platform", "post_id", F.when(F.col("d") > 1, F.expr("timestamp_ntz'2024-01-01 00:00:00'") + F.make_dt_interval((F.col("d") / 4).cast("int"))).alias("published_at"))
    spark.sparkContext.setJobGroup("folds", "folds")
    got = ml._folds(rows, {"a": 5, "b": 3, "c": 1}).collect()
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    for p, k, n in (("a", 5, 53), ("b", 3, 25), ("c", 1, 9)):
        mine = sorted((r["published_at"], r["post_id"], r["fold"]) for r in got if r["platform"] == p)
        sizes = [n // k + (f < n % k) for f in range(k)]
        assert [m[2] for m in mine] == [f for f, s in enumerate(sizes) for _ in range(s)], p
    assert "_first" not in plan(ml._folds(rows, {"a": 5}))


def test_lines_read_a_small_table(spark):
    """the lines and rules are made from tables of a row per platform, not from the posts."""
    bare = testdata.bare_posts(spark, SF)
    assert "InMemoryRelation" not in plan(insights.key_numbers(bare)) and "InMemoryRelation" not in plan(insights.recommendations(bare))


def test_fatigue_counts_days_once(spark):
    """after the counts per day, posts are read twice: for the split days and for all others."""
    bare = testdata.bare_posts(spark, SF)
    assert plan(trends.content_fatigue(bare)).count("InMemoryRelation") == 2
