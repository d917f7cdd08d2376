"""k-means: against a plain version, over layouts, on few points."""

import hashlib
import math
import random

from pyspark.sql import functions as F

from pulsekit.operators import kmeans, ml


def plain(points, k, restarts, rounds):
    """Labels and cost by the same rules, in plain Python integers."""
    count = {}
    for x in points:
        count[x] = count.get(x, 0) + 1
    key = {x: hashlib.md5(",".join(map(str, x)).encode()).hexdigest() for x in count}
    d = lambda a, b: sum((i - j) ** 2 for i, j in zip(a, b))
    best = None
    for r in range(restarts):
        centres = []
        for t in range(k):
            race = []
            for x, n in count.items():
                w = n * (min(d(x, c) for c in centres) if centres else 1)
                u = (int(hashlib.md5(f"{r}:{t}:{key[x]}".encode()).hexdigest()[:8], 16) + 1) / (2.0 ** 32 + 1)
                if w > 0:
                    race.append((-math.log(u) / w, key[x], x))
            if race:
                centres.append(min(race)[2])
        for _ in range(rounds):
            mine = [[] for _ in centres]
            for x, n in count.items():
                mine[min(range(len(centres)), key=lambda i: (d(x, centres[i]), i))].append((x, n))
            centres = [tuple(sum(x[j] * n for x, n in m) // sum(n for _, n in m) for j in range(len(c))) if m else c for c, m in zip(centres, mine)]
        cost = sum(n * min(d(x, c) for c in centres) for x, n in count.items())
        if best is None or cost < best[0]:
            best = (cost, centres)
    return {x: min(range(len(best[1])), key=lambda i: (d(x, best[1][i]), i)) for x in count}


def frame(spark, rows):
    return spark.createDataFrame(rows, "platform string, post_id string, x array<long>")


def test_against_a_plain_version(spark):
    rng = random.Random(1)
    rows = []
    for p, n, spread in (("a", 300, 40), ("b", 90, 5000), (None, 50, 3)):
        rows += [(p, f"{i}", [c + rng.randrange(-spread, spread) for c in rng.choice([(0, 0, 9), (500, -700, 0), (900, 900, 900)])]) for i in range(n)]
    rows += [("a", f"again {i}", rows[3][2]) for i in range(40)] + [("few", "1", [5, 5, 5]), ("few", "2", [5, 5, 5])]
    df = frame(spark, rows).repartition(5)
    got = {(r["platform"], r["post_id"]): r["cluster"] for r in kmeans.cluster(df, lambda n: 4, restarts=3, rounds=6).collect()}
    for p in ("a", "b", None, "few"):
        mine = [(i, tuple(x)) for q, i, x in rows if q == p]
        want = plain([x for _, x in mine], 4, 3, 6)
        assert {i: got[p, i] for i, _ in mine} == {i: want[x] for i, x in mine}, p


def test_layout_does_not_matter(spark, posts):
    cols = ["platform", "cluster", "size", "avg_engagement_rate", "label", "sample_posts"]
    some = posts.limit(700).cache()
    a, b = (sorted(map(tuple, ml.content_tiers(x, 3).select(*cols).collect())) for x in (some.repartition(1), some.repartition(9)))
    assert a == b and len(a) >= 6


def test_few_posts_give_no_rows(spark, posts):
    from pulsekit.sources.testdata import post_embeddings
    e = post_embeddings(spark, "/root/testdata/sf0.001")
    for n in (0, 9):
        few = posts.where("platform = 'youtube'").limit(n)
        t, u = ml.content_tiers(few), ml.topics(few, e)
        assert t.count() == u.count() == 0
        assert t.columns == ml.content_tiers(posts.limit(60)).columns and u.columns == ml.topics(posts.limit(60), e).columns
    none = ml.hashtag_clusters(posts.withColumn("title", F.lit("no tags")), e)
    assert none.count() == 0 and none.columns == ml.hashtag_clusters(posts.limit(60), e).columns


def test_large_components_stay_exact(spark):
    big = 1 << 29
    rows = [("p", f"{i}", [big + i % 7, -big - i % 5]) for i in range(60)] + [("p", f"x{i}", [-big - i % 3, big]) for i in range(30)]
    got = kmeans.cluster(frame(spark, rows), lambda n: 2).groupBy("cluster").count().collect()
    assert sorted(r["count"] for r in got) == [30, 60]
