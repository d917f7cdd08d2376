"""Vector codes, ranked search and merge replay against plain versions, on awkward rows and on the small tables."""

import base64
import hashlib
import math
import random
import re

import numpy as np
import pytest

from pulsekit.llm import common, merge_replay, ranked_search, vector_codes

from cases import AWKWARD, LONG, docs

SMALL = "/root/testdata/sf0.001"


# -- 11: vector codes ---------------------------------------------------------------

@pytest.mark.parametrize("shape", ["even", "clusters", "grid"])
def test_gnat_finds_the_first_of_the_nearest(shape):
    rng = np.random.default_rng(3)
    if shape == "even":
        points = rng.integers(-300, 300, (256, 16))
    elif shape == "clusters":
        points = rng.integers(-1000, 1000, (16, 16))[rng.integers(0, 16, 256)] + rng.integers(-20, 20, (256, 16))
    else:                                            # many equal entries and many ties
        points = rng.integers(0, 3, (256, 3))
    q = np.vstack([points[rng.integers(0, 256, 500)] + rng.integers(-2, 3, (500, points.shape[1])), points, rng.integers(-2000, 2000, (300, points.shape[1]))])
    d = ((q[:, None, :] - points[None]) ** 2).sum(2)
    tree = vector_codes.Gnat(points)
    index, best = tree.nearest(q)
    assert (index == d.argmin(axis=1)).all() and (best == d.min(axis=1)).all()
    assert tree.computed < d.size


def test_gnat_of_large_components_and_few_points():
    rng = np.random.default_rng(4)
    points = rng.integers(-vector_codes.LIMIT, vector_codes.LIMIT, (40, 16))
    q = points[::-1] + rng.integers(-3, 3, points.shape)
    d = np.array([[int(((a - b).astype(object) ** 2).sum()) for b in points] for a in q])
    index, best = vector_codes.Gnat(points).nearest(q)
    assert index.tolist() == d.argmin(axis=1).tolist() and best.tolist() == d.min(axis=1).tolist()
    for n in (0, 1, 2):
        index, best = vector_codes.Gnat(points[:n]).nearest(q[:3])
        assert index.tolist() == (d[:3, :n].argmin(axis=1).tolist() if n else [0] * 3)


def plain_codes(rows, entries=256, rounds=4):
    """rows: (vec_id, vector, label), all vectors of one length divisible by four."""
    ok = [(i, [math.floor(1024 * x) for x in v], l) for i, v, l in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    seeds = sorted((r for r in ok if r[0] is not None), key=lambda r: (r[0], r[1]))[:entries]
    n = len(ok[0][1]) // 4
    cut = lambda v: [v[p * n:(p + 1) * n] for p in range(4)]
    books = [[cut(s[1])[p] for s in seeds] for p in range(4)]

    def near(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        new = []
        for p in range(4):
            mine = [[] for _ in books[p]]
            for _, v, _ in ok:
                mine[near(p, cut(v)[p])[1]].append(cut(v)[p])
            new.append([[sum(c) // len(m) for c in zip(*m)] if m else e for m, e in zip(mine, books[p])])
        books = new
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    coded = [(i, [near(p, x) for p, x in enumerate(cut(v))], l) for i, v, l in ok]
    errors = [(i, "".join(f"{k:02x}" for _, k in c), sum(d for d, _ in c), l) for i, c, l in coded]
    total = {}
    for _, _, e, l in errors:
        total[l] = total.get(l, 0) + e
    return sorted((str(i), c, e, total[l], digest) for i, c, e, l in errors)


def test_codes_of_awkward_vectors(spark):
    rng = random.Random(5)
    rows = [(i, [rng.gauss(0, 0.2) for _ in range(8)], rng.choice([None, 0, 1])) for i in range(300)]
    rows += [rows[7], rows[7], (None, rows[3][1], 1), (400, None, 1), (401, [0.1] * 7 + [None], 2), (402, [0.1] * 7 + [math.nan], 2),
             (403, [0.1] * 7 + [math.inf], None), (404, [-0.0] * 8, 5), (-3, [0.5, -0.5] * 4, None)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(5).selectExpr("*", "'x' AS code", "1 AS error", "2 AS part")
    got = sorted((str(r["vec_id"]), r["code"], r["error"], r["label_error"], r["codebooks_sha256"]) for r in vector_codes.vector_codes(df).collect())
    assert got == plain_codes(rows)
    few = spark.createDataFrame(rows[:5], "vec_id long, embedding array<double>, label int")
    assert sorted((str(r["vec_id"]), r["code"], r["error"], r["label_error"], r["codebooks_sha256"]) for r in vector_codes.vector_codes(few).collect()) == plain_codes(rows[:5])


def test_codes_of_empty_and_ragged_tables(spark):
    kind = "vec_id long, embedding array<float>, label int"
    assert vector_codes.vector_codes(spark.createDataFrame([], kind)).count() == 0
    assert vector_codes.vector_codes(spark.createDataFrame([(1, None, 2), (2, [None], 2)], kind)).count() == 0
    ragged = spark.createDataFrame([(1, [1.0] * 6, 1), (2, [0.5] * 6, 1), (3, [0.5] * 5, 1), (4, [], None)], kind)
    got = {r["vec_id"]: (r["code"], r["error"]) for r in vector_codes.vector_codes(ragged).collect()}
    assert got == {1: ("00000000", 0), 2: ("01010101", 0), 3: (None, None), 4: (None, None)}
    with pytest.raises(Exception, match="64 bits"):
        vector_codes.vector_codes(spark.createDataFrame([(1, [1e30] * 4, 1)], kind)).count()


def test_codes_do_not_depend_on_the_layout(spark):
    df = common.table(spark, SMALL, "embeddings")
    a, b = (sorted(map(tuple, vector_codes.vector_codes(x).collect())) for x in (df.repartition(1), df.repartition(7)))
    assert a == b


# -- 12: ranked search --------------------------------------------------------------

def plain_search(rows, items, k=10):
    find = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+").findall
    low = lambda t: "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
    found = [(i, find(low(t))) for i, t in rows]
    n_docs, total = sum(bool(t) for _, t in found), sum(len(t) for _, t in found)
    df = {}
    for _, t in found:
        for w in set(t):
            df[w] = df.get(w, 0) + 1
    wanted = {}
    for i, t in items:
        wanted.setdefault(i, set()).update(find(low(t)))
    out = []
    for item, ws in wanted.items():
        scored = []
        for i, t in found:
            m = 10 + 90 * len(t) * n_docs // total if total else 0
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * (10 ** 9 * t.count(w) // (1000 * t.count(w) + 8 * m)) for w in ws if w in t)
            if s > 0:
                scored.append((-s, i is None, i or 0))
        out += [(item, r, None if none else i, -s) for r, (s, none, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def search(rows, items, **kw):
    return sorted(map(tuple, ranked_search.ranked_search(rows, items, **kw).select("item_id", "rank", "doc_id", "score").collect()), key=str)


def test_search_of_awkward_rows(spark):
    rng = random.Random(6)
    common_words, rare = [f"c{i}" for i in range(12)], [f"r{i}" for i in range(400)]
    rows = [(i, " ".join(rng.choice(common_words if rng.random() < 0.8 else rare) for _ in range(rng.randrange(1, 60)))) for i in range(20, 320)]
    rows += [(r[0], r[1]) for r in AWKWARD] + [(500, "Éa,éA;ÉA_x١ 中文"), (501, "éa \x7f x"), (502, "c1 " * 3000)]
    items = [(1, "c1 C2 r5 r6"), (2, None), (3, ""), (4, " .,_- "), (5, "nothing of it"), (6, " ".join(common_words)), (7, "éA Éa x 中文 one"),
             (None, "r1 r2 c3"), (8, "r9"), (8, "c9 c9"), (9, LONG), (6, " ".join(common_words))]
    d = docs(spark, rows, extra=True).repartition(3).selectExpr("*", "1 AS term", "2 AS block", "3 AS score", "4 AS item_id")
    i = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 AS doc_id", "2 AS g", "3 AS term")
    assert search(d, i) == plain_search(rows, items)
    assert search(d, i, k=3) == plain_search(rows, items, 3)


def test_search_over_many_blocks_and_groups(spark):
    rng = random.Random(7)
    words = [f"w{i}" for i in range(300)]
    pick = lambda n: " ".join(words[min(299, int(rng.expovariate(0.02)))] for _ in range(n))
    rows = [(i, pick(rng.randrange(80))) for i in range(900)]
    items = [(i, pick(25)) for i in range(30)]
    d = docs(spark, rows).repartition(4)
    assert ranked_search.postings(d, 37).where("term = ''").count() >= 900 / 37
    got = search(d, spark.createDataFrame(items, "item_id long, text string"), block_docs=37, group_items=4)
    assert got == plain_search(rows, items)


def test_search_of_empty_tables(spark):
    none, some = docs(spark, []), docs(spark, [(1, "a b")])
    no_item, item = spark.createDataFrame([], "item_id long, text string"), spark.createDataFrame([(1, "a c")], "item_id long, text string")
    assert search(none, item) == search(some, no_item) == search(none, no_item) == search(docs(spark, [(1, "...")]), item) == []
    assert search(some, item) == plain_search([(1, "a b")], [(1, "a c")])


def test_accumulators_that_cannot_win_are_dropped():
    import pyarrow as pa
    n = 200
    bundle = pa.table({"block": [1], "g": [0], "ids": [list(range(n))], "sizes": [[10] * n], "items": [[7]], "ends": [[n]],
                       "places": [np.arange(n).astype("<u2").tobytes()], "scores": [(10 ** 9 * np.arange(1, n + 1)).astype("<i8").tobytes()]},
                      schema=pa.schema([("block", pa.int64()), ("g", pa.int64()), ("ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64())),
                                        ("items", pa.list_(pa.int64())), ("ends", pa.list_(pa.int32())), ("places", pa.binary()), ("scores", pa.binary())]))
    work = pa.table({"weight": [1000], "places": [np.array([0, 150], "<u2").tobytes()], "tfs": [np.array([1, 1], "<u4").tobytes()],
                     "wanted": [[{"item_id": 7, "rest": 20 * 10 ** 9}]]})
    out = ranked_search._add(n, 10 * n, 10)(bundle, work)
    places = np.frombuffer(out.column("places")[0].as_py(), "<u2").tolist()
    assert places == list(range(n - 10 - 20, n)) and out.column("ends")[0].as_py() == [30]


# -- 13: merge replay -----------------------------------------------------------------

@pytest.fixture(scope="module")
def reference():
    import tiktoken
    path, pattern = merge_replay.default_ranks(), merge_replay.default_pattern()
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def enc():
    return merge_replay.Encoder(merge_replay.default_ranks(), merge_replay.default_pattern())


def ids(enc, text):
    return np.frombuffer(enc([text])[0], "<u4").tolist()


def test_replay_equals_the_library(enc, reference):
    rng = random.Random(8)
    texts = ["".join(rng.choice("aab  \n\t'sé#1 ll٣中文x\x1c\x85 ") for _ in range(rng.randrange(60))) for _ in range(2000)]
    texts += ["a" * 20_000, "-=" * 5000, " " * 9000, "ab" * 4000, "", " ", "\n", "don't we'll I've", "🙏🏽 é ​", LONG]
    texts += [f"a{c} {c}1{c}{c}x  {c}\n" for c in map(chr, [*range(0x3100), *range(0xD7F0, 0xD800), *range(0xE000, 0xE010), *range(0xFE00, 0x10000), *range(0x1F300, 0x1F700), 0x10FFFF])]
    for text, packed, want in zip(texts, enc(texts), reference.encode_ordinary_batch(texts)):
        assert np.frombuffer(packed, "<u4").tolist() == want, text[:80]
        assert enc.ranks.decode(want) == text.encode()


def test_a_merge_may_open_a_pair_of_lower_rank(tmp_path, reference):
    """Ranks that no training gives: the whole is cheaper than its parts."""
    import tiktoken
    rng = random.Random(9)
    for trial in range(30):
        letters = [bytes([b]) for b in range(256)]
        more = list({bytes(rng.choice(b"abc") for _ in range(rng.randrange(2, 6))) for _ in range(25)})
        rng.shuffle(more)
        path = tmp_path / f"{trial}.ranks"
        path.write_bytes(b"\n".join(base64.b64encode(w) + b" %d" % i for i, w in enumerate(letters + more)))
        lib = tiktoken.Encoding("own", pat_str=merge_replay.default_pattern(), mergeable_ranks={w: i for i, w in enumerate(letters + more)}, special_tokens={})
        own = merge_replay.Encoder(str(path), merge_replay.default_pattern())
        for _ in range(60):
            text = "".join(rng.choice("abc") for _ in range(rng.randrange(1, 25)))
            assert ids(own, text) == lib.encode_ordinary(text), (more, text)


def digests(reference, rows):
    out = []
    for i, text in rows:
        want = reference.encode_ordinary(text or "")
        out.append((i, len(want), hashlib.sha256(",".join(map(str, want)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    return sorted(out, key=str)


def test_round_trip_of_awkward_rows(spark, reference):
    path, pattern = merge_replay.default_ranks(), merge_replay.default_pattern()
    d = docs(spark, AWKWARD, extra=True).selectExpr("*", "1 AS n_tokens")
    assert sorted(map(tuple, merge_replay.round_trip(d, path, pattern).collect()), key=str) == digests(reference, [(r[0], r[1]) for r in AWKWARD])
    coded = merge_replay.encode(d, path, pattern)
    assert sorted((r["doc_id"], bytes(r["bytes"])) for r in merge_replay.decode(coded, path, pattern).where("doc_id IS NOT NULL").collect()) == sorted(
        (r[0], (r[1] or "").encode()) for r in AWKWARD if r[0] is not None)
    odd = spark.createDataFrame([(1, None), (2, [None, -1, 10 ** 9]), (3, [])], "doc_id long, ids array<int>")
    assert {bytes(r["bytes"]) for r in merge_replay.decode(odd, path, pattern).collect()} == {b""}
    assert merge_replay.round_trip(docs(spark, []), path, pattern).count() == 0


def test_round_trip_of_the_small_table(spark, reference):
    rows = [tuple(r) for r in common.table(spark, SMALL, "documents").select("doc_id", "text").collect()]
    assert sorted(map(tuple, merge_replay.op13_merge_replay(spark, SMALL).collect()), key=str) == digests(reference, rows)


def test_memory_is_cleared_and_results_stay(monkeypatch, enc, reference):
    monkeypatch.setattr(merge_replay, "MEMO_WORDS", 5)
    small = merge_replay.Encoder(merge_replay.default_ranks(), merge_replay.default_pattern())
    for text in (LONG, "one two three", LONG):
        assert ids(small, text) == reference.encode_ordinary(text)


# -- bounds that once were caps ---------------------------------------------------------

def test_every_word_that_marks_toxic_texts_gets_a_weight(spark):
    from pulsekit.llm import toxicity
    rng = random.Random(11)
    bad, good = [f"bad{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(400)], [f"good{chr(97 + i)}" for i in range(26)]
    rows = [(" ".join(rng.sample(bad, 40) + rng.choices(good, k=20)), 1) for _ in range(200)] + [(" ".join(rng.choices(good, k=60)), 0) for _ in range(400)]
    words = toxicity.telling_words(spark.createDataFrame(rows, "text string, toxic int"))
    assert set(words) >= set(bad) and len(words) <= 1.1 * len(bad)
    assert toxicity.telling_words(spark.createDataFrame([("a b c", 1)] * 9, "text string, toxic int")) == []
    assert toxicity.chi_square(0.05) == pytest.approx(3.8415, abs=1e-3)


def test_words_of_the_lexicon_are_settled_by_their_counts(spark):
    from pulsekit.llm import bpe
    texts = [(i, "the of and " + ("cat dog " if i % 2 else "") + f"w{i}") for i in range(10)]
    df, path = spark.createDataFrame(texts, "doc_id long, text string").repartition(3), bpe.default_vocabulary()
    assert bpe.frequent_words(df, path, 3) == []                              # four words stand ten times: all of them or none
    assert bpe.frequent_words(df, path, 4) == ["and", "of", "the", "w"]       # digits are words of their own
    assert set(bpe.frequent_words(df, path, 6)) == {"and", "of", "the", "w", "cat", "dog"}
    assert len(bpe.frequent_words(df, path, 1000)) == 16
