"""The pipeline's stages against plain versions, and the SQL of the operators that have one."""

import random
import re
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
import oracle_check
from pulsekit.llm import bpe, common, mixing, near_dedup, quality, queries, secrets

from cases import AWKWARD, components, docs, jaccard_edges, words

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in oracle_check.TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_its_sql(spark, con, name):
    df = queries.QUERIES[name](spark, SMALL)
    got = oracle_check.rows_of([tuple(r) for r in df.collect()], df.columns)
    res = con.execute(queries.SQL[name])
    assert got == oracle_check.rows_of(res.fetchall(), [d[0] for d in res.description])


def test_every_operator_is_registered_once():
    import __spark_entry__ as entry
    names = entry.queries()
    assert all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 11)) and "pipeline" in names


def mixed_case(spark):
    rng = random.Random(9)
    vocab = [f"word{i}" for i in range(3000)]
    text = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    rows = [(i, text(rng.randrange(25, 120)), rng.choice(["en", "de"]), rng.choice(["a", "b", "c"])) for i in range(120)]
    rows += [(200 + i, rows[i][1] + " one more", "en", "a") for i in range(10)] + [(300, rows[0][1], "en", "b"), (300, rows[0][1], "en", "b")]
    rows += [(400, text(40) + " password=hunter2hunter2 " + text(5), "en", "a"), (401, "short text", "en", "a"), (402, "again " * 50, "en", "c")]
    rows += [(None if i is None else 500 + i, t, *x) for i, t, *x in AWKWARD]
    return rows, docs(spark, rows)


def test_stages_against_plain_versions(spark, tmp_path):
    rows, df = mixed_case(spark)
    columns = df.columns
    kept = common.materialise(quality.quality_stage(spark, df, ""))
    verdict = {(r["doc_id"], r["n_words"]) for r in quality.judge(df).where("kept").collect()}
    assert kept.columns == columns
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter(r[0] for r in rows if (r[0], len(words(r[1]))) in verdict)
    assert {401, 402, 502}.isdisjoint(r["doc_id"] for r in kept.collect()) and kept.where("doc_id < 130").count() == 120

    near = common.materialise(near_dedup.near_dedup_stage(spark, kept, ""))
    before = [tuple(r) for r in kept.collect()]
    sets = {}
    for i, t, *_ in before:
        w = [x.lower() for x in words(t)]
        if i is not None:
            sets[i] = {tuple(w[j:j + 5]) for j in range(max(1, len(w) - 4))}
    want = components(sets, jaccard_edges(sets))
    assert sorted(r["doc_id"] for r in near.collect() if r["doc_id"] is not None) == sorted(i for i in sets if want[i] == i)
    assert near.columns == columns

    masked = common.materialise(secrets.secret_stage(spark, near, ""))
    a, b = ({r["doc_id"]: r["text"] for r in x.collect()} for x in (near, masked))
    assert masked.columns == columns and {i for i in a if a[i] != b[i]} == {400}
    assert b[400] == re.sub(r"password=\S+", "[SECRET]", a[400])

    mixed = common.materialise(mixing.mix_stage(spark, masked, ""))
    sized = masked.select("*", common.n_words(F.col("text")).alias("size"))
    copies = {r["doc_id"]: r["copies"] for r in mixing.mix(sized.select("doc_id", "source", "size")).collect()}
    got = Counter(r["doc_id"] for r in mixed.collect())
    assert mixed.columns == columns and sum(got.values()) == sum(copies.values())
    size = {r["doc_id"]: (r["source"], r["size"]) for r in sized.collect()}
    took, want_words = Counter(), {r["source"]: r["target"] for r in mixing.source_targets(sized).collect()}
    for i, n in got.items():
        took[size[i][0]] += n * size[i][1]
    assert all(abs(took[s] - t) <= max(v[1] for v in size.values()) for s, t in want_words.items())

    from tokenizers import Tokenizer
    t = Tokenizer.from_file(bpe.default_vocabulary())
    text = {r["doc_id"]: r["text"] for r in masked.collect()}
    out = bpe.encode_stage(spark, mixed, "").collect()
    assert Counter(r["doc_id"] for r in out) == got
    assert all(r["ids"] == t.encode(text[r["doc_id"]], add_special_tokens=False).ids and r["n_tokens"] == len(r["ids"]) for r in out)


def test_stages_on_awkward_and_empty_tables(spark):
    for rows in ([], AWKWARD):
        df = docs(spark, rows, extra=True)
        columns = df.columns
        for name, stage in corpus_pipeline.STAGES:
            df = common.materialise(stage(spark, df, ""))
            assert name == corpus_pipeline.STAGES[-1][0] or df.columns == columns
    assert df.columns == ["doc_id", "source", "n_tokens", "ids"]


def test_run_is_the_stages_in_order(spark):
    got = corpus_pipeline.run(spark, SMALL)
    assert got.count() > 50 and got.where("n_tokens <> size(ids)").count() == 0
