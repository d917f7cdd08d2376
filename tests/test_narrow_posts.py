"""Captions and vectors stay out of what is cached, stored and shuffled per post."""

import shutil

from pyspark.sql import functions as F

from pulsekit.operators import ml, similarity
from pulsekit.sources import testdata

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted(map(repr, df.collect()))


def test_cached_posts_hold_no_captions(spark):
    bare = testdata.bare_posts(spark, SF)
    assert bare.storageLevel.useMemory and "title" not in bare.columns
    whole = testdata.posts(spark, SF, cache=False)
    titled = testdata.posts(spark, SF)
    assert titled.columns == whole.columns and rows(titled) == rows(whole)
    assert rows(bare.drop("doc_key")) == rows(whole.drop("title"))


def test_repeated_document_ids_give_a_post_each(spark, tmp_path):
    for t in ("orders", "lineitem"):
        shutil.copy(f"{SF}/{t}.parquet", tmp_path / f"{t}.parquet")
    docs = spark.createDataFrame([(0, "a"), (0, "b"), (1, "c"), (None, "d")], "doc_id long, text string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    whole, titled = testdata.posts(spark, str(tmp_path), cache=False), testdata.posts(spark, str(tmp_path))
    assert whole.count() > whole.select("post_id").distinct().count() and rows(titled) == rows(whole)


def test_posts_carry_names_of_vectors(spark):
    posts, e = testdata.posts(spark, SF), testdata.post_embeddings(spark, SF)
    keyed, vectors = similarity.keyed_vectors(posts, e)
    assert "vec" not in keyed.columns and vectors.count() == vectors.select("key").distinct().count()
    plain = similarity.neighbours(similarity.post_vectors(posts, e), 3)
    named = similarity.neighbours(keyed, 3, vectors=vectors)
    assert rows(named.select(plain.columns)) == rows(plain)


def test_fits_store_no_captions(spark):
    posts = testdata.posts(spark, SF).where(F.col("platform") == "youtube")
    data, cols, _ = ml.gbt_models(posts, iters=1)
    assert not {"title", "permalink"} & set(data.columns) and set(cols) <= set(data.columns) and data.count() == posts.count()
