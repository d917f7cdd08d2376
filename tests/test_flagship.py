"""The weekly report job writes every table and the summary document."""
import glob
import json
import os

from pulsekit.plans.flagship import REPORT_TABLES, weekly_report


def test_weekly_report_writes_all_tables(spark, posts, tmp_path):
    out = str(tmp_path / "report")
    res = weekly_report(spark, posts, out)
    assert set(res) == set(REPORT_TABLES)
    written = set(os.listdir(out))
    assert set(REPORT_TABLES) <= written and "summary" in written
    doc = json.loads(open(glob.glob(os.path.join(out, "summary", "part-*"))[0]).read())
    assert doc["meta"]["total_posts"] == posts.count()
    assert {"generated_at", "meta", "health", "recommendations"} <= set(doc)
    assert [r["rank"] for r in doc["recommendations"]] == sorted(r["rank"] for r in doc["recommendations"])


def test_account_and_model_tables_join_the_report(spark, posts, tmp_path):
    from pulsekit.plans.flagship import MODEL_TABLES
    from pulsekit.sources.testdata import account_series, post_embeddings
    sf, out = "/root/testdata/sf0.001", str(tmp_path / "report")
    few = {n: REPORT_TABLES[n] for n in ("health", "recommendations")}
    models = {n: MODEL_TABLES[n] for n in ("content_tiers", "similar_summary", "ml_suite_status")}
    res = weekly_report(spark, posts, out, few, series=account_series(spark, sf), embeddings=post_embeddings(spark, sf), models=models)
    accounts = {"account_daily", "account_recent", "account_kpis", "tiktok_account"}
    assert set(res) == set(few) | accounts | set(models) and set(res) <= set(os.listdir(out))
    assert all(res[n].count() for n in accounts | set(models))
    assert res["account_recent"].count() <= res["account_daily"].count()
