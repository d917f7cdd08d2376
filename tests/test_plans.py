"""Physical-plan properties the scale design relies on."""
from pulsekit.operators import scoring, temporal, text
from pulsekit.sources.testdata import raw_posts

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_topk_is_limited_per_task(posts):
    for df in (scoring.viral_posts(posts), text.driver_corr(posts), text.hashtag_perf(posts)):
        assert "WindowGroupLimit" in _plan(df)


def test_posts_view_prunes_columns(spark):
    plan = _plan(raw_posts(spark, SF))
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double,l_returnflag:string,l_linestatus:string>" in plan
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan


def test_aggregates_are_partial_and_windows_bounded(posts):
    p = _plan(temporal.hourly_profile(posts))
    assert "partial_" in p            # map-side combine before the shuffle
    # the un-partitioned ranking window only sees the 24 hourly rows
    assert p.index("Window") < p.index("partial_")
