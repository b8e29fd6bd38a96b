"""Plan checks: native expressions only, pruning, broadcast, per-group limit."""

import pytest

from skillstream.operators import alerts as AL
from skillstream.operators import metrics as M
from skillstream.plans import params as P
from skillstream.plans.catalog import QUERIES, posting_table

from conftest import SF001

PLAN_ONLY = [k for k in QUERIES if k not in ("publish_stats", "postings_json", "ingest_stream",
                                            "stream_alerts")]


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", PLAN_ONLY)
def test_no_python_evaluation(spark, name):
    p = physical(QUERIES[name](spark, SF001))
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p


def test_aggregates_do_not_read_description(spark):
    t = posting_table(spark, SF001)
    for df in (M.top_skills(t), M.kpis(t), M.skill_cooccurrence(t), M.timeline(t)):
        p = physical(df)
        assert "ReadSchema" in p and "description" not in p


def test_since_filter_pushed_to_scan(spark):
    t = posting_table(spark, SF001)
    p = physical(AL.since_filter(t, P.SINCE))
    assert "PushedFilters: [IsNotNull(processed_timestamp), GreaterThan(processed_timestamp" in p


def test_alert_join_is_broadcast_and_cap_is_group_limit(spark):
    t = posting_table(spark, SF001)
    alerts = AL.alerts_frame(spark, P.TEST_ALERTS)
    m = AL.match_alerts(t, alerts, since=P.SINCE)
    assert "BroadcastNestedLoopJoin" in physical(m)  # small alert set: one broadcast pass
    routed = physical(AL.match_alerts(t, alerts, since=P.SINCE, theta_max=0))
    assert "BroadcastHashJoin" in routed  # keyword alert "a": equi-join on the keyword
    assert "BroadcastNestedLoopJoin" in routed  # criterion-less alert "b" matches every posting
    assert "WindowGroupLimit" in physical(AL.top_hits(m))


def test_cooccurrence_has_no_join(spark):
    p = physical(M.skill_cooccurrence(posting_table(spark, SF001)))
    assert "Join" not in p and "CartesianProduct" not in p


def test_tagging_stays_in_whole_stage_codegen(spark):
    from skillstream.functions.dictionary import default_skills
    from skillstream.functions.tagging import with_tags
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text")
    p = physical(with_tags(docs, "text", default_skills(), "t").select("doc_id", "t"))
    tagging = [line for line in p.splitlines() if "array_except(array(CASE WHEN" in line]
    assert tagging and all(line.lstrip(" +-:").startswith("*(") for line in tagging), p


def test_parallelism_guard_is_a_no_op_for_wide_input(spark):
    from skillstream.sources.tables import ensure_parallelism
    wide = spark.range(0, 1000, numPartitions=spark.sparkContext.defaultParallelism * 2)
    assert ensure_parallelism(wide, "id") is wide
    narrow = spark.range(0, 1000, numPartitions=1)
    spread = ensure_parallelism(narrow, "id")
    assert spread.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert "Exchange hashpartitioning(id" in physical(spread)


@pytest.mark.parametrize("name", PLAN_ONLY)
def test_no_cartesian_product(spark, name):
    assert "CartesianProduct" not in physical(QUERIES[name](spark, SF001))
