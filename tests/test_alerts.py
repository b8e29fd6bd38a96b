"""Alert matching: per-alert filters vs set-based join, caps, digest, config files."""

import json
import os

from pyspark.sql import functions as F

from skillstream.operators import alerts as AL
from skillstream.plans import params as P
from skillstream.plans.catalog import posting_table

from conftest import SF001, SF01


def _key(rows):
    return sorted((r.alert_id, r.job_id) for r in rows)


def test_set_based_equals_loop_over_alerts(spark):
    t = posting_table(spark, SF01)
    alerts = AL.alerts_frame(spark, P.TEST_ALERTS)
    joined = AL.match_alerts(t, alerts, since=P.SINCE).collect()
    loop = []
    for i, a in enumerate(P.TEST_ALERTS):
        if a.get("enabled") is False:
            continue
        loop += [(i, r.job_id) for r in AL.alert_filter(t, a, since=P.SINCE).collect()]
    assert _key(joined) == sorted(loop)
    names = {r.alert_name for r in joined}
    assert names == {"a", "b"}  # c disabled, d wrong-case keyword
    assert sum(1 for r in joined if r.alert_name == "a") == 53


def test_routed_equijoins_equal_theta_join(spark):
    t = posting_table(spark, SF01)
    alerts = AL.alerts_frame(spark, P.TEST_ALERTS + [
        {"name": "e", "email": "e", "keywords": ["The", "Of", "And"], "locations": None,
         "seniority_levels": None, "min_skills_count": None, "enabled": True},
        {"name": "f", "email": "f", "keywords": [], "locations": ["LOC_1", "LOC_1", "LOC_4"],
         "seniority_levels": ["Junior"], "min_skills_count": 2, "enabled": True},
        {"name": "g", "email": "g", "keywords": None, "locations": [],
         "seniority_levels": ["Senior", "Mid"], "min_skills_count": None, "enabled": True},
        {"name": "h", "email": "h", "keywords": None, "locations": None,
         "seniority_levels": None, "min_skills_count": 12, "enabled": True}])
    theta = AL.match_alerts(t, alerts, since=P.SINCE, method="theta").collect()
    for limit in (10_000, 1):  # broadcast alert sides, then shuffled joins / chunks
        routed = AL.match_alerts(t, alerts, since=P.SINCE, broadcast_limit=limit,
                                 theta_max=0).collect()
        assert _key(routed) == _key(theta)  # each (alert, posting) exactly once
    assert {r.alert_name for r in theta} >= {"a", "b", "e", "f", "g", "h"}


def test_no_enabled_alerts_gives_empty_result(spark):
    t = posting_table(spark, SF01)
    off = AL.alerts_frame(spark, [{"name": "x", "email": "x", "keywords": ["The"], "enabled": False}])
    m = AL.match_alerts(t, off)
    assert m.count() == 0 and m.columns[:2] == ["alert_id", "alert_name"]


def test_top50_and_digest(spark):
    t = posting_table(spark, SF01)
    m = AL.match_alerts(t, AL.alerts_frame(spark, P.TEST_ALERTS), since=P.SINCE)
    top = AL.top_hits(m).collect()
    per = {}
    for r in top:
        per.setdefault(r.alert_name, []).append(r)
    assert {k: len(v) for k, v in per.items()} == {"a": 50, "b": 50}
    d = {r.alert_name: r for r in AL.alert_digest(m).collect()}
    assert d["a"].n == 50 and d["a"].n_total == 53
    assert d["a"].subject == "Job Alert: 50 New Job(s) - a"
    ranks = [c.rank for c in d["a"].cards]
    assert ranks == list(range(1, 51))
    assert all(len(c.skills) <= 10 for c in d["b"].cards)
    stamps = [r.processed_timestamp for r in sorted(per["a"], key=lambda r: r.hit_rank)]
    assert stamps == sorted(stamps, reverse=True)


def test_read_alert_config(spark, scratch):
    d = scratch("alerts").removeprefix("file:")
    cfg = {"alerts": [{"name": "x", "email": "e", "keywords": ["Python"], "locations": [],
                       "seniority_levels": ["Mid"], "min_skills_count": 3},
                      {"name": "y", "email": "e", "keywords": [], "enabled": False}],
           "check_interval_minutes": 15, "smtp_config": {"server": "s", "port": 587, "use_tls": True}}
    with open(os.path.join(d, "alerts.json"), "w") as f:
        json.dump(cfg, f, indent=2)
    a = AL.read_alerts(spark, os.path.join(d, "alerts.json"))
    assert a.count() == 2 and AL.enabled_alerts(a).count() == 1
    assert AL.read_alerts(spark, os.path.join(d, "missing.json")).count() == 0
    with open(os.path.join(d, "bad.json"), "w") as f:
        f.write("{not json")
    assert AL.read_alerts(spark, os.path.join(d, "bad.json")).count() == 0
    s = AL.read_alert_settings(spark, os.path.join(d, "alerts.json")).first()
    assert s.check_interval_minutes == 15 and s.smtp_config.port == 587
    # a folder of config files: an alert found in two files is one alert
    os.makedirs(os.path.join(d, "many"))
    for i in range(2):
        with open(os.path.join(d, "many", f"a{i}.json"), "w") as f:
            json.dump(cfg, f)
    many = AL.read_alerts(spark, os.path.join(d, "many"))
    ids = {r.alert_id for r in many.collect()}
    assert many.count() == 2 and ids == {r.alert_id for r in a.collect()}
    # its id stays when alerts come before it, or when it is switched off
    moved = {"alerts": [{"name": "new", "email": "n@x"}] + [dict(x, enabled=False) for x in cfg["alerts"]]}
    with open(os.path.join(d, "moved.json"), "w") as f:
        json.dump(moved, f)
    assert ids < {r.alert_id for r in AL.read_alerts(spark, os.path.join(d, "moved.json")).collect()}


def test_alert_with_a_wrong_type_is_rejected_not_widened(spark, scratch):
    path = os.path.join(scratch("alerts").removeprefix("file:"), "a.json")
    alerts = [{"name": "text number", "min_skills_count": "5", "keywords": None},
              {"name": "not a number", "min_skills_count": "five"},
              {"name": "not a list", "email": "e", "keywords": "Python", "enabled": "maybe"},
              {"name": "empty", "keywords": "", "locations": []},
              {"name": "fine", "keywords": ["C++", "a \"b\""], "enabled": False}]
    with open(path, "w") as f:
        json.dump({"alerts": alerts, "check_interval_minutes": 7}, f)
    good = {r.name: r for r in AL.read_alerts(spark, path).collect()}
    assert set(good) == {"text number", "empty", "fine"}
    assert good["text number"].min_skills_count == 5 and good["empty"].keywords is None
    assert good["fine"].keywords == ["C++", "a \"b\""] and good["fine"].enabled is False
    bad = {r.name: r.wrong for r in AL.rejected_alerts(spark, path).collect()}
    assert bad == {"not a number": ["min_skills_count"], "not a list": ["keywords", "enabled"]}
    assert AL.check_interval(spark, path) == "7 minutes"
    assert AL.check_interval(spark, path + ".missing") == "15 minutes"


def test_top_hits_do_not_depend_on_partitioning(spark):
    from skillstream.schema import ALERT_HIT_COLS
    t = posting_table(spark, SF001).limit(120).withColumn("job_id", F.lit("same"))
    t = t.withColumn("processed_timestamp", F.lit("2024-01-01").cast("timestamp"))
    m = t.select(F.lit(1).cast("bigint").alias("alert_id"), F.lit("x").alias("alert_name"), *ALERT_HIT_COLS)
    m = spark.createDataFrame(m.collect(), m.schema)
    got = [sorted(tuple(map(str, r)) for r in AL.top_hits(m.repartition(n), 50).collect()) for n in (1, 3, 8)]
    assert got[0] == got[1] == got[2] and len(got[0]) == 50
