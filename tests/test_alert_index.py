"""Many alerts in one pass, digests in one pass, alerts without list criteria."""

import random

import pytest
from pyspark.sql import functions as F

from skillstream.operators import alerts as AL
from skillstream.operators.alert_index import alert_index, index_bytes
from skillstream.plans import params as P
from skillstream.plans.catalog import many_alerts, posting_table

from conftest import SF001, SF01


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def random_alerts(n, seed):
    rng = random.Random(seed)
    terms = ["The", "Of", "And", "De", "To", "Of the", "AI", None]

    def some(values, most):
        return rng.choice([None, [], rng.choices(values, k=rng.randint(1, most))])

    return [{"name": f"r{i}", "email": "x", "keywords": some(terms, 3), "locations": some([f"LOC_{j}" for j in range(11)] + [None], 4),
             "seniority_levels": some(["Junior", "Mid", "Senior"], 2), "min_skills_count": rng.choice([None, 0, 3, 6, 50]),
             "enabled": rng.choice([None, True, False])} for i in range(n)]


def odd_postings(spark):
    """Postings with nulls, repeated skills and repeated rows."""
    t = posting_table(spark, SF001)
    odd = t.limit(20).withColumns({"skills_extracted": F.array(F.lit("The"), F.lit("The"), F.lit(None), F.lit("Of")), "job_id": F.lit(None).cast("string")})
    none = t.limit(5).withColumns({"skills_extracted": F.lit(None).cast("array<string>"), "skills_count": F.lit(None).cast("int"), "location": F.lit(None).cast("string")})
    return t.unionByName(odd).unionByName(odd).unionByName(none)


def rows(df):
    return sorted((tuple(map(str, r)) for r in df.collect()))


@pytest.mark.parametrize("index_limit", [32 << 20, 0])
def test_index_equals_nested_loop(spark, index_limit):
    alerts = AL.alerts_frame(spark, random_alerts(150, 4))
    for postings in (odd_postings(spark), posting_table(spark, SF001).limit(0)):
        want = rows(AL.match_alerts(postings, alerts, method="theta"))
        assert rows(AL.match_alerts(postings, alerts, method="index", index_bytes=index_limit)) == want
    assert rows(AL.match_alerts(postings, alerts.limit(0), method="index")) == []


def test_many_alerts_are_one_scan_one_explode_one_join(spark):
    t = posting_table(spark, SF001)
    alerts = many_alerts(spark, SF001)
    assert alerts.count() > AL.THETA_MAX_ALERTS
    p = plan(AL.match_alerts(t, AL.alerts_frame(spark, random_alerts(60, 1)), since=P.SINCE))
    assert p.count("parquet") == 1 and p.count("posexplode") == 1 and p.count("Join") == 1


def test_large_index_explodes_narrow_rows(spark):
    alerts = AL.alerts_frame(spark, random_alerts(60, 1))
    p = plan(AL.match_alerts(posting_table(spark, SF001), alerts, method="index", index_bytes=0))
    lines = p.splitlines()
    explode = next(i for i, line in enumerate(lines) if "posexplode" in line)
    above = next(line for line in reversed(lines[:explode]) if "Project" in line)  # what leaves the explode
    assert "__k1" in above and "value" in above and "skills" not in above.replace("skills_count", "") and "link" not in above


def test_index_size_counts_bytes(spark):
    a = {"name": "x", "email": "e", "keywords": ["k" * 50] * 2 + ["l"], "locations": None}
    one = index_bytes(alert_index(AL.alerts_frame(spark, [a])))
    assert index_bytes(alert_index(AL.alerts_frame(spark, [a] * 10))) == 10 * one > 10 * 2 * 150
    assert index_bytes(alert_index(AL.alerts_frame(spark, []))) == 0


@pytest.mark.parametrize("held", [20_000, 40])
def test_counted_hits_equal_count_and_top(spark, monkeypatch, held):
    monkeypatch.setattr(AL, "COUNTED_ROWS", held)  # 40: tasks cut and pass on many times
    alerts = AL.alerts_frame(spark, random_alerts(30, 9))
    m = AL.match_alerts(odd_postings(spark).repartition(7), alerts, method="theta")
    totals = {r["alert_id"]: r["count"] for r in m.groupBy("alert_id").count().collect()}
    got = AL.counted_hits(m, cap=8)
    assert {r["alert_id"]: r["n_total"] for r in got.collect()} == totals
    assert rows(got.drop("n_total").select(*AL.top_hits(m, 8).columns)) == rows(AL.top_hits(m, 8))
    assert AL.counted_hits(m.limit(0)).collect() == []


def test_digest_reads_and_matches_once(spark):
    t = posting_table(spark, SF001)
    p = plan(AL.alert_digest(AL.match_alerts(t, AL.alerts_frame(spark, P.TEST_ALERTS), since=P.SINCE)))
    assert p.count("parquet") == 1 and p.count("Join") == 1


def test_open_alerts_keep_cap_rows_per_minimum(spark):
    t = odd_postings(spark)
    alerts = AL.alerts_frame(spark, P.OPEN_ALERTS + random_alerts(40, 2))
    enabled = AL.enabled_alerts(alerts)
    whole = AL.alert_digest(AL.match_alerts(t, alerts, method="theta"), cap=6)
    assert rows(AL.digest_of_hits(AL.digest_hits(t, alerts, cap=6, method="theta"))) == rows(whole)
    hits = AL.open_alert_hits(t, enabled, cap=6)
    per = {r["alert_id"]: r["count"] for r in hits.groupBy("alert_id").count().collect()}
    assert per and max(per.values()) <= 6
    assert AL.open_alert_hits(t, enabled.limit(0)).collect() == []
    since = AL.digest_of_hits(AL.digest_hits(posting_table(spark, SF01), alerts, since=P.SINCE))
    assert rows(since) == rows(AL.alert_digest(AL.match_alerts(posting_table(spark, SF01), alerts, since=P.SINCE)))
